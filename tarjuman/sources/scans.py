"""Table scans: files of five formats, mixed folders, mirrored datasets."""

import csv
import re
from collections import Counter
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarjuman import fixed
from tarjuman.functions.text import trim_text
from tarjuman.workspace import materialize

# File extensions and the format each stands for.
EXTENSIONS = {
    "csv": "csv", "tsv": "tsv", "jsonl": "jsonl", "ndjson": "jsonl",
    "json": "json", "parquet": "parquet",
}
FORMATS = ("csv", "tsv", "json", "jsonl", "parquet")

# Text accepted as a number; Spark's own cast also takes Java suffixes ("1d").
_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf|[iI]nfinity)\s*$"
_TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")


def format_of(path: Column) -> Column:
    """Format by extension, in any case; csv when the extension is unknown."""
    extension = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    kind = F.lit("csv")
    for ending, name in EXTENSIONS.items():
        kind = F.when(extension == ending, name).otherwise(kind)
    return kind


def is_known(path: Column) -> Column:
    """Whether the extension itself names a supported format."""
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin(list(EXTENSIONS))


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Paths below ``path``, without reading any content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path")


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        list_files(spark, path)
    except AnalysisException:
        return False
    return True


@dataclass(frozen=True)
class Files:
    """Files below ``paths`` whose names fit ``glob``, but for those of ``without``.

    ``partitions`` are columns ``(name, type)`` whose values stand in the paths, as
    folders ``name=value``. Only files that differ from most are ever listed by name.
    """

    paths: tuple[str, ...]
    glob: str | None = None
    without: tuple[str, ...] = ()
    partitions: tuple[tuple[str, str], ...] = ()

    @staticmethod
    def of(path: "str | list[str] | Files") -> "Files":
        if isinstance(path, Files):
            return path
        return Files((path,) if isinstance(path, str) else tuple(path))

    def named(self, files: list[str]) -> "Files":
        return replace(self, paths=tuple(files), glob=None, without=())

    def read(self, reader: DataFrameReader, file_format: str) -> DataFrame:
        """The rows of the files, with the partition columns last."""
        reader = reader.option("recursiveFileLookup", "true")
        if self.glob:
            reader = reader.option("pathGlobFilter", self.glob)
        df = reader.format(file_format).load(list(self.paths))
        path, folders = F.col("_metadata.file_path"), dict(self.partitions)
        if self.without:
            df = df.where(~path.isin(list(self.without)))
        if folders:
            own = dict(df.dtypes)
            values = {name: _partition_value(path, name).try_cast(own.get(name, kind)) for name, kind in folders.items()}
            df = df.select(
                *[F.col(f"`{c}`") for c in own if c not in folders],
                # A file outside such folders may hold the column itself.
                *[(F.coalesce(v, F.col(f"`{c}`")) if c in own else v).alias(c) for c, v in values.items()])
        return df


def _partition_value(path: Column, name: str) -> Column:
    """The value in the last folder ``name=value`` of a file's path."""
    found = F.regexp_extract(path, rf"^.*/{re.escape(quote(name))}=([^/]*)/", 1)
    # Once for the address, once for what writers escape in folder names.
    once = F.coalesce(F.try_url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))), found)
    value = F.coalesce(F.try_url_decode(F.replace(once, F.lit("+"), F.lit("%2B"))), once)
    return F.when((found != "") & (value != "__HIVE_DEFAULT_PARTITION__"), value)


def _csv_strings(
    spark: SparkSession, files: Files, sep: str, encoding: str, multiline: bool, names: list[str] | None = None,
) -> DataFrame:
    reader = spark.read.options(
        header=True, sep=sep, quote='"', escape='"', encoding=encoding, multiLine=multiline,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, enforceSchema=names is not None,
    )
    if names is not None:
        reader = reader.schema(StructType([StructField(name, StringType()) for name in names]))
    return files.read(reader, "csv")


def csv_profile(spark: SparkSession, path: str | list[str] | Files) -> DataFrame:
    """Per file: whether it is valid UTF-8, whether quoted fields span lines, its first line.

    One splittable text scan with a map-side aggregate. A line with an odd number
    of quotes opens or closes a field that goes on in another line.
    """
    files = replace(Files.of(path), partitions=(), without=())
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = files.read(spark.read, "text").select(
        "value", F.col("_metadata.file_path").alias("path"), (quotes % 2 == 1).alias("odd"),
        # Lines of a split come in order; the file's first one is in the split at its start.
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("place"),
    )
    return lines.groupBy("path").agg(
        F.min(F.is_valid_utf8("value")).alias("is_utf8"), F.max("odd").alias("spans_lines"),
        F.min_by("value", "place").alias("header"),
    )


def header_names(line: str, sep: str) -> list[str] | None:
    """Column names of a header line, None if it goes on in the next line or is not UTF-8.

    Empty names are ``_c`` and their place, repeated ones get their place at the end.
    """
    if line.count('"') % 2 or "\ufffd" in line:
        return None
    names = next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), [])
    lower = Counter(name.lower() for name in names)
    return [f"_c{i}" if not name else f"{name}{i}" if lower[name.lower()] > 1 else name for i, name in enumerate(names)]


def _alike(profile: DataFrame, by: list[str], files: Files) -> list[tuple[tuple, Files]]:
    """The groups of files that agree in ``by``. The largest is all files but the others."""
    profile = materialize(profile, "profile")
    kinds = [tuple(r) for r in profile.groupBy(*by).count().orderBy(F.desc("count"), *by).select(*by).collect()]
    if not kinds:
        return []
    most = F.lit(True)
    for column, value in zip(by, kinds[0]):
        most = most & F.col(column).eqNullSafe(F.lit(value))
    others: dict[tuple, list[str]] = {}
    if len(kinds) > 1:
        for row in profile.where(~most).select(*by, "path").toLocalIterator():
            others.setdefault(tuple(row)[:-1], []).append(row["path"])
    listed = tuple(p for own in others.values() for p in own)
    groups = [(kinds[0], replace(files, without=files.without + listed))]
    return groups + [(kind, files.named(sorted(map(unquote, others[kind])))) for kind in kinds[1:]]


def _infer(df: DataFrame, names: list[str]) -> dict[str, str]:
    """Narrowest of bigint, double, boolean and string that holds every value."""
    if not names:
        return {}
    tests = []
    for i, name in enumerate(names):
        c = F.col(f"`{name}`")
        whole = c.rlike(_WHOLE) & c.try_cast("bigint").isNotNull()
        tests += [
            F.count(c).alias(f"n{i}"),
            F.count_if(whole).alias(f"bigint{i}"),
            F.count_if(c.rlike(_NUMBER)).alias(f"double{i}"),
            F.count_if(c.isin(list(_TRUTH))).alias(f"boolean{i}"),
        ]
    row = df.agg(*tests).first()
    kinds = {}
    for i, name in enumerate(names):
        fits = [k for k in ("bigint", "double", "boolean") if row[f"{k}{i}"] == row[f"n{i}"] > 0]
        kinds[name] = fits[0] if fits else "string"
    return kinds


def scan_csv(
    spark: SparkSession,
    path: str | list[str] | Files,
    schema: StructType | None = None,
    sep: str = ",",
    latin1_fallback: bool = True,
    na_tokens: tuple[str, ...] = fixed.NA_TOKENS,
    encoding: str | None = None,
    spans_lines: bool | None = None,
) -> DataFrame:
    """CSV files with a header, RFC-4180 quoting and embedded newlines.

    A file that is not valid UTF-8 is read as latin-1. Only files with quoted newlines
    are read whole by one task each; all others stay splittable. Files may hold their
    columns in any order, and some of them only: each kind of header is read by its own
    names. ``schema`` gives the column types and saves the pass that infers them;
    ``encoding`` and ``spans_lines`` together save the one that profiles the files.
    """
    files = Files.of(path)
    if encoding is not None and spans_lines is not None:
        parts = [_csv_strings(spark, files, sep, encoding, spans_lines)]
    else:
        utf8 = F.col("is_utf8") | F.lit(not latin1_fallback)
        profile = csv_profile(spark, files).select(
            "path", "header",
            (F.lit(encoding) if encoding else F.when(utf8, "UTF-8").otherwise("ISO-8859-1")).alias("charset"),
            (F.lit(spans_lines) if spans_lines is not None else F.col("spans_lines")).alias("spans"))
        parts = []
        for (charset, spans, header), group in _alike(profile, ["charset", "spans", "header"], files):
            names = header_names(header, sep)
            if names is None:
                group = _listed(spark, group)  # the reader takes the names from the first file
            parts.append(_csv_strings(spark, group, sep, charset, spans, names))
        parts = parts or [_csv_strings(spark, files, sep, "UTF-8", False)]
    strings = _union(_reconcile(parts))
    tokens, folders = list(na_tokens), dict(files.partitions)
    cleaned = strings.select([
        F.col(f"`{c}`") if c in folders and folders[c] != "string"
        else F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c) for c in strings.columns
    ])
    if schema is None:
        kinds = _infer(cleaned, [c for c in cleaned.columns if c not in folders])
    else:
        kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    return cleaned.select([
        F.col(f"`{c}`") if kinds.get(c, "string") == "string" or c in folders
        else F.col(f"`{c}`").try_cast(kinds[c]).alias(c)
        for c in cleaned.columns
    ])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_tsv(
    spark: SparkSession, path: str | list[str] | Files, schema: StructType | None = None
) -> DataFrame:
    """Tab-separated files, UTF-8 only."""
    return scan_csv(spark, path, schema, sep="\t", latin1_fallback=False)


def json_profile(spark: SparkSession, path: str | list[str] | Files) -> DataFrame:
    """Per file: whether each line is a document of its own."""
    lines = replace(Files.of(path), partitions=(), without=()).read(spark.read, "text")
    line = trim_text(F.col("value"))
    record = line.startswith("{") & line.endswith("}")
    records = line.startswith("[") & line.endswith("]")
    return lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.min((line == "") | record | records).alias("by_line")
    )


def scan_json(
    spark: SparkSession, path: str | list[str] | Files, schema: StructType | None = None
) -> DataFrame:
    """JSON arrays of records, or one record per line as our own sink writes.

    A file whose document spans lines is read whole by one task.
    """
    files = Files.of(path)
    groups = _alike(json_profile(spark, files), ["by_line"], files)
    if not groups:
        return scan_jsonl(spark, files, schema)
    reader = spark.read.schema(schema) if schema else spark.read
    parts = [
        (group if schema else _listed(spark, group)).read(reader.option("multiLine", str(not by_line).lower()), "json")
        for (by_line,), group in groups
    ]
    return _union(_reconcile(parts))


def _listed(spark: SparkSession, group: Files) -> Files:
    """A group by its own names, where the others would disturb what a reader infers."""
    if not group.without:
        return group
    listed = list_files(spark, list(group.paths), group.glob).select("path")
    gone = {unquote(p) for p in group.without}
    return group.named(sorted(r["path"] for r in listed.toLocalIterator() if unquote(r["path"]) not in gone))


def scan_jsonl(
    spark: SparkSession, path: str | list[str] | Files, schema: StructType | None = None
) -> DataFrame:
    """One JSON record per line; splittable."""
    return Files.of(path).read(spark.read.schema(schema) if schema else spark.read, "json")


def scan_parquet(
    spark: SparkSession, path: str | list[str] | Files, schema: StructType | None = None
) -> DataFrame:
    """Parquet files, in folders of any depth."""
    return Files.of(path).read(spark.read.schema(schema) if schema else spark.read, "parquet")


_SCANS = {
    "csv": scan_csv, "tsv": scan_tsv, "json": scan_json,
    "jsonl": scan_jsonl, "parquet": scan_parquet,
}


def partition_columns(listed: DataFrame, root: str) -> tuple[tuple[str, str], ...]:
    """Columns that folders ``name=value`` below ``root`` make, with the types of their values."""
    below = F.element_at(F.split("path", re.escape(root.rstrip("/")), 2), -1)
    pairs = listed.select(F.explode(F.regexp_extract_all(below, F.lit("/([^/=]+=[^/]*)(?=/)"), F.lit(1))).alias("pair"))
    value = F.substring_index("pair", "=", -1)
    known = F.when(value != "__HIVE_DEFAULT_PARTITION__", value)
    whole = known.rlike(r"^-?\d{1,18}$")
    named = pairs.groupBy(F.substring_index("pair", "=", 1).alias("name")).agg(
        F.count(known).alias("n"), F.count_if(whole & known.try_cast("int").isNotNull()).alias("int"),
        F.count_if(whole).alias("bigint"),
        F.count_if(known.rlike(r"^\d{4}-\d\d-\d\d$") & known.try_cast("date").isNotNull()).alias("date"),
    )
    found = []
    for row in named.orderBy("name").collect():
        fits = [kind for kind in ("int", "bigint", "date") if row[kind] == row["n"] > 0]
        found.append((unquote(row["name"]), fits[0] if fits else "string"))
    return tuple(found)


def _glob(kind: str) -> str:
    """Names with the extensions of ``kind``, in any case."""
    endings = ["".join(f"[{c}{c.upper()}]" for c in e) for e, name in EXTENSIONS.items() if name == kind]
    return "*.{" + ",".join(endings) + "}"


def scan_files(
    spark: SparkSession,
    path: str | list[str],
    file_format: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """A file or folder; formats may be mixed when none is given.

    One reader per format found, by the names of its files; columns are matched by name,
    and a column whose type differs between formats becomes a string. Folders
    ``name=value`` below a single ``path`` give columns, whatever the format.
    """
    if file_format is not None and file_format not in _SCANS:
        raise ValueError(f"Unsupported format: {file_format}")
    listed = list_files(spark, path).select("path", format_of(F.col("path")).alias("kind"), is_known(F.col("path")).alias("known"))
    folders = partition_columns(listed, path) if isinstance(path, str) else ()
    files = replace(Files.of(path), partitions=folders)
    if schema is not None:
        schema = StructType([f for f in schema.fields if f.name not in dict(folders)])
    if file_format is not None:
        return _SCANS[file_format](spark, files, schema)
    kinds = [tuple(r) for r in listed.groupBy("known", "kind").count().orderBy("kind", "known").collect()]
    if not kinds:
        raise ValueError(f"No files below {path}")
    parts = []
    for known, kind, _ in kinds:
        if known:
            group = replace(files, glob=_glob(kind))
        else:
            group = files.named([r["path"] for r in listed.where(~F.col("known")).toLocalIterator()])
        parts.append(_SCANS[kind](spark, group, schema))
    return _union(_reconcile(parts))


def _reconcile(parts: list[DataFrame]) -> list[DataFrame]:
    kinds: dict[str, set] = {}
    for part in parts:
        for field in part.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType)
    mixed = {name for name, types in kinds.items() if len(types) > 1}
    return [
        part.select([
            F.col(f"`{c}`").cast(StringType()).alias(c) if c in mixed else F.col(f"`{c}`")
            for c in part.columns
        ])
        for part in parts
    ]


def scan_split(
    spark: SparkSession, root: str, name: str, split: str = "train", subset: str | None = None
) -> DataFrame:
    """A split mirrored below ``root/name/[subset/]`` as a folder ``split``, as
    ``split.parquet``, ``split-N.parquet`` or ``split-N-of-M.parquet``; no other split is read."""
    folder = "/".join(p for p in (root.rstrip("/"), name, subset) if p)
    forms = ["", ".parquet", "-[0-9]*.parquet"]
    found = [p for p in (f"{folder}/{split}{form}" for form in forms) if path_exists(spark, p)]
    if not found:
        raise FileNotFoundError(f"No split {split} in {folder}")
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(*found)


def scan_archive(
    spark: SparkSession, root: str, name: str, file_name: str | None = None
) -> DataFrame:
    """One table of a mirrored archive: the named one, else the first known by path.

    A folder with a known extension, as Spark writes them, counts as one table.
    """
    folder = f"{root.rstrip('/')}/{name}"
    known = "|".join(EXTENSIONS)
    table = F.regexp_extract("path", rf"(?i)^(.*?/[^/]+\.(?:{known}))(?:/|$)", 1)
    files = list_files(spark, folder).select(
        F.when(table == "", F.col("path")).otherwise(table).alias("table")
    )
    if file_name:
        wanted = files.where(F.element_at(F.split("table", "/"), -1) == file_name)
    else:
        wanted = files.where(is_known(F.col("table")))
    chosen = wanted.agg(F.min("table")).first()[0]
    if chosen is None:
        if file_name:
            raise FileNotFoundError(f"File {file_name} not found in dataset {name}")
        raise ValueError(f"No supported file format found in {name}")
    return scan_files(spark, chosen)


def load_table(
    spark: SparkSession,
    source: str,
    file_format: str | None = None,
    split: str = "train",
    subset: str | None = None,
    file_name: str | None = None,
    roots: dict[str, str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Resolve ``source``: named-dataset prefix, archive prefix, path, then by guess.

    ``roots`` says where datasets are mirrored: ``{"huggingface": …, "kaggle": …}``.
    """
    roots = roots or {}
    for kind in ("huggingface", "kaggle"):
        if source.startswith(f"{kind}:"):
            if kind not in roots:
                raise ValueError(f"No mirror folder is set for '{kind}:' sources")
            name = source.removeprefix(f"{kind}:")
            if kind == "huggingface":
                return scan_split(spark, roots[kind], name, split, subset)
            return scan_archive(spark, roots[kind], name, file_name)
    if path_exists(spark, source):
        return scan_files(spark, source, file_format, schema)
    if "/" in source:
        attempts = (
            ("huggingface", lambda root: scan_split(spark, root, source, split, subset)),
            ("kaggle", lambda root: scan_archive(spark, root, source, file_name)),
        )
        for kind, scan in attempts:
            if kind in roots and path_exists(spark, f"{roots[kind].rstrip('/')}/{source}"):
                return scan(roots[kind])
    raise ValueError(f"Could not load dataset from '{source}': no such path or mirrored dataset")
