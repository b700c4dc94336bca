"""Columns, rows and cells of a table."""

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tarjuman import fixed
from tarjuman.operators.ordered import Measure, add, running, sorted_runs
from tarjuman.operators.skew import hot_keys, salted_join
from tarjuman.workspace import materialize


#: Up to so many rows every task keeps its first ones, instead of a search for the cut.
MOST_PREVIEWED = 10_000
SKETCH_STEPS, SKETCH_ACCURACY = 200, 10_000


def spread(df: DataFrame, key: list[str]) -> DataFrame:
    """Deal out a scan that has fewer splits than there are cores.

    Work on texts is bound by the processor, and a small file is a single split.
    A scan of many splits is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *key)


def detect_text_columns(
    df: DataFrame, null_word: str = "nan", min_mean: float = fixed.TEXT_MEAN_LENGTH
) -> DataFrame:
    """``(column, avg_len, is_text)`` per string column, from one aggregate."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, avg_len double, is_text boolean")
    means = df.agg(*[
        F.avg(F.length(F.coalesce(F.col(f"`{c}`"), F.lit(null_word)))).alias(f"m{i}")
        for i, c in enumerate(names)
    ])
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("avg_len"))
        for i, c in enumerate(names)
    ]
    return means.select(F.inline(F.array(*entries))).select(
        "column", "avg_len", F.coalesce(F.col("avg_len") > min_mean, F.lit(False)).alias("is_text")
    )


def text_columns(df: DataFrame, null_word: str = "nan") -> list[str]:
    """Names of the text columns, in table order."""
    found = detect_text_columns(df, null_word).where("is_text").collect()
    names = {row["column"] for row in found}
    return [c for c in df.columns if c in names]


def profile_columns(df: DataFrame, requested: list[str] | None = None) -> DataFrame:
    """``(column, type, present, null_count)`` of the requested columns, or of all."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = list(dict.fromkeys(requested or df.columns))
    present = [c for c in names if c in kinds]
    nulls = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(present)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kinds.get(c)).cast("string").alias("type"),
            F.lit(c in kinds).alias("present"),
            (F.col(f"n{present.index(c)}") if c in kinds else F.lit(None).cast("long"))
            .alias("null_count"),
        )
        for c in names
    ]
    return nulls.select(F.inline(F.array(*entries)))


def missing_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row, to deal out rows that no key tells apart."""
    fit = [f.name for f in df.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    return F.xxhash64(*[F.col(f"`{c}`") for c in fit])


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name in any case."""
    known = {name.lower() for name in taken}
    while wanted.lower() in known:
        wanted = "_" + wanted
    return wanted


def limit_rows(df: DataFrame, key: str | list[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of ``key``, nulls first: exactly ``n`` rows
    if there are as many, whatever the ties. Ties are taken by a digest of the row."""
    order = [key] if isinstance(key, str) else list(key)
    if n <= 0:
        return df.limit(0)
    place = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)])
    cut = _cut(df.select(place.alias("place")), n)
    if cut is None:
        return df
    bound, before, upto = cut
    if upto == n:
        return df.where(place <= bound)
    # The cut falls within a tie: its rows are told apart by their digests, and rows of
    # one digest are copies of each other.
    tied = df.where(place.eqNullSafe(bound))
    digest = F.struct(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256).alias("k0"))
    bound_tie, before_tie, _ = _cut(tied.select(digest.alias("place")), n - before)
    copies = F.sequence(F.lit(1), F.lit(n - before - before_tie))
    last = tied.where(digest == bound_tie).limit(1).select("*", F.explode(copies).alias("_copy")).drop("_copy")
    return df.where((place < bound) | (place.eqNullSafe(bound) & (digest < bound_tie))).union(last)


def _cut(places: DataFrame, n: int) -> tuple[Column, int, int] | None:
    """The place of the ``n``-th row, the number of rows before that place and up to it.

    A preview keeps the first rows of each task. For more rows, a quantile sketch finds
    a range that holds the cut, so that only the rows in it are sorted.
    """
    if n <= MOST_PREVIEWED:
        first = materialize(places.orderBy("place").limit(n), "first")
        last, rows = first.agg(F.max("place"), F.count(F.lit(1))).first()
        if rows < n:
            return None
        bound = _literal(places, last)
        before = first.where(F.col("place") < bound).count()
        return bound, before, before + places.where(F.col("place").eqNullSafe(bound)).count()
    near = _near(places, n)
    if near is not None:
        within, before = near
        found = _exact_cut(places.where(within), n - before)
        if found is not None:
            bound, earlier, upto = found
            return bound, before + earlier, before + upto
    return _exact_cut(places, n)


def _near(places: DataFrame, n: int) -> tuple[Column, int] | None:
    """A condition that holds around the ``n``-th row, and how many rows lie before those it holds for."""
    value = _as_number(F.col("place.k0"), places.schema["place"].dataType.fields[0].dataType.simpleString())
    if value is None:
        return None
    steps = [i / SKETCH_STEPS for i in range(SKETCH_STEPS + 1)]
    rows, known, grid = places.agg(
        F.count(F.lit(1)), F.count(value), F.percentile_approx(value, steps, SKETCH_ACCURACY)).first()
    nulls = rows - known
    if n > rows:
        return None
    if n <= nulls or not known:
        return value.isNull(), 0
    # The sketch is right to within a share of the rows; one step more on either side covers it.
    at = int((n - nulls) / known * SKETCH_STEPS)
    low, high = grid[max(at - 1, 0)], grid[min(at + 2, SKETCH_STEPS)]
    within = value.between(F.lit(low), F.lit(high))
    before = places.where(value.isNull() | (value < F.lit(low))).count()
    return (within, before) if before < n else None


def _as_number(c: Column, kind: str) -> Column | None:
    """A number that never falls as ``c`` rises, null where ``c`` is."""
    if kind in ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp")) if "timestamp" in kind else (
            F.unix_date(c).cast("long") if kind == "date" else c.cast("long"))
    if kind in ("float", "double") or kind.startswith("decimal"):
        number = c.cast("double")
        return F.when(F.isnan(number), float("inf")).otherwise(number)
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")
    return None


def _literal(places: DataFrame, value) -> Column:
    fields = places.schema["place"].dataType.fields
    return F.struct(*[F.lit(value[f.name]).cast(f.dataType).alias(f.name) for f in fields])


def _exact_cut(places: DataFrame, n: int) -> tuple[Column, int, int] | None:
    """The cut by a running sum over all places.

    Equal places are counted before the shuffle, so a tie of any size is one row.
    """
    names = [f.name for f in places.schema["place"].dataType.fields]
    counted = places.groupBy(*[F.col(f"place.{c}").alias(c) for c in names]).agg(F.count(F.lit(1)).alias("_rows"))
    summed = running(sorted_runs(counted, names), [], Measure("_upto", F.col("_rows"), F.sum, add))
    found = summed.where((F.col("_upto") >= n) & (F.col("_upto") - F.col("_rows") < n)).first()
    if found is None:
        return None
    return _literal(places, found), found["_upto"] - found["_rows"], found["_upto"]


def translated_names(columns: list[str], suffix: str = "ar") -> list[str]:
    return [f"{c}_{suffix}" for c in columns] + [f"{c}_api" for c in columns]


def keep_columns(
    df: DataFrame, keep: list[str], columns: list[str], suffix: str = "ar"
) -> DataFrame:
    """Chosen originals, then every translation, then every provider column."""
    wanted = dict.fromkeys([*keep, *translated_names(columns, suffix)])
    return df.select([F.col(f"`{c}`") for c in wanted if c in df.columns])


def with_row_id(df: DataFrame, dense: str | None = None) -> DataFrame:
    """Add ``source_file`` and ``source_row`` to a Parquet scan, its stable identity.

    ``dense`` names an additional column numbering all rows from zero.
    """
    keyed = df.select(
        *df.columns,
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.row_index").alias("source_row"),
    )
    if dense is None:
        return keyed
    # A row's number is its place in the file after all rows of earlier files; the
    # window below sees one row per file.
    sizes = keyed.groupBy("source_file").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "source_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    hot = hot_keys(sizes, "source_file", "_rows")
    placed = salted_join(keyed, offsets, "source_file", ["source_row"], hot)
    return placed.select(*keyed.columns, (F.col("_offset") + F.col("source_row")).alias(dense))


def cell_text(column: Column, null_policy: str = "skip", null_word: str = "nan") -> Column:
    """A cell as text. ``skip`` keeps nulls null; ``literal`` spells them out."""
    text = column.cast("string")
    if null_policy == "literal":
        return F.coalesce(text, F.lit(null_word))
    if null_policy != "skip":
        raise ValueError(f"null_policy is 'skip' or 'literal', not {null_policy!r}")
    return text


def unpivot_cells(
    df: DataFrame, key: list[str], columns: list[str],
    null_policy: str = "skip", null_word: str = "nan",
) -> DataFrame:
    """Wide to long: ``(*key, column, text)``, one row per cell, nulls kept."""
    texts = [cell_text(F.col(f"`{c}`"), null_policy, null_word).alias(c) for c in columns]
    # A key column may be translated as well, so keys travel under other names.
    keys = [F.col(f"`{k}`").alias(f"_key_{k}") for k in key]
    long = df.select(*keys, *texts).unpivot(
        [f"_key_{k}" for k in key], list(columns), "column", "text"
    )
    return long.withColumnsRenamed({f"_key_{k}": k for k in key})


def pivot_cells(
    done: DataFrame, key: list[str], columns: list[str], suffix: str = "ar"
) -> DataFrame:
    """Long to wide: ``{column}_ar`` and ``{column}_api`` per key.

    ``done`` holds a cell once, so a group has at most one row per column.
    """
    picks = []
    for name, source in ((suffix, "translation"), ("api", "api")):
        for c in columns:
            cell = F.when(F.col("column") == c, F.col(source))
            picks.append(F.max(cell).alias(f"{c}_{name}"))
    return done.groupBy(*key).agg(*picks)


def attach_translations(
    df: DataFrame, wide: DataFrame, key: list[str], preserve: bool = True
) -> DataFrame:
    """Join translations to their rows, null keys included; rows without any keep nulls."""
    base = df if preserve else df.select(*key)
    found = wide.withColumnsRenamed({k: f"_of_{k}" for k in key})
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`")) for k in key]
    return base.join(found, same, "left").drop(*[f"_of_{k}" for k in key])
