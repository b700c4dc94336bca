"""A whole run from options: load, choose columns, translate, write, report."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarjuman import fixed
from tarjuman.operators.shape import (
    keep_columns, limit_rows, missing_columns, text_columns, with_row_id,
)
from tarjuman.operators.statistics import run_clock, run_counters, top_failures
from tarjuman.plans.translate import failed_cells, translate
from tarjuman.sources.scans import load_table
from tarjuman.sources.sinks import write_statistics, write_table
from tarjuman.workspace import materialize

DEFAULTS = {
    "dataset": {
        "source": None, "format": None, "schema": None, "split": "train", "subset": None, "file_name": None,
        "roots": {}, "key": None, "columns_to_translate": "auto", "limit": None,
    },
    "translation": {
        "primary_api": "nvidia", "enable_fallback": False, "normalize_provider_terms": True,
        "custom_terms": None, "preserve_all_columns": True, "null_policy": "skip", "suffix": "ar",
    },
    "retry": {
        "max_retries": fixed.MAX_RETRIES, "backoff_multiplier": fixed.BACKOFF_MULTIPLIER,
        # None leaves a provider its own time limit; False lifts the limits of all providers.
        "request_timeout": None, "respect_rate_limits": True,
    },
    # Per provider name: rate_limit_rpm, model, temperature, max_tokens, top_p.
    "apis": {},
    "checkpoint": {
        "enabled": True, "folder": None, "resume_from_last": False, "resume_upto": None,
        # Texts per batch; a batch is one set of Spark jobs, so keep it large.
        "interval": None, "batches": 1,
    },
    "output": {
        "path": "data/translated_output.csv", "format": None, "save_statistics": True,
        "keep_columns": None,
    },
}


API_OPTIONS = ("rate_limit_rpm", "model", "temperature", "max_tokens", "top_p")
FIRST_FAILURES = 10


@dataclass(frozen=True)
class JobResult:
    """What the run wrote, its tables, its clock and its first failures in row, then column order."""

    table: DataFrame
    stats: DataFrame
    failures: DataFrame
    attempts: DataFrame
    columns: list[str]
    clock: dict[str, object]
    first_failures: list[Row]


def merged_options(options: Mapping) -> dict:
    """Defaults overlaid with ``options``; an unknown name is an error, an empty section none."""
    merged = {section: dict(values) for section, values in DEFAULTS.items()}
    for section, values in options.items():
        if section not in merged:
            raise ValueError(f"Unknown option section: {section}")
        values = values or {}
        if section == "apis":
            for name, own in values.items():
                _known(own or {}, API_OPTIONS, f"apis.{name}")
        else:
            _known(values, merged[section], section)
        merged[section].update(values)
    return merged


def _known(values: Mapping, names: Sequence[str], section: str) -> None:
    unknown = set(values) - set(names)
    if unknown:
        raise ValueError(f"Unknown options in {section}: {sorted(unknown)}")


def configured(provider, name: str, opts: Mapping, log: str | None):
    """A provider with the options of its section; one without a client has nothing to set."""
    if not hasattr(provider, "configured"):
        return provider
    own = dict(opts["apis"].get(name) or {})
    limit = own.pop("rate_limit_rpm", provider.per_minute)
    return provider.configured(
        per_minute=limit if opts["retry"]["respect_rate_limits"] else None,
        timeout=opts["retry"]["request_timeout"], settings=own, log=log)


def provider_order(primary: str, fallback: bool, providers: Mapping[str, object]) -> list:
    """The primary provider, then the others in their given order if fallback is on."""
    if primary not in providers:
        raise ValueError(f"No provider named '{primary}'")
    others = [p for name, p in providers.items() if name != primary] if fallback else []
    return [providers[primary], *others]


def run_job(spark: SparkSession, options: Mapping, providers: Mapping[str, object]) -> JobResult:
    """Run one translation job. ``providers`` maps names to provider objects."""
    opts = merged_options(options)
    data, trans, check, out = (
        opts[s] for s in ("dataset", "translation", "checkpoint", "output")
    )
    if not data["source"]:
        raise ValueError("No dataset specified")
    began = datetime.now()
    table = load_table(
        spark, data["source"], data["format"], data["split"], data["subset"],
        data["file_name"], data["roots"], _schema(data["schema"]),
    )

    columns = data["columns_to_translate"]
    if columns == "auto" or columns == ["auto"]:
        columns = text_columns(table)
    columns = list(columns)
    absent = missing_columns(table, columns)
    if absent:
        raise ValueError(f"Columns not in dataset: {absent}")
    if not columns:
        raise ValueError("No columns to translate")

    table, key, own_key = _keyed(table, data["key"])
    if data["limit"]:
        table = limit_rows(table, key, data["limit"])
    folder = check["folder"].rstrip("/") if check["enabled"] and check["folder"] else None
    providers = {
        name: configured(p, name, opts, f"{folder}_calls/{name}" if folder else None) for name, p in providers.items()
    }
    order = provider_order(trans["primary_api"], trans["enable_fallback"], providers)
    done = translate(
        table, columns, order, key,
        null_policy=trans["null_policy"],
        terms=trans["normalize_provider_terms"],
        custom_terms=trans["custom_terms"],
        max_retries=opts["retry"]["max_retries"],
        backoff=opts["retry"]["backoff_multiplier"],
        suffix=trans["suffix"],
        progress_folder=folder,
        resume=bool(folder and check["resume_from_last"]),
        upto=check["resume_upto"],
        batches=check["batches"],
        batch_rows=check["interval"],
    )

    # The write itself counts, so the statistics cost no scan of their own.
    counted, names = Observation("run"), [p.name for p in order]
    counters = run_counters(columns, names, trans["suffix"], trans["null_policy"])
    full = done.table.observe(counted, *counters)
    keep = out["keep_columns"]
    if keep is None:
        keep = table.columns if trans["preserve_all_columns"] else key
        keep = [c for c in keep if not (own_key and c in key)]
    write_table(keep_columns(full, keep, columns, trans["suffix"]), out["path"], out["format"])
    numbers = counted.get
    clock = run_clock(began, datetime.now(), numbers["total"])

    stats = spark.createDataFrame([numbers], ", ".join(f"`{name}` long" for name in numbers))
    failures = failed_cells(table, columns, key, done, trans["null_policy"])
    first: list[Row] = []
    if numbers["failed"]:
        rank = F.array_position(F.array(*map(F.lit, columns)), F.col("column"))
        first = top_failures(failures.withColumn("column_rank", rank), key, FIRST_FAILURES).collect()
    if out["save_statistics"]:
        shown = [{c: str(r[c]) for c in (*key, "column", "error")} for r in first]
        write_statistics(
            stats.select("*", *[F.lit(v).alias(c) for c, v in clock.items()], _as_column(shown)), failures, out["path"])
    result = keep_columns(done.table, keep, columns, trans["suffix"])
    return JobResult(result, stats, failures, done.attempts, columns, clock, first)


def _as_column(failures: list[dict[str, str]]) -> Column:
    found = [F.struct(*[F.lit(v).alias(c) for c, v in row.items()]) for row in failures]
    none = F.from_json(F.lit("[]"), "array<struct<column:string,error:string>>")
    return (F.array(*found) if found else none).alias("first_failures")


def _schema(schema: str | StructType | None) -> StructType | None:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _keyed(table: DataFrame, key: str | Sequence[str] | None) -> tuple[DataFrame, list[str], bool]:
    """The table with its key: the caller's, else file and row of a Parquet scan.

    Rows of other formats have no such identity; they are written once as typed
    Parquet, and the later steps run on that copy. Finished work is found again by
    its texts, so the identity need not outlast the run.
    """
    if key:
        return table, [key] if isinstance(key, str) else list(key), False
    try:
        return with_row_id(table), ["source_file", "source_row"], True
    except AnalysisException:
        return with_row_id(materialize(table, "source")), ["source_file", "source_row"], True
