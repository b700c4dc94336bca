"""Run statistics, computed from tables instead of counted along the way."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarjuman import fixed


def run_stats(
    table: DataFrame, columns: list[str], providers: list[str],
    suffix: str = "ar", null_policy: str = "skip",
) -> DataFrame:
    """One row: ``total`` rows; ``successful``, ``failed`` and ``<api>_used`` cells.

    Under the ``skip`` policy a null cell was never attempted, so it did not fail.
    """
    return table.agg(*run_counters(columns, providers, suffix, null_policy))


def run_counters(
    columns: list[str], providers: list[str], suffix: str = "ar", null_policy: str = "skip",
) -> list[Column]:
    """The aggregates of :func:`run_stats`, which may also be observed along a write."""
    def over_columns(test) -> Column:
        return F.coalesce(F.sum(sum((F.when(test(c), 1).otherwise(0) for c in columns), F.lit(0))), F.lit(0)).cast("long")

    return [
        F.count(F.lit(1)).alias("total"),
        over_columns(lambda c: F.col(f"`{c}_{suffix}`").isNotNull()).alias("successful"),
        over_columns(lambda c: _failed(c, suffix, null_policy)).alias("failed"),
        *[
            over_columns(lambda c, api=api: F.col(f"`{c}_api`") == api).alias(f"{api}_used")
            for api in providers
        ],
    ]


def run_clock(began: datetime, ended: datetime, rows: int) -> dict[str, object]:
    """Start, end, duration and mean seconds per row of a run."""
    seconds = (ended - began).total_seconds()
    return {
        "start_time": began.isoformat(), "end_time": ended.isoformat(), "duration_seconds": seconds,
        "seconds_per_row": seconds / max(rows, 1),
    }


def stats_from_outcomes(
    rows: DataFrame, requests: DataFrame, finished: DataFrame, providers: list[str]
) -> DataFrame:
    """The row of :func:`run_stats`, from distinct texts instead of the wide table.

    ``requests`` holds ``(text_key, n_cells)``, ``finished`` ``(text_key, api)``.
    """
    settled = requests.select("text_key", "n_cells").join(
        finished.select("text_key", "api"), "text_key", "left"
    )

    def cells(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n_cells"))), F.lit(0)).cast("long")

    return settled.agg(
        rows.agg(F.count(F.lit(1))).scalar().alias("total"),
        cells(F.col("api").isNotNull()).alias("successful"),
        cells(F.col("api").isNull()).alias("failed"),
        *[cells(F.col("api") == api).alias(f"{api}_used") for api in providers],
    )


def _failed(column: str, suffix: str, null_policy: str) -> Column:
    missing = F.col(f"`{column}_{suffix}`").isNull()
    return missing if null_policy == "literal" else missing & F.col(f"`{column}`").isNotNull()


def failed_cells(
    table: DataFrame, key: list[str], columns: list[str],
    suffix: str = "ar", null_policy: str = "skip",
) -> DataFrame:
    """``(*key, column, column_rank, error)`` per failed cell, as a table of any size."""
    tests = [
        F.struct(
            F.lit(c).alias("column"), F.lit(i).alias("column_rank"),
            _failed(c, suffix, null_policy).alias("_failed"),
        )
        for i, c in enumerate(columns)
    ]
    cells = table.select(*[F.col(f"`{k}`") for k in key], F.inline(F.array(*tests)))
    return cells.where("_failed").drop("_failed").withColumn("error", F.lit(fixed.EXHAUSTED))


def top_failures(failures: DataFrame, key: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` failures in row, then column order."""
    return failures.orderBy(*key, "column_rank").limit(n)


def run_duration(calls: DataFrame, lane: str, micros: str) -> DataFrame:
    """Duration of a call log and mean seconds per call, by lane."""
    spent = (F.max(micros) - F.min(micros)) / 1_000_000
    return calls.groupBy(lane).agg(F.count(F.lit(1)).alias("total"), spent.alias("seconds")).select(
        lane, "total", "seconds",
        (F.col("seconds") / F.greatest(F.col("total"), F.lit(1))).alias("mean_seconds"),
    )


def provider_usage(cells: DataFrame) -> DataFrame:
    """Successful cells by provider and column, with totals (null stands for all)."""
    used = cells.where(F.col("api").isNotNull())
    return used.rollup("api", "column").agg(F.count(F.lit(1)).alias("used"))
