"""Retry and fallback as set-wise rounds, and views over the attempts."""

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

from tarjuman import fixed
from tarjuman.functions.quality import CHECKS, is_valid, postprocess, quality_checks
from tarjuman.sources.scans import path_exists


REQUEST = ["text_key", "prompt", "original_length", "n_cells"]
# The attempts table, but for the partition columns ``batch_id`` and ``round``.
_FIELDS = [
    ("text_key", StringType()), ("prompt", StringType()),
    ("original_length", IntegerType()), ("n_cells", LongType()),
    ("api", StringType()), ("api_rank", IntegerType()), ("attempt", IntegerType()),
    ("success", BooleanType()), ("error", StringType()),
    *[(check, BooleanType()) for check in (*CHECKS, "is_valid", "settled")],
    ("translation", StringType()),
]
ATTEMPTS = StructType([StructField(name, kind) for name, kind in _FIELDS])


def run_rounds(
    requests: DataFrame,
    providers: Sequence,
    folder: str,
    max_retries: int = fixed.MAX_RETRIES,
    backoff: float = fixed.BACKOFF_MULTIPLIER,
    script: str = fixed.ARABIC,
    resume: bool = False,
) -> None:
    """Ask each provider up to ``max_retries`` times until a reply is valid.

    ``requests`` holds ``(text_key, prompt, original_length, n_cells)``. A round
    calls one provider once for everything still open and writes the attempts to
    ``folder/round=N``; the next round reads the open part of that table. So
    rounds need no shuffle, repeat no call, and a run that stops keeps what its
    finished rounds settled. With ``resume`` the finished rounds in ``folder``, made of
    the same requests, are taken as they are and the rest goes on from them.
    """
    spark = requests.sparkSession
    pending = requests.select(REQUEST)
    tries = [(r, p, a) for r, p in enumerate(providers, 1) for a in range(1, max_retries + 1)]
    for number, (rank, provider, attempt) in enumerate(tries, start=1):
        target = f"{folder}/round={number}"
        made = not (resume and path_exists(spark, f"{target}/_SUCCESS"))
        if made:
            last = number == len(tries)
            _write_round(provider.answer(pending, attempt), provider.name, rank, attempt, last, script, target)
        written = spark.read.schema(ATTEMPTS).parquet(target)
        pending = written.where(~F.col("settled")).select(REQUEST)
        if pending.isEmpty():
            return
        if made and provider.remote and attempt < max_retries:
            time.sleep(backoff ** (attempt - 1))


def _write_round(
    answered: DataFrame, api: str, rank: int, attempt: int, last: bool, script: str, target: str,
) -> None:
    settled = F.col("is_valid") | F.lit(last)
    judged(answered, script).withColumn("settled", settled).select(
        "text_key",
        # A settled request needs its prompt no more.
        F.when(~F.col("settled"), F.col("prompt")).alias("prompt"),
        "original_length",
        "n_cells",
        F.lit(api).alias("api"),
        F.lit(rank).alias("api_rank"),
        F.lit(attempt).alias("attempt"),
        "success", "error", *CHECKS, "is_valid", "settled",
        F.when(F.col("is_valid"), postprocess(F.col("translation"))).alias("translation"),
    ).write.mode("overwrite").parquet(target)


def judged(answered: DataFrame, script: str = fixed.ARABIC) -> DataFrame:
    """Add the five checks and ``is_valid`` to replies."""
    checks = quality_checks(F.col("original_length"), F.col("translation"), script)
    checked = answered.withColumns(checks)
    verdict = F.col("success") & is_valid({name: F.col(name) for name in CHECKS})
    return checked.withColumn("is_valid", F.coalesce(verdict, F.lit(False)))


def outcomes(attempts: DataFrame, *more: str) -> DataFrame:
    """One row per settled request: its translation, or why there is none, and columns of ``more``.

    A request is settled by one attempt only, so no shuffle is needed to find it.
    """
    return attempts.where("settled").select(
        "text_key",
        "translation",
        F.when(F.col("is_valid"), F.col("api")).alias("api"),
        F.when(~F.col("is_valid"), F.lit(fixed.EXHAUSTED)).alias("error"),
        *more,
    )


def first_valid(attempts: DataFrame, key: list[str]) -> DataFrame:
    """Earliest valid attempt per cell, by provider rank, then attempt number.

    A cell has no more rows than providers times retries, and Spark keeps only
    the first of each map task before it shuffles.
    """
    order = Window.partitionBy(*key).orderBy("api_rank", "attempt")
    return (
        attempts.where("is_valid").withColumn("_place", F.row_number().over(order))
        .where("_place = 1").drop("_place")
    )


def exhausted_cells(cells: DataFrame, accepted: DataFrame, key: list[str]) -> DataFrame:
    """Cells without an accepted attempt, with the reason."""
    lost = cells.select(*key).join(accepted.select(*key), key, "left_anti")
    return lost.withColumn("error", F.lit(fixed.EXHAUSTED))


def attempts_made(attempts: DataFrame, key: list[str]) -> DataFrame:
    """Only the attempts a cell-by-cell run would have made: none after a valid one."""
    order = F.col("api_rank") * 1_000_000 + F.col("attempt")
    first = F.min(F.when(F.col("is_valid"), order)).over(Window.partitionBy(*key))
    return (
        attempts.withColumns({"_order": order, "_first": first})
        .where(F.col("_first").isNull() | (F.col("_order") <= F.col("_first")))
        .drop("_order", "_first")
    )


def outcome_name() -> Column:
    """``error``, ``rejected`` or ``accepted``."""
    return (
        F.when(F.col("is_valid"), "accepted").when(F.col("success"), "rejected").otherwise("error")
    )


def attempt_outcomes(attempts: DataFrame, weight: Column | None = None) -> DataFrame:
    """Attempts per provider and outcome. ``weight`` counts an attempt several times,
    for tables in which one request stands for many equal cells."""
    size = weight if weight is not None else F.lit(1)
    return attempts.groupBy("api", outcome_name().alias("outcome")).agg(
        F.sum(size).cast("long").alias("attempts")
    )


def validation_summary(attempts: DataFrame) -> DataFrame:
    """How often each check failed, per provider, among replies received."""
    received = attempts.where(F.col("success") & F.col("not_empty").isNotNull())
    return received.groupBy("api").agg(
        F.count(F.lit(1)).alias("replies"),
        *[F.count_if(~F.col(check)).alias(f"failed_{check}") for check in CHECKS],
    )


def backoff_seconds(
    attempts: DataFrame, key: list[str],
    max_retries: int = fixed.MAX_RETRIES, multiplier: float = fixed.BACKOFF_MULTIPLIER,
) -> DataFrame:
    """Seconds a cell-by-cell run sleeps per cell: after each failed attempt of a
    provider but its last."""
    slept = F.when(
        ~F.col("is_valid") & (F.col("attempt") < max_retries),
        F.pow(F.lit(float(multiplier)), F.col("attempt") - 1),
    ).otherwise(F.lit(0.0))
    return attempts_made(attempts, key).groupBy(*key).agg(
        F.count(F.lit(1)).alias("attempts"), F.sum(slept).alias("backoff_seconds")
    )
