"""Rate-limit analytics over call logs.

A log has a unique ``key``, a ``lane`` (calls of one lane share a limit) and a
call time in microseconds. A busy lane may hold most of the log, so every
measure is taken over sorted runs rather than a window per lane.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarjuman.fixed import RATE_WINDOW_SECONDS, REQUESTS_PER_MINUTE
from tarjuman.operators.ordered import Measure, add, position, running, sorted_runs

MICROS = 1_000_000


def trailing_calls(
    calls: DataFrame, key: str, lane: str, micros: str, window: int = RATE_WINDOW_SECONDS
) -> DataFrame:
    """Calls of the lane in the closed window ``[t - window, t]`` and the oldest of them.

    Each call asks two questions of its lane's order: how many calls lie before
    the window opens (a mark sorted ahead of calls of that instant) and how many
    by its end (a mark sorted after them).
    """
    marks = F.inline(F.array(
        F.struct((F.col(micros) - window * MICROS).alias("_at"), F.lit(0).alias("_kind")),
        F.struct(F.col(micros).alias("_at"), F.lit(1).alias("_kind")),
        F.struct(F.col(micros).alias("_at"), F.lit(2).alias("_kind")),
    ))
    marked = calls.select(key, lane, micros, marks)
    runs = sorted_runs(marked, [lane, "_at", "_kind", key])
    is_call = F.col("_kind") == 1
    looked = running(
        runs, [lane],
        Measure("_count", is_call.cast("long"), F.sum, add),
        Measure("_next", F.when(is_call, F.col("_at")), F.min, F.least, backwards=True),
    )
    opens, closes = F.col("_kind") == 0, F.col("_kind") == 2
    return looked.groupBy(key, lane, micros).agg(
        (F.max(F.when(closes, F.col("_count"))) - F.max(F.when(opens, F.col("_count"))))
        .alias("calls"),
        F.max(F.when(opens, F.col("_next"))).alias("oldest"),
    )


def wait_time(
    calls: DataFrame, key: str, lane: str, micros: str,
    limit: int = REQUESTS_PER_MINUTE, window: int = RATE_WINDOW_SECONDS,
) -> DataFrame:
    """Seconds the next call would wait if made right after each call."""
    left = window * MICROS - (F.col(micros) - F.col("oldest"))
    wait = F.when(F.col("calls") >= limit, F.greatest(left, F.lit(0))).otherwise(F.lit(0))
    return trailing_calls(calls, key, lane, micros, window).select(
        key, lane, micros, "calls", (wait / MICROS).alias("wait_seconds")
    )


def admission_times(
    calls: DataFrame, key: str, lane: str, micros: str,
    limit: int = REQUESTS_PER_MINUTE, window: int = RATE_WINDOW_SECONDS,
) -> DataFrame:
    """When each call starts if its lane may start ``limit`` calls per window.

    Call ``i`` starts no earlier than call ``i - limit`` plus the window. Along
    each slot ``i % limit`` that is a running maximum of the arrival time less
    one window per completed turn.
    """
    runs = sorted_runs(calls.select(key, lane, micros), [lane, micros, key])
    turned = (
        position(runs, [lane], "_i")
        .withColumn("_slot", F.col("_i") % limit)
        .withColumn("_turn", F.floor(F.col("_i") / limit))
    )
    shift = F.col("_turn") * (window * MICROS)
    slotted = running(
        turned, [lane, "_slot"], Measure("_earliest", F.col(micros) - shift, F.max, F.greatest)
    )
    start = F.col("_earliest") + shift
    return slotted.select(
        key, lane, micros, start.alias("start_micros"),
        ((start - F.col(micros)) / MICROS).alias("delay_seconds"),
    )
