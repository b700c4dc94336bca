"""Joins that stay balanced when one key holds a large share of the rows."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/PARTS of all rows, so there are fewer
# than PARTS hot keys whatever the data: few enough to collect and broadcast.
PARTS = 256
MIN_HOT_ROWS = 100_000


def hot_keys(
    sizes: DataFrame, key: str, size: str, parts: int = PARTS, min_rows: int = MIN_HOT_ROWS
) -> dict[str, int]:
    """Hot keys of ``sizes`` (one row per key), with the number of pieces each needs."""
    total, largest = sizes.agg(F.sum(size), F.max(size)).first()
    fair = max(math.ceil((total or 0) / parts), min_rows)
    if (largest or 0) <= fair:
        return {}
    hot = sizes.where(F.col(size) > fair).select(key, F.ceil(F.col(size) / fair)).collect()
    return {row[0]: row[1] for row in hot}


def salted_join(
    left: DataFrame, right: DataFrame, key: str, spread: list[str], hot: dict[str, int],
    how: str = "left",
) -> DataFrame:
    """Join on ``key``, with the rows of hot keys dealt over several tasks.

    ``right`` holds a key once. A hot key's row there is copied once per piece;
    left rows pick their piece by the hash of the ``spread`` columns.
    """
    if not hot:
        return left.join(right, key, how)
    kind = left.schema[key].dataType.simpleString()
    pieces = F.broadcast(
        left.sparkSession.createDataFrame(list(hot.items()), f"`{key}` {kind}, _pieces int")
    )
    chosen = F.pmod(F.xxhash64(*spread), F.col("_pieces")).cast("int")
    dealt = left.join(pieces, key, "left").withColumn("_piece", F.coalesce(chosen, F.lit(0)))
    copies = F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)
    copied = right.join(pieces, key, "left").withColumn("_piece", F.explode(copies))
    joined = dealt.drop("_pieces").join(copied.drop("_pieces"), [key, "_piece"], how)
    return joined.drop("_piece")
