"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in parts by a hash. How many rows of each part go to each shard is drawn first:
a uniform shuffle of all rows makes these counts multivariate hypergeometric, with the
parts' sizes as row sums and the shards' exact sizes as column sums. A part then permutes
its rows by a second hash and cuts them by its row of the matrix; rows are exchanged; and
each shard permutes what it got, by buckets of a third hash and within them by a fourth.

The matrix is drawn on two levels: for blocks of parts on the driver (one number per
block and shard, a block being about ``PARTS * ROWS`` rows), then inside each block by a
task, which is the same distribution. No task holds a shard or more than a part or bucket.

Only ids, sizes and fingerprints travel. Equal rows are counted before they are shuffled
and told apart by copy numbers, so a row that occurs very often is dealt out like others.
All draws and hashes depend on the rows and the seed alone: reruns agree, whatever the
partitions of the input.

Defined cases: a null text has no bytes and crc32 0; null and repeated ids are rows like
others; equal rows are interchangeable; an empty table gives no rows; fewer rows than
shards leave shards empty; other columns stay with their rows in ``write_shards``.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarjuman.operators.shape import free_name
from tarjuman.workspace import materialize

ROWS, PARTS = 4096, 1024
COPIES = 65_536
KEY = ["doc_id", "print", "size", "text_crc32"]
_SPREADS = 13.0


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Good ones among ``sample`` drawn from ``good + bad``, for populations of any size.

    The probabilities follow from their ratios, outward from the mode to ``_SPREADS``
    standard deviations, where less than the rounding of a double is left.
    """
    low, high = max(0, sample - bad), min(good, sample)
    if low == high:
        return low
    total = good + bad
    mode = min(max((sample + 1) * (good + 1) // (total + 2), low), high)
    spread = math.sqrt(sample * (good / total) * (bad / total) * ((total - sample) / max(total - 1, 1)))
    reach = int(_SPREADS * spread) + 40
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    step = np.log(good - k) + np.log(sample - k) - np.log(k + 1) - np.log(bad - sample + k + 1)
    level = np.concatenate([[0.0], np.cumsum(step)])
    weight = np.exp(level - level.max())
    steps = np.cumsum(weight)
    return first + int(np.searchsorted(steps, rng.random() * steps[-1], side="right"))


def draw_matrix(sizes: list[int], room: list[int], seed: list[int]) -> list[list[int]]:
    """Per part the number of its rows for each shard; rows add up to ``sizes``, columns to ``room``."""
    rng, room, matrix = np.random.default_rng(seed), list(room), []
    for size in sizes:
        left, behind, own = size, sum(room), []
        for place in room:
            behind -= place
            own.append(hypergeometric(rng, place, behind, left))
            left -= own[-1]
        room = [r - o for r, o in zip(room, own)]
        matrix.append(own)
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def row_print(df: DataFrame) -> Column:
    """A hash of the whole row; maps, which have no hash, go in as JSON."""
    def hashable(name: str, kind: str) -> Column:
        own = F.col(f"`{name}`")
        return F.to_json(F.struct(own)) if "map<" in kind or "variant" in kind else own

    return F.xxhash64(*[hashable(f.name, f.dataType.simpleString()) for f in df.schema.fields])


def _hash(seed: int, use: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(use), *KEY, "copy")


def _copies(rows: DataFrame, most: int) -> DataFrame:
    """A row per copy; the copies of one row are made by many tasks if they are many."""
    lots = rows.withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES))))
    if most > COPIES:
        lots = lots.repartition(*KEY, "lot")
    first = F.col("lot") * COPIES
    last = F.least(first + COPIES, F.col("n")) - 1
    return lots.withColumn("copy", F.explode(F.sequence(first, last))).drop("lot", "n")


def place_rows(docs: DataFrame, shards: int, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, print, size, text_crc32, copy, shard, slot)`` of every row.

    ``print`` is a hash of the whole row; ``copy`` numbers the rows equal in the first four.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), row_print(docs).alias("print"),
        (F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(f"`{text}`")), F.lit(0)).alias("text_crc32"),
    )
    rows = materialize(rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")), "rows")
    total, most = (x or 0 for x in rows.agg(F.sum("n"), F.max("n")).first())
    n_parts = max(1, -(-total // ROWS))
    parted = _copies(rows, most).withColumn("part", F.pmod(_hash(seed, 1), F.lit(n_parts)))

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        room = list(group["room"].iloc[0])
        matrix = draw_matrix(group["rows"].tolist(), room, [seed, 2, int(group["block"].iloc[0])])
        return pd.DataFrame({"part": group["part"], "upto": np.cumsum(matrix, axis=1).tolist()})

    sizes = parted.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    sizes = materialize(sizes.withColumn("block", F.floor(F.col("part") / PARTS).cast("long")), "part-sizes")
    blocks = sizes.groupBy("block").agg(F.sum("rows").alias("rows")).orderBy("block").collect()
    rooms = draw_matrix([b["rows"] for b in blocks], shard_sizes(total, shards), [seed, 1])
    rooms = docs.sparkSession.createDataFrame(
        [(b["block"], own) for b, own in zip(blocks, rooms)], "block long, room array<long>")
    matrix = sizes.join(rooms, "block").groupBy("block").applyInPandas(plan, "part long, upto array<long>")
    # A row of the matrix per part, that is per ROWS rows.
    matrix = materialize(matrix, "matrix")

    within = W.partitionBy("part").orderBy(_hash(seed, 2), *KEY, "copy")
    ranked = parted.withColumn("rank", F.row_number().over(within) - 1).join(matrix, "part")
    shard = F.size(F.filter("upto", lambda end: end <= F.col("rank"))).cast("int")
    sent = ranked.select(*KEY, "copy", shard.alias("shard"))
    n_buckets = max(1, -(-total // (shards * ROWS)))
    sent = sent.withColumn("bucket", F.pmod(_hash(seed, 3), F.lit(n_buckets)))
    sent = materialize(sent, "exchanged")
    earlier = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    # A row per bucket, that is per ROWS rows of a shard.
    starts = sent.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows")).select(
        "shard", "bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    again = W.partitionBy("shard", "bucket").orderBy(_hash(seed, 4), *KEY, "copy")
    placed = sent.withColumn("at", F.row_number().over(again) - 1).join(starts, ["shard", "bucket"])
    return placed.select(*KEY, "copy", "shard", (F.col("start") + F.col("at")).cast("long").alias("slot"))


def write_shards(
    docs: DataFrame, folder: str, shards: int, seed: int = 0, doc_id: str = "doc_id", text: str = "text",
) -> tuple[str, str]:
    """Write every row of ``docs`` to its shard below ``folder``, in order of its slot.

    Returns the names of the partition column and of the slot column: ``shard`` and
    ``slot`` unless ``docs`` has such columns.
    """
    shard, slot = free_name(docs.columns, "shard"), free_name(docs.columns, "slot")
    places = materialize(place_rows(docs, shards, seed, doc_id, text), "places")
    lot = F.floor(F.col("copy") / COPIES).alias("lot")
    rows = docs.select(
        row_print(docs).alias("print"), F.col(f"`{doc_id}`").alias("doc_id"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # Equal rows once, with as many lots as their copies need.
    rows = rows.groupBy("doc_id", "print").agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES)))).drop("n")
    left = places.select(F.col("doc_id").alias("id"), "print", lot, F.col("shard").alias("_s"), F.col("slot").alias("_t"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (left["print"] == rows["print"]) & (left["lot"] == rows["lot"])
    full = left.join(rows, same).select(F.col("_s").alias("s"), F.col("_t").alias("t"), "row")
    ordered = full.repartitionByRange("s", "t").sortWithinPartitions("s", "t")
    ordered.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("s").alias(shard),
                   F.col("t").alias(slot)).write.partitionBy(shard).parquet(folder)
    return shard, slot
