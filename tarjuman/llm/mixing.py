"""Mixing sources to target weights along a time-varying curriculum.

Each source has a demand curve over training time 0..1: its weight schedule, linear
between knots, scaled so that its integral is the source's token target. A source's
documents lie one after another on a token line, in the order of a hash; a copy of a
document that starts a further pass over the source lies one source size further on.
Inverting the integrated demand at a copy's place gives its training position; copies
beyond the target have none and are not taken.

Only DataFrame expressions: running sizes come from windows over (source, bucket of
the hash) plus bucket totals, so that no task holds a whole source.

Defined cases: a null text has size 0; a null source is a source of its own, last in
order; repeated rows are placed one after another; a source without words gets target
0; an empty table gives an empty result; other columns are carried along unchanged.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarjuman.llm.common import word_count

WEIGHTS = (1, 2, 3)
MOST_PASSES = 3
ROWS_PER_BUCKET = 20_000
#: Weight over training time at evenly spaced knots, by weight class: light sources
#: early, heavy ones late. Only the shape matters; the integral is the target.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(_source, source_size, _mix_class, target)`` from one row per ``_source``.

    Sources share all words by weight; none gets more than ``MOST_PASSES`` times its
    size, what is over goes to the rest by weight. The common level is the highest of
    the levels that follow from taking the first k sources, by room per weight, as full.
    """
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_room = W.orderBy(F.col("_room"), "_rank")
    before = by_room.rowsBetween(W.unboundedPreceding, -1)
    ranked = sizes.withColumn("_rank", F.row_number().over(W.orderBy("_source")))
    shared = (
        ranked.withColumn("_mix_class", (F.col("_rank") - 1) % len(WEIGHTS))
        .withColumn("_weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("_mix_class") + 1))
        .withColumn("_most", MOST_PASSES * F.col("source_size"))
        .withColumn("_room", F.col("_most") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_weights", F.sum("_weight").over(everything))
        .withColumn("_full", F.coalesce(F.sum("_most").over(before), F.lit(0)))
        .withColumn("_past", F.coalesce(F.sum("_weight").over(before), F.lit(0)))
        .withColumn("_level", (F.col("_total") - F.col("_full")) / (F.col("_weights") - F.col("_past")))
        .withColumn("_level", F.max("_level").over(everything))
    )
    target = F.least(F.col("_most").cast("double"), F.col("_level") * F.col("_weight"))
    return shared.select("_source", "source_size", "_mix_class", target.alias("target"))


def invert_demand(share: Column, knots: Column) -> Column:
    """Time by which ``share`` of the integral of a piecewise linear schedule is used."""
    step = F.lit(1.0) / (F.size(knots) - 1)
    pieces = F.transform(
        F.sequence(F.lit(1), F.size(knots) - 1),
        lambda k: F.struct(
            (step * (k - 1)).alias("t"), F.element_at(knots, k).alias("a"),
            F.element_at(knots, k + 1).alias("b"),
        ),
    )
    area = F.aggregate(pieces, F.lit(0.0), lambda s, p: s + (p.a + p.b) / 2 * step)
    start = F.struct((share * area).alias("left"), F.lit(None).cast("double").alias("time"))

    def walk(state, p):
        own = (p.a + p.b) / 2 * step
        slope = (p.b - p.a) / step
        root = F.sqrt(F.greatest(p.a * p.a + 2 * slope * state.left, F.lit(0.0)))
        within = p.t + F.when(p.a + root > 0, 2 * state.left / (p.a + root)).otherwise(0.0)
        return F.struct(
            (state.left - own).alias("left"),
            F.coalesce(state.time, F.when(state.left < own, within)).alias("time"),
        )

    return F.coalesce(F.aggregate(pieces, start, walk, lambda s: s.time), F.lit(1.0))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    schedules=SCHEDULES,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``positions``: the training
    times of its copies, none for a document the mix leaves out.

    Columns of these names are replaced.
    """
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "positions")]
    digits = 2
    while 16 ** digits * ROWS_PER_BUCKET < docs.count():
        digits += 1
    own_id, own_text, own_source = (F.col(f"`{c}`") for c in (doc_id, text, source))
    sized = docs.select(
        # The caller's columns travel in one, so that their names are free.
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        word_count(own_text).alias("size"), own_id.alias("_doc_id"),
        F.coalesce(F.md5(own_text), F.lit("")).alias("_print"),
        # Null last: the key sorts by code point behind its mark.
        F.when(own_source.isNull(), "1").otherwise(F.concat(F.lit("0"), own_source.cast("string"))).alias("_source"),
        F.md5(F.coalesce(own_id.cast("string"), F.lit(""))).alias("_mix_hash"),
    ).withColumn("_bucket", F.substring("_mix_hash", 1, digits))
    buckets = sized.groupBy("_source", "_bucket").agg(F.sum("size").alias("_own"))
    targets = source_targets(buckets.groupBy("_source").agg(F.sum("_own").alias("source_size")))
    earlier = W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = buckets.withColumn("_offset", F.coalesce(F.sum("_own").over(earlier), F.lit(0)))
    plan = offsets.drop("_own").join(targets, "_source")
    own = (
        W.partitionBy("_source", "_bucket")
        .orderBy("_mix_hash", F.col("_doc_id").asc_nulls_first(), "_print")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    placed = sized.withColumn("_before", F.coalesce(F.sum("size").over(own), F.lit(0)))
    placed = placed.join(plan, ["_source", "_bucket"])
    knots = F.element_at(
        F.array(*[F.array(*[F.lit(float(v)) for v in s]) for s in schedules]), F.col("_mix_class") + 1
    )
    middle = F.col("_offset") + F.col("_before") + F.col("size") / 2
    places = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(MOST_PASSES - 1)),
                    lambda turn: turn * F.col("source_size") + middle),
        lambda place: place < F.col("target"),
    )
    positions = F.transform(places, lambda place: invert_demand(place / F.col("target"), knots))
    # In a step of its own, as the caller's columns below may be called like what it reads.
    return placed.withColumn("positions", positions).select(
        "size", "source_size", "target", "positions", "_row",
    ).select(*[F.col("_row").getField(c).alias(c) for c in names], "size", "source_size", "target", "positions")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy, range-sorted by ``position``."""
    copies = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return copies.repartitionByRange("position").sortWithinPartitions("position")
