"""Line dedup by overlapping three-line windows.

Every three consecutive lines of a document are a window. A window that occurs again
anywhere stays where it occurs first, by (doc_id, fingerprint of the text, place); the
lines of its later occurrences go. Covered places of overlapping windows are merged.

Windows travel as 128-bit hashes. A hash is counted by partial aggregation, so a window
that is everywhere costs one row per task; the join back has one row per hash on one
side, and its other side may be split.

Defined cases: null texts stay null; texts of fewer than three lines, and windows
without a word, are left alone; rows equal in doc_id and text are one document and get
the same result; a text whose lines all go becomes empty; an empty table gives an empty
result; other columns are carried along.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarjuman.llm.common import KEY, text_key
from tarjuman.workspace import materialize

LINES = 3


def runs(places: Column, reach: Column | int = 1) -> Column:
    """Sorted places as array of ``struct(first, last)``: next to each other by at most ``reach``."""
    before = lambda i: F.get(places, i - 1)
    after = lambda i: F.get(places, i + 1)
    starts = F.filter(places, lambda p, i: (i == 0) | (p > before(i) + reach))
    ends = F.filter(places, lambda p, i: (i == F.size(places) - 1) | (after(i) > p + reach))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def windows_of(docs: DataFrame, text: str, order: Column) -> DataFrame:
    """One row per window: its hash, the document's key and place in order, the first line's place."""
    lines = F.split(F.col(text), "\n", -1)
    kept = docs.select(*text_key("_doc_id", text), order.alias("_order"), lines.alias("_lines"))
    kept = kept.where(F.size("_lines") >= LINES)
    # By place: ``slice`` would walk the array from its start for every window.
    window = lambda i: [F.get("_lines", i + k) for k in range(LINES)]
    found = F.transform(
        F.sequence(F.lit(0), F.size("_lines") - LINES),
        lambda i: F.when(
            F.concat(*window(i)).rlike(r"[^\x20\x09-\x0D]"),
            F.struct(
                i.alias("at"), F.xxhash64(*window(i)).alias("h1"), F.xxhash64(F.lit("w"), *window(i)).alias("h2"),
            ),
        ),
    )
    placed = kept.select(*KEY, "_order", F.explode(F.filter(found, lambda w: w.isNotNull())).alias("w"))
    return placed.select(*KEY, "_order", "w.at", "w.h1", "w.h2")


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later occurrences of repeated windows cut from ``text``, and ``n_removed`` lines."""
    names = [c for c in docs.columns if c != "n_removed"]
    # The caller's columns travel in one, so that their names are free.
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    source = docs.select(row.alias("_row"), F.col(f"`{doc_id}`").alias("_doc_id"), F.col(f"`{text}`").alias("_text"))
    windows = windows_of(source, "_text", F.col("_doc_id"))
    place = F.struct("_order", "_fp", "_len", "at")
    repeated = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    repeated = repeated.where("n > 1").drop("n")
    later = windows.join(repeated, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    covered = later.groupBy(*KEY).agg(F.array_sort(F.collect_set("at")).alias("_places"))
    # Windows that overlap or touch are one run of lines, and every line of it goes.
    merged = runs(F.col("_places"), LINES)
    gone = F.flatten(F.transform(merged, lambda r: F.sequence(r.first, r.last + LINES - 1)))
    cuts = materialize(covered.select(*KEY, gone.alias("_gone")), "line-cuts")
    keyed = source.select("_row", "_text", *text_key("_doc_id", "_text"))
    # Always by shuffle: the cuts grow with the input, so broadcasting them would not last.
    marked = keyed.join(cuts.hint("merge"), KEY, "left")
    marked = marked.withColumn("_lines", F.when(F.col("_gone").isNotNull(), F.split("_text", "\n", -1)))
    # By hash and by place, so in time linear in the lines.
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    kept = F.when(F.col("_gone").isNotNull(), F.transform(left, lambda i: F.get("_lines", i)))
    cut = marked.withColumn("_kept", kept)
    removed = F.coalesce(F.size("_lines") - F.size("_kept"), F.lit(0)).cast("long")
    new_text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join("_kept", "\n"))
    removed = F.when(F.col("_gone").isNull(), F.lit(0).cast("long")).otherwise(removed)
    return cut.select(
        *[new_text.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in names], removed.alias("n_removed"))
