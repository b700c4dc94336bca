"""Benchmark decontamination by winnowing.

Of every 13 consecutive words, winnowing keeps the smallest hash of its 6-word grams.
Equal spans of 13 words keep equal hashes, so a document that shares such a span with
a benchmark item shares a fingerprint. Fingerprints find candidate documents; there the
hits are extended to every place where a whole 13-word window of an item occurs. Items
of fewer words are one window each and are looked up by all grams of that length.

Only DataFrame expressions. Fingerprints and windows of the benchmark are written once;
they are broadcast only if their count says that they are small, else joined.

Defined cases: null and word-free texts have no words, are never hit, and as items hit
nothing; a null item id counts as the empty string, and rows of one item id count once;
rows equal in doc_id and text share one result; an empty benchmark hits nothing; other
columns of the documents are carried along.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarjuman.llm.common import KEY, ascii_lower, text_key
from tarjuman.llm.lines import runs
from tarjuman.workspace import materialize

WINDOW, GRAM = 13, 6
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A table of at most so many rows of two numbers is broadcast: a few megabytes.
MOST_BROADCAST = 200_000


def words_of(text: Column) -> Column:
    words = F.filter(F.split(ascii_lower(text), NOT_WORD), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def gram(words: Column, first: Column, length: int) -> list[Column]:
    """The words of a gram by their places; ``slice`` would walk the array from its start."""
    return [F.get(words, first + k) for k in range(length)]


def gram_hashes(words: Column, length: int) -> Column:
    """Hashes of all grams of ``length`` words, in order; null if there are too few words."""
    grams = F.transform(
        F.sequence(F.lit(0), F.size(words) - length),
        lambda i: F.xxhash64(F.lit(length), *gram(words, i, length)),
    )
    return F.when(F.size(words) >= length, grams)


def winnow(grams: Column) -> Column:
    """The smallest hash of each ``WINDOW - GRAM + 1`` neighbours, each once."""
    span = WINDOW - GRAM + 1
    least = F.transform(F.sequence(F.lit(0), F.size(grams) - span), lambda i: F.least(*gram(grams, i, span)))
    return F.when(F.size(grams) >= span, F.array_distinct(least))


def window_hashes(words: Column, lengths: list[int]) -> Column:
    """All windows of the given lengths as structs: first word, length, 128-bit hash."""
    def of(length: int) -> Column:
        found = F.transform(
            F.sequence(F.lit(0), F.size(words) - length),
            lambda i: F.struct(
                i.alias("at"), F.lit(length).alias("length"),
                F.xxhash64(F.lit(length), *gram(words, i, length)).alias("h1"),
                F.xxhash64(F.lit("w"), *gram(words, i, length)).alias("h2"),
            ),
        )
        return F.when(F.size(words) >= length, found)

    empty = F.array().cast("array<struct<at:int,length:int,h1:bigint,h2:bigint>>")
    return F.concat(*[F.coalesce(of(n), empty) for n in lengths])


def small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MOST_BROADCAST else df


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` of hit words, ``item_ids`` and ``contaminated``."""
    added = ["n_words", "n_hit", "spans", "item_ids", "contaminated"]
    names = [c for c in docs.columns if c not in added]
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(item_text)).alias("words")
    ).where(F.size("words") > 0)
    # Items with the same words are one class, so copies of an item are not looked up again.
    items = items.groupBy("words").agg(F.collect_set("item").alias("items"))
    items = materialize(items.withColumn("class", F.expr("uuid()")), "items")
    lengths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(WINDOW))).distinct().collect())
    words = F.col("words")

    def fingerprints(df: DataFrame, *keep: str) -> DataFrame:
        none = F.array().cast("array<bigint>")
        # Columns of their own, so that a window over the grams does not compute them anew.
        df = df.withColumn("grams", F.coalesce(gram_hashes(words, GRAM), none))
        kinds = [winnow(F.col("grams")) if n == WINDOW else F.array_distinct(gram_hashes(words, n)) for n in lengths]
        return df.select(*keep, F.explode(F.concat(*[F.coalesce(k, none) for k in kinds])).alias("fingerprint"))

    # The caller's columns travel in one, so that their names are free.
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    source = docs.select(row.alias("_row"), F.col(f"`{doc_id}`").alias("_doc_id"), F.col(f"`{text}`").alias("_text"))
    own_columns = [F.col("_row").getField(c).alias(c) for c in names]
    keyed = source.select("_row", "_text", *text_key("_doc_id", "_text"))
    counted = keyed.withColumn("n_words", F.size(words_of(F.col("_text"))).cast("long"))
    if not lengths:
        return counted.select(
            *own_columns, "n_words", F.lit(0).cast("long").alias("n_hit"),
            F.array().cast("array<struct<first:int,last:int>>").alias("spans"),
            F.array().cast("array<string>").alias("item_ids"), F.lit(False).alias("contaminated"),
        )
    marks = materialize(fingerprints(items).distinct(), "item-fingerprints")
    texts = keyed.select(*KEY, words_of(F.col("_text")).alias("words"))
    # An item's fingerprints hold those of all windows it has; a longer document's may be found by others.
    near = fingerprints(texts, *KEY).join(small(marks, marks.count()), "fingerprint", "left_semi")
    near = materialize(near.select(*KEY).distinct(), "candidates")
    own_length = F.least(F.size(words), F.lit(WINDOW))
    windows = items.select("class", F.explode(window_hashes(words, lengths)).alias("w"), own_length.alias("own"))
    windows = windows.where("w.length = own").select("class", "w.h1", "w.h2").distinct()
    windows = materialize(windows, "item-windows")
    n_windows = windows.count()
    candidates = texts.join(near, KEY, "left_semi").dropDuplicates(KEY)
    placed = candidates.select(*KEY, F.explode(window_hashes(words, lengths)).alias("w")).select(*KEY, "w.*")
    hits = placed.join(small(windows.select("h1", "h2").distinct(), n_windows), ["h1", "h2"], "left_semi")
    hits = materialize(hits, "hits")
    covered = hits.select(*KEY, F.explode(F.sequence(F.col("at"), F.expr("at + length - 1"))).alias("word")).distinct()
    covered = covered.groupBy(*KEY).agg(F.array_sort(F.collect_list("word")).alias("_words"))
    named = (
        hits.select(*KEY, "h1", "h2").distinct().join(small(windows, n_windows), ["h1", "h2"])
        .select(*KEY, "class").distinct().join(items.select("class", "items"), "class")
        .groupBy(*KEY).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"))
    )
    found = covered.select(
        *KEY, F.size("_words").cast("long").alias("_hit"), runs(F.col("_words")).alias("_spans")
    ).join(named, KEY)
    result = counted.join(materialize(found, "contaminated"), KEY, "left")
    hit = F.coalesce("_hit", F.lit(0))
    return result.select(
        *own_columns, "n_words", hit.cast("long").alias("n_hit"),
        F.coalesce("_spans", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )
