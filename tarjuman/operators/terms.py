"""Term mappings kept as tables.

A long table of terms stays a table. The words of each text that stand between word
boundaries are joined with the terms, and each text is changed by its own terms only, in
their order. What a replacement brings about is looked up in turn, until no text has new
words; there are as many turns as replacements lead to further terms.
"""

from collections.abc import Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tarjuman import fixed
from tarjuman.functions.term_search import TermSearch, fold, slot, words_within
from tarjuman.functions.text import LONGEST_CHAIN
from tarjuman.operators.skew import hot_keys, salted_join
from tarjuman.workspace import materialize


def default_terms(spark: SparkSession) -> DataFrame:
    """``(term, replacement, rank)`` of the default mapping."""
    rows = [(t, r, i) for i, (t, r) in enumerate(fixed.TERM_REPLACEMENTS.items())]
    return spark.createDataFrame(rows, "term string, replacement string, rank long")


def merge_terms(base: DataFrame, custom: DataFrame) -> DataFrame:
    """Override ``base`` by exact term, append new terms after it.

    Both sides hold ``(term, replacement, rank)``, a term once. The result adds
    ``term_length``: terms apply by descending length, then by ascending rank.
    """
    size = base.agg(F.coalesce(F.max("rank") + 1, F.lit(0))).scalar()
    ours = custom.select("term", F.col("replacement").alias("_new"), F.col("rank").alias("_added"))
    merged = base.join(ours, "term", "full_outer")
    return merged.select(
        "term",
        F.coalesce("_new", "replacement").alias("replacement"),
        F.coalesce(F.col("rank"), size + F.col("_added")).cast("long").alias("rank"),
        F.length("term").alias("term_length"),
    )


def terms_as_mapping(terms: DataFrame) -> dict[str, str]:
    """A term table as the mapping the text functions take, in rank order.

    A mapping is a setting that every worker holds, so it is held here whole.
    """
    rows = terms.select("term", "replacement", "rank").collect()
    return {row["term"]: row["replacement"] for row in sorted(rows, key=lambda r: r["rank"])}


def as_mapping(custom: Mapping[str, str] | DataFrame | None) -> Mapping[str, str] | None:
    """Custom terms as a mapping; a table of them is merged with the defaults first."""
    if not isinstance(custom, DataFrame):
        return custom
    return terms_as_mapping(merge_terms(default_terms(custom.sparkSession), custom))


def is_long(custom: Mapping[str, str] | DataFrame | None) -> bool:
    """Whether the terms are a table of more rows than a mapping should hold."""
    return isinstance(custom, DataFrame) and custom.limit(LONGEST_CHAIN + 1).count() > LONGEST_CHAIN


_TERM = StructType([
    StructField("own", LongType()), StructField("rank", LongType()),
    StructField("term", StringType()), StructField("replacement", StringType()),
])


def keyed_terms(custom: DataFrame) -> DataFrame:
    """``(word, slot, size, *_TERM)`` of the default and the custom terms, a term once.

    Of a repeated term the first rank and the last replacement hold, as in a mapping.
    """
    merged = merge_terms(default_terms(custom.sparkSession), custom.where("term is not null"))
    last = F.max_by(F.struct("replacement"), F.coalesce("rank", F.lit(2**62)))
    once = merged.where("term <> ''").groupBy("term").agg(
        F.min(F.coalesce("rank", F.lit(2**62))).alias("rank"), last["replacement"].alias("replacement"))
    own = (~F.col("term").isin(list(fixed.TERM_REPLACEMENTS))).cast("long").alias("own")

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch["term"].map(fold)
            yield batch.assign(word=words, slot=words.map(slot), size=words.map(len))

    more = [StructField("word", StringType()), StructField("slot", LongType()), StructField("size", LongType())]
    schema = StructType([*_TERM.fields, *more])
    return materialize(once.select(own, "rank", "term", "replacement").mapInPandas(keyed, schema), "terms")


def replace_terms(prompts: DataFrame, key: str, custom: DataFrame) -> DataFrame:
    """``prompts``, one row per ``key``, with the default and ``custom`` terms replaced in
    ``prompt``: as :func:`normalize_terms` does, for a table of terms of any size.

    A text with a term whose replacement is null becomes null.
    """
    terms, columns = keyed_terms(custom), prompts.columns
    # Bounded sets: slots are of a fixed number, lengths are those of words.
    slots, sizes = terms.agg(F.collect_set("slot"), F.collect_set("size")).first()
    slots, sizes = frozenset(slots), sorted(sizes)
    by_word = terms.groupBy("word").agg(F.collect_list(F.struct(*_TERM.names)).alias("_own"))

    def found(wanted: DataFrame) -> DataFrame:
        wanted = materialize(wanted, "words")
        hot = hot_keys(wanted.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word", "n")
        hits = salted_join(wanted, by_word, "word", [key], hot, "inner")
        return hits.groupBy(key).agg(F.flatten(F.collect_list("_own")).alias("_new"))

    kind = prompts.schema[key]
    wanted = prompts.select(key, "prompt").mapInPandas(
        _words_of(key, sizes, slots), StructType([kind, StructField("word", StringType())]))
    none = F.array().cast("array<string>")
    todo = prompts.withColumns({"_known": F.lit(None).cast(ArrayType(_TERM)), "_seen": none})
    more = [StructField("_result", StringType()), StructField("_asked", ArrayType(StringType()))]
    done = []
    while True:
        # Without new terms the result of a turn before stays.
        told = todo.join(found(wanted), key, "left")
        known = F.concat(F.coalesce("_known", F.array().cast(ArrayType(_TERM))), F.coalesce("_new", F.array().cast(ArrayType(_TERM))))
        told = told.withColumn("_known", known).drop("_new")
        told = materialize(
            told.mapInPandas(_replaced(sizes, slots), StructType([*told.schema.fields, *more])), "replaced")
        done.append(told.where(F.size("_asked") == 0).withColumn("prompt", F.col("_result")).select(columns))
        todo = told.where(F.size("_asked") > 0)
        if todo.isEmpty():
            return reduce(DataFrame.unionByName, done)
        wanted = todo.select(key, F.explode("_asked").alias("word"))
        todo = todo.withColumn("_seen", F.concat("_seen", "_asked")).drop("_result", "_asked")


def _words_of(key: str, sizes, slots):
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["prompt"].map(lambda t: sorted(words_within(t, sizes, slots)) if isinstance(t, str) else [])
            yield batch[[key]].assign(word=own).explode("word").dropna(subset=["word"])

    return words


def _replaced(sizes, slots):
    def one(text: str, known, seen) -> tuple[str | None, list[str]]:
        if not isinstance(text, str) or not len(known):
            return text, []
        ordered = sorted(known, key=lambda t: (-len(t["term"]), t["own"], t["rank"], t["term"]))
        asked: set[str] = set()

        def changed(now: str, low: int, high: int) -> None:
            asked.update(words_within(now, sizes, slots, low, high))

        pairs = [(t["term"], "" if t["replacement"] is None else t["replacement"]) for t in ordered]
        unknown = {t["term"] for t in ordered if t["replacement"] is None}
        search = TermSearch(pairs, sizes[-1])
        result = search.replace(text, changed)
        if unknown and any(term in unknown for term in search.used):
            return None, []
        if asked:
            asked -= {*words_within(text, sizes, slots), *seen}
        return result, sorted(asked)

    def replaced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = [one(*row) for row in zip(batch["prompt"], batch["_known"], batch["_seen"])]
            yield batch.assign(_result=[r for r, _ in told], _asked=[a for _, a in told])

    return replaced
