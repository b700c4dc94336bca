"""Language ID by language-bitmask n-gram filters.

A bit-sliced Bloom filter: every slot holds one bit per language, so the AND of an
n-gram's slots gives all languages that contain it at once. A text's hits are counted
per language (popcount per bit), corrected for that language's false-positive rate, and
the largest share decides.

Learning counts character n-grams of labelled texts on Spark, in at most about
``DOCS_PER_LANGUAGE`` texts of each language, chosen by the hash of the text; n-grams
that make up at least ``RARE`` of a language's n-grams enter the filter, so at most
1/RARE of them per language reach the driver, and the filter's size is fixed.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a text
whose n-grams are in no language gets the language with most labelled texts and score 0;
ties go to the language first in code-point order; nothing labelled makes every text
``und``; repeated rows get equal answers; whole texts are read, in blocks when long.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarjuman.llm.common import small_batches
from tarjuman.operators.shape import free_name
from tarjuman.workspace import materialize

ORDERS = (2, 3, 4)
SLOT_BITS = 20
HASHES = 3
RARE = 2e-5
DOCS_PER_LANGUAGE = 3_000
BLOCK = 1 << 19
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point its lower-case letter, or a blank."""
    if not _LETTERS:
        table = np.full(0x110000, 32, np.uint32)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                table[point] = ord(low) if len(low) == 1 else point
        _LETTERS.append(table)
    return _LETTERS[0]


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(points: np.ndarray, order: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Hash of the n-gram that starts at each place; 0 where it holds two blanks, or where
    ``starts`` says that another piece counts it."""
    n = len(points) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = points.astype(np.uint64)
    code = wide[:n].copy()
    blank = (points == 32).astype(np.int8)
    blanks = blank[:n].copy()
    for i in range(1, order):
        code = code * np.uint64(0x200003) + wide[i:i + n]
        blanks += blank[i:i + n]
    hashed = mix64(code * np.uint64(8) + np.uint64(order))
    hashed[blanks > 1] = 0
    if starts is not None:
        hashed[~starts[:n]] = 0
    return hashed


def batch_blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Letters of many texts; per piece its row and length; and where n-grams may start.

    A text begins with one blank and ends in two, which no n-gram spans. A long text comes
    in pieces that overlap by the longest order; each n-gram starts in one piece only.
    """
    overlap = max(ORDERS) - 1
    points, owner, starts, held = [], [], [], 0
    for row, text in enumerate(texts):
        if not text:
            continue
        mapped = letters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        mapped = np.concatenate([[32], mapped, [32, 32]]).astype(np.uint32)
        for at in range(0, len(mapped), BLOCK):
            piece = mapped[at:at + BLOCK + overlap]
            points.append(piece)
            owner.append((row, len(piece)))
            starts.append(np.arange(len(piece)) < BLOCK)
            held += len(piece)
            if held >= BLOCK:
                yield np.concatenate(points), np.array(owner), np.concatenate(starts)
                points, owner, starts, held = [], [], [], 0
    if points:
        yield np.concatenate(points), np.array(owner), np.concatenate(starts)


class LanguageFilter:
    """The filter: ``slots[h]`` has bit b set if language b holds an n-gram hashed to h."""

    def __init__(self, languages: list[str], prior: list[int]):
        self.languages, self.prior = languages, prior
        self.words = max(1, -(-len(languages) // 64))
        self.slots = np.zeros((self.words, 1 << SLOT_BITS), np.uint64)

    def places(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Slots of each n-gram, from disjoint bits of its hash."""
        mask = np.uint64((1 << SLOT_BITS) - 1)
        return [((hashes >> np.uint64(SLOT_BITS * i)) & mask).astype(np.int64) for i in range(HASHES)]

    def add(self, language: int, hashes: np.ndarray) -> None:
        for places in self.places(hashes):
            np.bitwise_or.at(self.slots[language // 64], places, np.uint64(1 << (language % 64)))

    def false_rates(self) -> np.ndarray:
        """Per language, the chance that an n-gram it lacks is found."""
        fill = [
            np.count_nonzero(self.slots[b // 64] & np.uint64(1 << (b % 64))) / (1 << SLOT_BITS)
            for b in range(len(self.languages))
        ]
        return np.array(fill) ** HASHES

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of n-grams of each text, and hits per language."""
        total = np.zeros(len(texts), np.int64)
        hits = np.zeros((len(texts), len(self.languages)), np.int64)
        for points, owner, starts in batch_blocks(texts):
            rows, ends = owner[:, 0], np.cumsum(owner[:, 1])
            for order in ORDERS:
                hashes = gram_hashes(points, order, starts)
                valid = hashes != 0
                edges = np.minimum(np.concatenate([[0], ends]), len(hashes))
                places = self.places(hashes)

                def per_text(flags: np.ndarray) -> np.ndarray:
                    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
                    return sums[edges[1:]] - sums[edges[:-1]]

                np.add.at(total, rows, per_text(valid))
                for word in range(self.words):
                    found = self.slots[word][places[0]]
                    for place in places[1:]:
                        found &= self.slots[word][place]
                    found[~valid] = 0
                    for b in range(word * 64, min(len(self.languages), word * 64 + 64)):
                        bit = (found >> np.uint64(b % 64)) & np.uint64(1)
                        np.add.at(hits[:, b], rows, per_text(bit))
        return total, hits

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        total, hits = self.counts(texts)
        rates = self.false_rates()
        fair = np.maximum(hits - total[:, None] * rates, 0) / (1 - np.minimum(rates, 0.999999))
        best = fair.argmax(axis=1)
        top = fair.max(axis=1)
        second = np.sort(fair, axis=1)[:, -2] if fair.shape[1] > 1 else np.zeros(len(texts))
        names, scores = [], []
        for i, text in enumerate(texts):
            if not text or not any(map(str.isalpha, text)):
                names.append(UNKNOWN)
                scores.append(0.0)
            elif top[i] <= 0:
                names.append(self.languages[int(np.argmax(self.prior))])
                scores.append(0.0)
            else:
                names.append(self.languages[best[i]])
                scores.append(float(top[i] / (top[i] + second[i])))
        return names, scores


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageFilter:
    """A filter from the rows of ``labelled`` that have a text and a language."""
    spark = labelled.sparkSession
    small_batches(spark)
    labelled = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    labelled = labelled.where("text is not null and lang is not null")
    counted = labelled.groupBy("lang").count().orderBy("lang").collect()
    if not counted:
        return LanguageFilter([], [])
    # About so many distinct texts of a language lie below its bar. Copies share a hash, so a
    # text counts once however often it occurs, and a language of few texts is learned whole.
    texts = labelled.select("lang", F.xxhash64("text").alias("print")).distinct().groupBy("lang").count().collect()
    bars = {r["lang"]: min(1.0, DOCS_PER_LANGUAGE / r["count"]) for r in texts}
    bar: Column = F.lit(0.0)
    for name, share in bars.items():
        bar = F.when(F.col("lang") == name, F.lit(share)).otherwise(bar)
    chosen = labelled.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < bar * (1 << 20)).dropDuplicates(["lang", "text"])

    def count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, group in batch.groupby("lang"):
                parts = [
                    hashes[hashes != 0]
                    for points, _, starts in batch_blocks(group["text"].tolist())
                    for hashes in (gram_hashes(points, order, starts) for order in ORDERS)
                ]
                grams, counts = np.unique(np.concatenate(parts or [np.zeros(0, np.uint64)]), return_counts=True)
                yield pd.DataFrame({"lang": name, "gram": grams.view(np.int64), "n": counts})

    grams = chosen.mapInPandas(count_grams, "lang string, gram long, n long")
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # More than 1/RARE n-grams of a language cannot reach this share of it.
    grams = materialize(grams, "language-grams")
    totals = grams.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = grams.join(totals, "lang").where(F.col("n") >= RARE * F.col("total")).select("lang", "gram").toPandas()
    names = [r["lang"] for r in counted]
    filled = LanguageFilter(names, [r["count"] for r in counted])
    for i, name in enumerate(names):
        filled.add(i, kept.loc[kept["lang"] == name, "gram"].to_numpy(np.int64).view(np.uint64))
    return filled


def identify(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = shared.value.predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    found = free_name(docs.columns, "_language")
    kept = docs.drop(*({"lang_pred", "score"} - {text})).withColumn(found, predict(F.col(f"`{text}`")))
    return kept.withColumns({name: F.col(found).getField(name) for name in ("lang_pred", "score")}).drop(found)
