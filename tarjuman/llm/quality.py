"""Quality rules: counts, and divergence from language references.

Every language has two reference histograms, counted over all documents: character
classes, and its common words (each at least ``COMMON`` of its words, so at most
1/COMMON of them) with one bin for all other words. A document is compared with each
language by Jensen-Shannon distance (base 2, 0 to 1); the nearest language counts. Word
distances are shares of the distance of a text without any common word. A histogram is
judged only if the text is long enough for it.

Common words are exact in two passes: hashed counts over all words first, which bound
every word's count from above, then exact counts of the words whose bin is frequent.

Defined cases: null and empty texts have no words and fail; texts shorter than a guard
skip that comparison; without any reference nothing is judged by divergence; documents
without a language are judged but add to no reference; repeated rows are judged alike.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarjuman.llm.common import small_batches
from tarjuman.operators.shape import free_name
from tarjuman.workspace import materialize

SYMBOLS = re.compile(r"[#*$%&|<>]")
CLASSES = ("letter", "capital", "digit", "blank", "stop", "symbol", "accented", "other")
COMMON = 2e-3
BINS = 1 << 16
LEAST_CHARS, LEAST_WORDS = 200, 50
MOST_CHAR_DISTANCE, MOST_WORD_DISTANCE = 0.25, 0.93
LEAST_DOC_WORDS = 50

_TABLE: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """The character class of each code point, as an index into ``CLASSES``."""
    if not _TABLE:
        table = np.full(0x110000, CLASSES.index("other"), np.uint8)
        for point in range(0x3000):
            char = chr(point)
            if char.isalpha():
                kind = "accented" if point > 127 else "capital" if char.isupper() else "letter"
            elif char.isdigit():
                kind = "digit"
            elif char.isspace():
                kind = "blank"
            elif char in ".,;:!?'\"()-":
                kind = "stop"
            else:
                kind = "symbol" if point < 128 else "other"
            table[point] = CLASSES.index(kind)
        _TABLE.append(table)
    return _TABLE[0]


def class_counts(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.bincount(class_table()[points], minlength=len(CLASSES))


def plain_words(text: str) -> list[bytes]:
    return text.lower().encode().split()


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    symbols = len(SYMBOLS.findall(text))
    chars = sum(len(w) for w in words)
    if not text.isascii():
        chars = sum(len(w.decode()) for w in words)
    seen, copies = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            copies += line in seen
            seen.add(line)
    repeated = 0
    if len(words) > 3:
        ids: dict[bytes, int] = {}
        codes = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
        first = codes[:-2] * len(ids) + codes[1:-1]
        _, first = np.unique(first, return_inverse=True)
        _, window, count = np.unique(first * len(ids) + codes[2:], return_inverse=True, return_counts=True)
        often = count[window] > 1
        covered = np.zeros(len(words), bool)
        for shift in range(3):
            covered[shift:len(words) - 2 + shift] |= often
        repeated = int(covered.sum())
    return len(words), chars, symbols, copies, repeated


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence in bits of two histograms."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum()
        right = np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, (left + right) / 2)))


class References:
    """Per language: character-class counts, common words and their counts, the rest last."""

    def __init__(self, classes: dict[str, np.ndarray], common: dict[str, dict[bytes, int]], totals: dict[str, int]):
        self.classes = {k: v for k, v in classes.items() if v.sum()}
        self.index, self.words = {}, {}
        for lang, counts in common.items():
            if totals.get(lang):
                self.index[lang] = {w: i for i, w in enumerate(sorted(counts))}
                own = [counts[w] for w in sorted(counts)]
                self.words[lang] = np.array(own + [totals[lang] - sum(own)], float)
        # A text without any common word is as far from a language as a text can be in practice,
        # and how far that is depends on the language.
        self.farthest = {
            lang: js_distance(np.eye(1, len(ref), len(ref) - 1)[0], ref) or 1.0 for lang, ref in self.words.items()}

    def distances(self, text: str | None) -> tuple[float | None, float | None]:
        """To the nearest language: by character classes, by common words; null if too short."""
        text = text or ""
        by_class = by_word = None
        if len(text) >= LEAST_CHARS and self.classes:
            own = class_counts(text).astype(float)
            by_class = min(js_distance(own, ref) for ref in self.classes.values())
        words = Counter(plain_words(text)) if self.words else {}
        n = sum(words.values())
        if n >= LEAST_WORDS:
            by_word = np.inf
            for lang, index in self.index.items():
                own = np.zeros(len(index) + 1)
                for word in index.keys() & words.keys():
                    own[index[word]] = words[word]
                own[-1] = n - own.sum()
                by_word = min(by_word, js_distance(own, self.words[lang]) / self.farthest[lang])
        return by_class, by_word


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> References:
    """References of every language, from all documents that have one."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes: dict[str, np.ndarray] = {}
        bins: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, texts in batch.groupby("lang")["text"]:
                own = classes.setdefault(name, np.zeros(len(CLASSES), np.int64))
                hashed = bins.setdefault(name, np.zeros(BINS, np.int64))
                words: Counter = Counter()
                for t in texts:
                    own += class_counts(t)
                    words.update(plain_words(t))
                places = np.fromiter((zlib.crc32(w) % BINS for w in words), np.int64, len(words))
                hashed += np.bincount(places, list(words.values()), BINS).astype(np.int64)
        for name in classes:
            yield pd.DataFrame({"lang": name, "kind": "class", "bin": range(len(CLASSES)), "n": classes[name]})
            full = np.flatnonzero(bins[name])
            yield pd.DataFrame({"lang": name, "kind": "word", "bin": full, "n": bins[name][full]})

    counted = rows.mapInPandas(count, "lang string, kind string, bin int, n long")
    counted = materialize(counted.groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n")), "quality-bins")
    totals = counted.groupBy("lang", "kind").agg(F.sum("n").alias("total"))
    # Only bins that hold at least COMMON of a language can hold a common word: at most 1/COMMON.
    wanted = counted.where("kind = 'class'").select("lang", "kind", "bin", "n")
    wanted = wanted.union(
        counted.where("kind = 'word'").join(totals, ["lang", "kind"])
        .where(F.col("n") >= COMMON * F.col("total")).select("lang", "kind", "bin", "n")
    ).collect()
    sums = {r["lang"]: r["total"] for r in totals.where("kind = 'word'").collect()}
    classes: dict[str, np.ndarray] = {}
    frequent: dict[str, set[int]] = {}
    for r in wanted:
        if r["kind"] == "class":
            classes.setdefault(r["lang"], np.zeros(len(CLASSES)))[r["bin"]] = r["n"]
        else:
            frequent.setdefault(r["lang"], set()).add(r["bin"])

    def recount(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for name, texts in batch.groupby("lang")["text"]:
                words: Counter = Counter()
                for t in texts:
                    words.update(plain_words(t))
                own, keep = found.setdefault(name, Counter()), frequent.get(name, set())
                for word, n in words.items():
                    if zlib.crc32(word) % BINS in keep:
                        own[word] += n
            # What shares a bin with a common word adds up; hand it on before it grows.
            if sum(map(len, found.values())) > 50_000:
                yield from _rows(found)
                found = {}
        yield from _rows(found)

    words = rows.mapInPandas(recount, "lang string, word binary, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    total = F.lit(0)
    for name, n in sums.items():
        total = F.when(F.col("lang") == name, F.lit(n)).otherwise(total)
    common: dict[str, dict[bytes, int]] = {}
    for r in words.where(F.col("n") >= COMMON * total).collect():
        common.setdefault(r["lang"], {})[bytes(r["word"])] = r["n"]
    return References(classes, common, sums)


def _rows(found: dict[str, Counter]) -> Iterator[pd.DataFrame]:
    for name, counts in found.items():
        yield pd.DataFrame({"lang": name, "word": list(counts), "n": list(counts.values())})


OUTPUT = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "class_distance": "double", "word_distance": "double", "kept": "boolean",
}


def judge(docs: DataFrame, references: References, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``OUTPUT``; columns of these names are replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(references)

    @F.pandas_udf(", ".join(f"{k} {v}" for k, v in OUTPUT.items()))
    def rules(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            t = t if isinstance(t, str) else None
            counts = base_counts(t)
            failed = counts[0] < LEAST_DOC_WORDS or 100 * counts[4] > 50 * counts[0]
            by_class, by_word = shared.value.distances(t)
            near = (by_class is None or by_class <= MOST_CHAR_DISTANCE) and (
                by_word is None or by_word <= MOST_WORD_DISTANCE)
            rows.append((*counts, failed, by_class, by_word, not failed and near))
        return pd.DataFrame(rows, columns=list(OUTPUT))

    found = free_name(docs.columns, "_quality")
    kept = docs.drop(*OUTPUT).withColumn(found, rules(F.col(f"`{text}`")))
    return kept.withColumns({k: F.col(found).getField(k) for k in OUTPUT}).drop(found)
