"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of a stated and of a learned lexicon, lexicon words near
a second-person word, capitals, exclamation and repeated punctuation, and signs of
obfuscation (digits or symbols within words, spelled-out or masked words).

Model and learned lexicon are fitted on at most about ``MOST_LABELLED`` labelled rows,
chosen by the hash of the text, in ``FOLDS`` parts. Labels are never used twice: a row's
features for fitting come from a lexicon learned on the other parts, and its margin for the
isotonic curve from trees fitted on the other parts. The scorer's own lexicon and trees are
then those of all rows. Scoring reads every row and whole texts.

Defined cases: null and empty texts have all features 0 and get that point's score;
rows without a label teach nothing; without labels of both kinds every score is the
share of label 1 (0 if none); repeated rows get equal scores.
"""

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarjuman.llm.common import small_batches
from tarjuman.workspace import materialize

MOST_LABELLED = 24_000
MOST_LEARNED = 100
LEAST_SHARE, LEAST_TEXTS = 0.01, 3
LEAST_LIFT = 5.0
NEAR = 6
ROUNDS, DEPTH = 20, 3
FOLDS = 3

INSULTS = frozenset(
    "idiot idiots moron morons scum trash garbage worthless pathetic disgusting clown stupid dumb loser "
    "losers vermin filth freak ugly hate kill shut stfu bastard crap damn hell imbecile fool cretin "
    "abschaum dumm trottel widerlich wertlos hässlich müll dégoûtant pathétique imbécile débile ordure "
    "crétin asqueroso patético basura inútil estúpido escoria tonto".encode().split()
)
SECOND_PERSON = frozenset(
    "you your yours you're u ur du dich dir dein deine ihr tu te toi ton vous votre tú tus ti usted".encode().split()
)
EDGES = b".,;:!?\"'()[]{}<>*#$%&|-_~"
UNMASKED = bytes.maketrans(b"013457@$!", b"oieastasi")
WITHIN = re.compile(rb"[a-z][0-9@$*!]+[a-z]")
SPELLED = re.compile(rb"(?<![a-z])(?:[a-z][ .\-_*]){3,}[a-z](?![a-z])")
MASKED = re.compile(rb"[a-z]\*{2,}")
REPEATED = re.compile(rb"[!?]{2,}")
FEATURES = (
    "insults_per_word", "insults", "distinct_insults", "learned_per_word", "learned", "distinct_learned",
    "near_you", "near_you_per_insult", "second_person", "capitals", "exclamations", "repeated_marks",
    "within", "spelled", "masked", "words",
)


def features_of(text: str | None, learned: frozenset[bytes]) -> list[float]:
    """The features of one text, in the order of ``FEATURES``."""
    raw = (text or "").encode()
    low = raw.lower()
    words = low.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    bare = [w.strip(EDGES) for w in words]
    known = set(bare)
    odd = {w: plain for w in known if w and not w.isalpha() and (plain := w.translate(UNMASKED)) != w}
    bad = {w for w in known if w in INSULTS or odd.get(w) in INSULTS}
    taught = {w for w in known if w in learned or odd.get(w) in learned}
    you = known & SECOND_PERSON
    insults = hits = near = addressed = 0
    if bad or taught or you:
        at_you = [i for i, w in enumerate(bare) if w in you] if you else []
        places = [i for i, w in enumerate(bare) if w in bad] if bad else []
        insults, addressed = len(places), len(at_you)
        hits = sum(1 for w in bare if w in taught) if taught else 0
        if places and at_you:
            gaps = np.searchsorted(at_you, places)
            for place, k in zip(places, gaps):
                close = [at_you[j] for j in (k - 1, k) if 0 <= j < len(at_you)]
                near += min(abs(place - other) for other in close) <= NEAR
    letters = sum(map(raw.count, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")) if raw != low else 0
    return [
        100 * insults / n, np.log1p(insults), len(bad), 100 * hits / n, np.log1p(hits), len(taught),
        np.log1p(near), near / max(insults, 1), 100 * addressed / n, letters / len(raw),
        100 * raw.count(b"!") / n, 100 * len(REPEATED.findall(raw)) / n, 100 * len(WITHIN.findall(low)) / n,
        100 * len(SPELLED.findall(low)) / n, 100 * len(MASKED.findall(low)) / n, np.log1p(n),
    ]


class Scorer:
    """Trees, calibration and learned lexicon; ``share`` alone if nothing could be learned."""

    def __init__(self, share: float, learned: frozenset[bytes] = frozenset(), trees=None, calibration=None):
        self.share, self.learned, self.trees, self.calibration = share, learned, trees, calibration


def with_features(docs: DataFrame, learned: frozenset[bytes], text: str) -> DataFrame:
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series([features_of(t if isinstance(t, str) else None, learned) for t in texts])

    return docs.withColumn("_toxic_features", array_to_vector(compute(F.col(text))))


def learn_lexicon(rows: DataFrame) -> frozenset[bytes]:
    """Words that are in at least ``LEAST_SHARE`` of the toxic texts of the sample, in
    ``LEAST_TEXTS`` of them, and ``LEAST_LIFT`` times as common there; the ``MOST_LEARNED``
    strongest."""

    def words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both: list[dict[bytes, int]] = [{}, {}]
            for text, label in zip(batch["text"], batch["label"]):
                own = both[int(label)]
                for word in {w.strip(EDGES) for w in text.lower().encode().split()}:
                    own[word] = own.get(word, 0) + 1
            for label, own in enumerate(both):
                zeros = [0] * len(own)
                yield pd.DataFrame({
                    "word": list(own), "clean": list(own.values()) if not label else zeros,
                    "toxic": list(own.values()) if label else zeros,
                })

    sizes = rows.agg(F.sum(F.lit(1) - F.col("label")), F.sum("label")).first()
    if not sizes[1]:
        return frozenset()
    counts = rows.select("text", "label").mapInPandas(words_of, "word binary, clean long, toxic long")
    counts = counts.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share, other = F.col("toxic") / sizes[1], (F.col("clean") + 1) / (sizes[0] + 1)
    counts = counts.where((share >= LEAST_SHARE) & (F.col("toxic") >= LEAST_TEXTS))
    counts = counts.where((share >= LEAST_LIFT * other) & (F.length("word") > 2))
    best = counts.orderBy((share / other).desc(), "word").limit(MOST_LEARNED)
    return frozenset(bytes(r["word"]) for r in best.collect())


def learn(labelled: DataFrame, text: str = "text", label: str = "label") -> Scorer:
    """A scorer from rows with a text and a label of 0 or 1."""
    rows = labelled.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("label"))
    rows = rows.where("label in (0, 1)")
    n = rows.count()
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 20))
    bar = min(1.0, MOST_LABELLED / max(n, 1)) * (1 << 20)
    rows = materialize(rows.where(place < bar).repartition(8, F.xxhash64("text")), "toxicity-rows")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Scorer(float(bool(sizes.get(1))))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(FOLDS)))
    parts = []
    for fold in range(FOLDS):
        lexicon = learn_lexicon(rows.where(F.col("fold") != fold))
        parts.append(with_features(rows.where(F.col("fold") == fold), lexicon, "text").select(
            "_toxic_features", F.col("label").cast("double").alias("label"), "fold"))
    learned = learn_lexicon(rows)
    ready = materialize(reduce(DataFrame.union, parts), "toxicity-features")
    boosting = GBTClassifier(
        featuresCol="_toxic_features", labelCol="label", predictionCol="_toxic_guess",
        maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.25, maxBins=64, seed=7,
    )
    boosting.setRawPredictionCol("_toxic_raw").setProbabilityCol("_toxic_chance")
    trees = boosting.fit(ready)
    present = {(r["fold"], r["label"]) for r in ready.select("fold", "label").distinct().collect()}
    rated = []
    for fold in range(FOLDS):
        # Trees need rows of both labels outside the part that they rate.
        if {label for other, label in present if other != fold} == {0.0, 1.0}:
            others = boosting.fit(ready.where(F.col("fold") != fold))
            rated.append(with_margin(others.transform(ready.where(F.col("fold") == fold))))
    rated = [m.select("_toxic_margin", "label") for m in rated or [with_margin(trees.transform(ready))]]
    calibration = IsotonicRegression(
        featuresCol="_toxic_margin", labelCol="label", predictionCol="_toxic_score"
    ).fit(reduce(DataFrame.union, rated))
    return Scorer(sizes[1] / sum(sizes.values()), learned, trees, calibration)


def with_margin(scored: DataFrame) -> DataFrame:
    return scored.withColumn("_toxic_margin", vector_to_array("_toxic_raw")[1])


def score(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, replacing a column of that name."""
    names = [c for c in docs.columns if c != "score"]
    if scorer.trees is None:
        return docs.select(*[F.col(f"`{c}`") for c in names], F.lit(scorer.share).alias("score"))
    # The caller's columns travel in one, so that their names are free.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    margins = with_margin(scorer.trees.transform(with_features(packed, scorer.learned, "_text")))
    rated = scorer.calibration.transform(margins)
    bounded = F.least(F.greatest(F.col("_toxic_score"), F.lit(0.0)), F.lit(1.0))
    return rated.select(*[F.col("_row").getField(c).alias(c) for c in names], bounded.alias("score"))
