"""Language ID, quality rules, toxicity, pseudonyms and line dedup against plain versions."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarjuman.llm import language, lines, pseudonyms, quality, toxicity
from tests.llm.rows import awkward, empty, same_columns, words

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_on_unseen_texts(spark, docs):
    model = language.learn(docs.where("doc_id % 2 = 0"))
    found = language.identify(docs.where("doc_id % 2 = 1 and n_chars > 100"), model)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert found.where("score < 0 or score > 1").isEmpty()


def test_language_filter_counts_hits_of_a_plain_set():
    model = language.LanguageFilter(["a", "b"], [1, 1])
    points = language.letters()[np.frombuffer("hello world".encode("utf-32-le"), np.uint32)]
    known = language.gram_hashes(points, 3)
    model.add(1, known[known != 0])
    total, hits = model.counts(["hello world", "zzz qqq", None])
    assert total[0] > 0 and hits[0, 1] >= np.count_nonzero(known) and not hits[:, 0].any() and not hits[2].any()


def test_language_blocks_give_the_same_counts(monkeypatch):
    model = language.LanguageFilter(["a"], [1])
    text = "abc defg " * 300
    points = np.concatenate([[32], language.letters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)], [32, 32]])
    model.add(0, language.gram_hashes(points.astype(np.uint32), 2))
    whole = model.counts([text, "abc"])
    monkeypatch.setattr(language, "BLOCK", 64)
    cut = model.counts([text, "abc"])
    assert (cut[0] == whole[0]).all() and (cut[1] == whole[1]).all()


def test_language_awkward(spark):
    rows = awkward(spark)
    model = language.learn(rows)
    found = language.identify(rows, model)
    same_columns(rows, found, ["lang_pred", "score"])
    got = [(r["doc_id"], r["text"], r["lang_pred"], r["score"]) for r in found.collect()]
    assert len(got) == 13
    for _, text, lang, score in got:
        assert (lang == "und") == (not text or not any(map(str.isalpha, text)))
        assert 0 <= score <= 1
    assert language.identify(empty(spark), model).count() == 0
    nothing = language.identify(rows, language.learn(empty(spark)))
    assert nothing.where("lang_pred <> 'und'").isEmpty()


def plain_quality(text):
    own = (text or "").encode().split()
    windows = Counter(tuple(own[i:i + 3]) for i in range(len(own) - 2))
    covered = {i + k for i in range(len(own) - 2) if windows[tuple(own[i:i + 3])] > 1 for k in range(3)}
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            copies += line in seen
            seen.add(line)
    return (len(own), sum(len(w.decode()) for w in own), sum(c in "#*$%&|<>" for c in text or ""), copies, len(covered))


def test_quality_counts_equal_a_plain_version(docs):
    texts = [r[0] for r in docs.select("text").limit(200).collect()]
    texts += [None, "", " \n", "a b c a b c a", "x\nx\nx", "é é é é é", "# * $"]
    for text in texts:
        assert quality.base_counts(text) == plain_quality(text)


def test_quality_distance():
    assert quality.js_distance(np.array([1.0, 3]), np.array([2.0, 6])) == pytest.approx(0, abs=1e-9)
    assert quality.js_distance(np.array([1.0, 0]), np.array([0.0, 1])) == pytest.approx(1)


def test_quality_references_are_exact(spark, docs):
    refs = quality.learn(docs)
    for lang, group in docs.where("lang is not null").toPandas().groupby("lang"):
        counts = Counter(w for t in group["text"] for w in t.lower().encode().split())
        total = sum(counts.values())
        common = sorted(w for w, n in counts.items() if n >= quality.COMMON * total)
        assert sorted(refs.index[lang]) == common
        assert refs.words[lang].sum() == total


def test_quality_keeps_good_rows(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.judge(docs, quality.learn(docs)).join(labels, "doc_id").where("not base_failed")
    shares = {r[0]: r[1] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()}
    assert shares[1] > 0.98 and shares[0] < 0.2


def test_quality_awkward(spark):
    rows = awkward(spark)
    judged = quality.judge(rows, quality.learn(rows))
    same_columns(rows, judged, list(quality.OUTPUT))
    assert judged.count() == 13
    assert judged.where("n_words < 50 and (kept or not base_failed)").isEmpty()
    assert quality.judge(empty(spark), quality.learn(empty(spark))).count() == 0


def test_toxicity_on_unseen_texts(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    known = docs.join(labels, "doc_id")
    scorer = toxicity.learn(known.where("doc_id % 3 <> 0"))
    scored = toxicity.score(known.where("doc_id % 3 = 0").drop("label"), scorer).join(labels, "doc_id")
    assert scored.where("score < 0 or score > 1").isEmpty()
    right = scored.agg(F.avg(((F.col("score") >= 0.7).cast("int") == F.col("label")).cast("int"))).first()[0]
    assert right > 0.93


def test_toxicity_features():
    at = dict(zip(toxicity.FEATURES, toxicity.features_of("You are an IDIOT!! a m.o.r.o.n", frozenset())))
    assert at["insults"] == pytest.approx(math.log1p(1)) and at["near_you"] == pytest.approx(math.log1p(1))
    assert at["repeated_marks"] > 0 and at["spelled"] > 0
    assert toxicity.features_of(None, frozenset()) == toxicity.features_of("", frozenset()) == [0.0] * len(toxicity.FEATURES)


def test_toxicity_awkward(spark):
    rows = awkward(spark)
    scorer = toxicity.learn(rows)
    scored = toxicity.score(rows, scorer)
    same_columns(rows, scored, ["score"])
    assert scored.count() == 13 and scored.where("score <> 0").isEmpty()
    assert toxicity.score(empty(spark), scorer).count() == 0


def plain_dedup(rows):
    seen, out = {}, {}
    for doc, text in sorted(rows):
        cut = text.split("\n")
        gone = set()
        for i in range(len(cut) - 2):
            window = tuple(cut[i:i + 3])
            if not any(line.encode().split() for line in window):
                continue
            if window in seen:
                gone |= {i, i + 1, i + 2}
            seen.setdefault(window, doc)
        out[doc] = "\n".join(line for i, line in enumerate(cut) if i not in gone), len(gone)
    return out


def test_lines_equal_a_plain_version(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(rng.choice("abc") * rng.randint(0, 1) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(100, "x\n" * 50), (101, "x\n" * 50)]
    got = {r[0]: (r[1], r[2]) for r in lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_dedup(rows)


def test_lines_awkward(spark):
    rows = awkward(spark)
    found = lines.drop_repeated_lines(rows)
    same_columns(rows, found, ["n_removed"])
    assert found.count() == 13 and found.where("text is null").count() == 2
    assert lines.drop_repeated_lines(empty(spark)).count() == 0


def plain_feistel(key, kind, left, right, m, n):
    import hashlib

    for i in range(1, pseudonyms.ROUNDS + 1):
        own, other, size = (left, right, m) if i % 2 else (right, left, n)
        said = "|".join([key, kind, str(i), str(size), str(other)])
        moved = (own + int(hashlib.sha256(said.encode()).hexdigest()[:15], 16)) % size
        left, right = (moved, right) if i % 2 else (left, moved)
    return left, right


def test_pseudonyms_are_a_keyed_permutation(spark):
    df = spark.range(1000).select(F.format_string("%03d", "id").alias("d"))
    new = [r[0] for r in df.select(pseudonyms.permute_digits("k", "card", F.col("d"))).collect()]
    assert sorted(new) == [f"{i:03d}" for i in range(1000)]
    for i in (0, 7, 123, 999):
        left, right = plain_feistel("k", "card", i // 100, i % 100, 10, 100)
        assert new[i] == f"{left}{right:02d}"


def test_pseudonyms_in_text(spark):
    texts = [
        "card 4111111111111111 and 4111-1111-1111-1111, no card 4111111111111112",
        "+1 (743) 555-3824 from 227.5.221.1 not 999.1.1.1 nor 1.2.3.4.5", "born 29.02.2000, not 30.02.2000, ISO 2001-12-31",
        "123-45-6789 but not 000-45-6789", None, "", "nothing",
    ]
    df = pseudonyms.pseudonymize(spark.createDataFrame([(t,) for t in texts], "text string"), "k")
    out = [(r["text"], r["n_replaced"]) for r in df.collect()]
    first = out[0][0].split()
    assert first[1] != "4111111111111111" and first[3].replace("-", "").rstrip(",") == first[1]
    assert first[1][0] == "4" and len(first[1]) == 16 and "4111111111111112" in out[0][0] and out[0][1] == 2
    assert out[1][0].startswith("+1 (") and "999.1.1.1" in out[1][0] and "1.2.3.4.5" in out[1][0] and out[1][1] == 2
    assert "30.02.2000" in out[2][0] and "29.02.2000" not in out[2][0] and out[2][1] == 2
    assert "000-45-6789" in out[3][0] and out[3][1] == 1
    assert out[4:] == [(None, 0), ("", 0), ("nothing", 0)]


def test_pseudonyms_awkward(spark):
    rows = awkward(spark)
    found = pseudonyms.pseudonymize(rows, "k")
    same_columns(rows, found, ["n_replaced"])
    assert found.count() == 13 and found.where("n_replaced > 0").isEmpty()
    assert pseudonyms.pseudonymize(empty(spark), "k").count() == 0


def test_words_helper_differs_by_seed():
    assert words(5, 1) != words(5, 2)
