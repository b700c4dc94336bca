"""Mixing, token files, near duplicates, decontamination, URLs and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tarjuman.llm import decontaminate, jaccard, mixing, rans, tokens, urls
from tarjuman.llm.components import components
from tests.llm.rows import awkward, empty, same_columns, words
from tarjuman.workspace import new_folder

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.json")


def plain_targets(sizes):
    """Share by weight; cap at three times the size; reshare the excess, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: 3 * sizes[s] for s in full}
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 2, None: 50}, {"a": 5}, {"a": 10, "b": 0, "c": 10}])
def test_mixing_targets(spark, sizes):
    rows = [(i, words(1, i), s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    rows += [(1000 + i, None, s) for i, s in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs).cache()
    want = plain_targets(sizes)
    for source, group in mixed.toPandas().groupby("source", dropna=False):
        source = None if source != source else source
        taken = (group["size"] * group["positions"].map(len)).sum()
        assert group["target"].iloc[0] == pytest.approx(want[source])
        assert abs(taken - want[source]) <= 1
        assert (group["positions"].map(len) <= 3).all()


def test_mixing_positions_follow_the_schedule(spark):
    docs = spark.createDataFrame([(i, "w", "a") for i in range(3000)], "doc_id long, text string, source string")
    early = mixing.mix(docs, schedules=((2.0, 0.0),) * 3)
    times = np.array([p for r in early.select("positions").collect() for p in r[0]])
    assert len(times) == 3000 and ((0 <= times) & (times <= 1)).all()
    # Demand 2 - 2t: three quarters of it in the first half of training.
    assert abs((times < 0.5).mean() - 0.75) < 0.01
    ordered = [r["position"] for r in mixing.training_order(early).collect()]
    assert ordered == sorted(ordered)


def test_mixing_awkward(spark):
    rows = awkward(spark)
    mixed = mixing.mix(rows)
    same_columns(rows, mixed, ["size", "source_size", "target", "positions"])
    assert mixed.count() == 13
    again = mixing.mix(rows.repartition(3))
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, again.collect()))
    assert mixing.mix(empty(spark)).count() == 0


def test_rans_round_trip():
    rng = np.random.default_rng(1)
    blocks = [rng.zipf(1.5, n) % 50_000 for n in (1, 63, 64, 65, 5000, 20_000)]
    ids, counts = np.unique(np.concatenate(blocks), return_counts=True)
    table = rans.Table(ids, counts)
    assert table.freq.sum() == 1 << rans.PRECISION and (table.freq[ids] > 0).all()
    payloads = rans.encode([b.astype(np.uint32) for b in blocks], table)
    for own, back in zip(blocks, rans.decode(payloads, table)):
        assert (own == back).all()
    assert [b.tolist() for b in rans.decode(payloads[4:5], table)] == [blocks[4].tolist()]
    assert sum(map(len, payloads[4:])) < 2 * sum(map(len, blocks[4:]))
    broken = bytearray(payloads[4])
    broken[-3] ^= 1
    with pytest.raises(ValueError):
        rans.decode([bytes(broken)], table)


def test_encoder_equals_the_library():
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "B", "don't", "'s", " 's", "é", "1", "...", "!", "\u3000", "\xa0", "\x1d", "中", "😀",
             "<|endoftext|>", "word", "\r\n", "_", "ñ", "\u0301"]
    known, library = tokens.Encoder(FILE), Tokenizer.from_file(FILE)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(known.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_texts_together_equal_the_library():
    rng = random.Random(6)
    parts = [" ", " ", " ", "  ", "\n", "\n", "\n\n", "\t", "a", "Bc", "ab", "don't", "'s", "'", "é", "ñu", "12", "...", "!", "\xa0", "\x85",
             "\0", "\xad", "\u200b", "中", "ɐ", "😀", "<|endoftext|>", "<|", "word", "\r\n", "_", "\u0301", "a" * 99]
    library = Tokenizer.from_file(FILE)
    for seed in range(20):
        texts = ["".join(rng.choice(parts[:24 if seed % 2 else None]) for _ in range(rng.randint(0, 15))) for _ in range(300)]
        found = tokens.Encoder(FILE).encode_all(texts)
        assert [ids.tolist() for ids in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert tokens.Encoder(FILE).encode_all([]) == []


def test_each_word_goes_through_the_library_once():
    known, calls = tokens.Encoder(FILE), Counter()
    tokenize = known.tokenize
    known.tokenize = lambda word: calls.update([word]) or tokenize(word)
    stems = [f"{a}{b}qx" for a in ("ma", "no", "ti") for b in ("ra", "li", "ßo")]
    texts = [f"Go {stem}{mark} {stem} {other}" for stem in stems for mark in ("", ".", "***", "\nThen", ";\nThen") for other in stems]
    for at in range(0, len(texts), 100):
        known.encode_all(texts[at:at + 100])
    assert len(calls) == len(stems) + len(["Go", ".", "***", ";", "\n", "Then"])
    assert set(calls.values()) == {1}
    # Memory is bounded by the length of words as well.
    known.encode_all(["Go " + "a" * 1000 + " " + "b" * 1000 + "! " + "c" * 1000])
    assert max(len(word) for memory in (known.words, known.mixed, known.other) for word in memory) <= tokens.LONGEST


@pytest.mark.parametrize("block", [500, 1 << 16])
def test_token_files_round_trip(spark, block):
    docs = awkward(spark)
    folder = new_folder(spark, "tokens")
    tokens.write_tokens(docs, folder, FILE, block_ids=block)
    found = tokens.read_tokens(spark, folder).orderBy("start").collect()
    library = Tokenizer.from_file(FILE)
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        want[r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == want
    starts = np.cumsum([0] + [r["n_tokens"] for r in found])[:-1]
    assert [r["start"] for r in found] == starts.tolist()
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert ids == sorted(ids)


def test_token_files_of_nothing(spark):
    folder = new_folder(spark, "tokens")
    tokens.write_tokens(empty(spark), folder, FILE)
    assert tokens.read_tokens(spark, folder).count() == 0


def plain_components(rows):
    sets = {}
    for i, text in rows:
        own = [w.lower() for w in (text or "").encode().split()]
        sets[i] = {tuple(own[k:k + 5]) for k in range(max(1, len(own) - 4))} if own else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def near_rows():
    rng = random.Random(2)
    base = words(120, 1).split()
    rows = [(i, words(60 + i, i + 10)) for i in range(20)]
    for i in range(20, 70):
        own = list(base)
        for _ in range(rng.randint(0, 7)):
            own[rng.randrange(len(own))] = f"edit{rng.random()}"
        rows.append((i, " ".join(own[:len(own) - rng.randint(0, 12)])))
    passage = words(40, 99)
    rows += [(100 + i, words(30 + 3 * i, 200 + i) + " " + passage) for i in range(30)]
    return rows + [(200, "one two"), (201, "One  two"), (202, ""), (203, None), (204, base[0])]


@pytest.mark.parametrize("keys", [4, 0])
def test_near_duplicates_equal_a_plain_version(spark, monkeypatch, keys):
    # Without min-hash groups every link has to come out of the matrix.
    monkeypatch.setattr(jaccard, "KEYS", keys)
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df).collect()}
    assert got == plain_components(rows)


def test_near_duplicates_awkward(spark):
    rows = awkward(spark)
    found = jaccard.near_duplicates(rows)
    assert found.count() == 13
    assert {r["component_id"] for r in found.where("doc_id in (7, 8)").collect()} == {7}
    kept = jaccard.keep_one(rows)
    assert kept.columns == rows.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, 4, 5, 6, 7, 9, 9, None, None])
    assert jaccard.near_duplicates(empty(spark)).count() == 0


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r["node"]: r["label"] for r in components(chain).collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def plain_words(text):
    import re

    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower) if w]


def test_decontamination_equals_a_plain_version(spark):
    rng = random.Random(3)
    items = [(i, " ".join(f"b{rng.randint(0, 9)}" for _ in range(n))) for i, n in enumerate([20, 13, 14, 5, 1, 40, 8])]
    items += [(90, items[0][1]), (91, None), (92, " ..."), (None, items[1][1])]
    rows = [(i, " ".join(f"b{rng.randint(0, 9)}" for _ in range(rng.randint(0, 200)))) for i in range(30)]
    rows += [(100 + i, f"x y, {items[i % 7][1].upper()}; z " + words(20 * i, i)) for i in range(14)] + [(200, None), (201, "")]
    found = decontaminate.find_contamination(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    wanted = {}
    for doc, text in rows:
        own, hit, named = plain_words(text), set(), set()
        for item, item_text in items:
            theirs = plain_words(item_text)
            m = min(13, len(theirs))
            windows = {tuple(theirs[k:k + m]) for k in range(len(theirs) - m + 1)} if m else set()
            for k in range(len(own) - m + 1):
                if tuple(own[k:k + m]) in windows:
                    hit |= set(range(k, k + m))
                    named.add("" if item is None else str(item))
        wanted[doc] = (len(own), len(hit), sorted(named), len(hit) > 0 and 20 * len(hit) >= len(own))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["item_ids"]), r["contaminated"]) for r in found.collect()}
    assert got == wanted
    for r in found.collect():
        assert sum(s["last"] - s["first"] + 1 for s in r["spans"]) == r["n_hit"]


def test_decontamination_awkward(spark):
    rows = awkward(spark)
    items = spark.createDataFrame([(1, "one two three"), (2, None)], "item_id long, text string")
    found = decontaminate.find_contamination(rows, items)
    same_columns(rows, found, ["n_words", "n_hit", "spans", "item_ids", "contaminated"])
    assert found.count() == 13 and found.where("contaminated").count() == 1
    assert decontaminate.find_contamination(rows, items.limit(0)).where("n_hit > 0").isEmpty()
    assert decontaminate.find_contamination(empty(spark), items).count() == 0


def test_url_parts_and_rules(spark):
    rows = [
        ("http://Example.ORG/es/1?x", "example.org", "/es/1", "example.org/es/"), ("https://a.b.com/fr/#t", "a.b.com", "/fr/", "com/fr/"),
        ("x://www.example.org/en/12", "www.example.org", "/en/12", "example.org/en/1"), ("http://notexample.org/es/", "notexample.org", "/es/", "org/"),
        ("http://h.net", "h.net", "", None), ("no scheme", "", "", None), (None, "", "", None), ("http://a.org", "a.org", "", None),
        ("http://É.com?a://b", "É.com", "", None),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "url string")
    got = urls.judge(df)
    assert [(r["url"], r["host"], r["path"], r["rule"]) for r in got.collect()] == rows
    assert got.where("verdict is null or score < 0 or score > 1").isEmpty()


def test_url_model_learns_from_a_table(spark):
    train = spark.createDataFrame(
        [(f"h{i}.net", "/casino/win" if i % 2 else "/news/today", float(i % 2)) for i in range(40)], "host string, path string, block double")
    pages = spark.createDataFrame([("http://q.net/casino/x", 1), ("http://q.net/news/x", 2)], "url string, score int")
    judged = urls.judge(pages, rules=(), labelled=train)
    assert judged.columns == ["url", "host", "path", "rule", "score", "verdict"]
    assert [r["verdict"] for r in judged.collect()] == ["block", "allow"]
    assert urls.judge(pages.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns
        folder = new_folder(spark, name)
        after.write.parquet(folder)
        after = spark.read.parquet(folder)
        assert 0 < after.count() and after.join(before, "doc_id", "left_anti").isEmpty()
        before = after
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    near = plain_components(rows)
    ids = {r["doc_id"] for r in before.collect()}
    assert all(near[i][1] == i for i in ids)
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {r["doc_id"] for r in found.collect()} == ids
    assert found.select(F.sum("n_tokens")).first()[0] > 0
