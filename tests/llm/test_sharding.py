"""Sharding: exact sizes, every row once, chances of the matrix, reruns, files."""

from collections import Counter
from math import comb

import numpy as np
import pytest

from tarjuman.llm import sharding
from tests.llm.rows import awkward, empty


def test_hypergeometric_chances():
    rng = np.random.default_rng(1)
    seen = Counter(sharding.hypergeometric(rng, 5, 7, 6) for _ in range(30_000))
    for k in range(6):
        assert abs(seen[k] / 30_000 - comb(5, k) * comb(7, 6 - k) / comb(12, 6)) < 0.012


def test_hypergeometric_of_large_populations():
    rng = np.random.default_rng(2)
    good, bad, n = 10**11, 7 * 10**11, 4 * 10**6
    got = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(400)])
    spread = np.sqrt(n / 8 * 7 / 8)
    assert abs(got.mean() - n / 8) < 5 * spread / 20 and 0.85 < got.std() / spread < 1.15


@pytest.mark.parametrize("sizes, shards", [([5, 0, 9, 1], 3), ([1], 8), ([], 4), ([4096] * 30, 8)])
def test_matrix_sums(sizes, shards):
    room = sharding.shard_sizes(sum(sizes), shards)
    matrix = sharding.draw_matrix(sizes, room, [7])
    assert [sum(row) for row in matrix] == sizes
    assert not sizes or [sum(column) for column in zip(*matrix)] == room


def placed(docs, shards=8, **more):
    rows = sharding.place_rows(docs, shards, **more).collect()
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) <= set(range(shards))
    assert [counts[s] for s in range(shards)] == sharding.shard_sizes(len(rows), shards)
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    return rows


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = placed(docs, 3)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1) for r in docs.collect())
    assert all(r["text_crc32"] == 0 for r in rows if r["size"] == 1)
    assert placed(empty(spark)) == []


def test_rows_in_any_layout_go_to_the_same_places(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS", 64)
    monkeypatch.setattr(sharding, "PARTS", 4)
    docs = spark.range(5000).selectExpr("id as doc_id", "cast(id % 50 as string) as text")
    first = sorted(map(tuple, placed(docs)))
    assert first == sorted(map(tuple, placed(docs.repartition(7, "text"))))
    assert first != sorted(map(tuple, placed(docs, seed=1)))


def test_places_are_uniform(spark, monkeypatch):
    """Neighbours spread over shards and slots as chance has it."""
    monkeypatch.setattr(sharding, "ROWS", 64)
    rows = placed(spark.range(8000).selectExpr("id as doc_id", "'same' as text"))
    by_id = {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    cells = np.zeros((8, 8))
    for i in range(8000):
        shard, slot = by_id[i]
        cells[i // 1000, shard] += 1
    assert ((cells - 125) ** 2 / 125).sum() < 100  # 49 degrees of freedom
    same = sum(by_id[i][0] == by_id[i + 1][0] for i in range(7999))
    assert abs(same - 1000) < 150
    slots = np.array([by_id[i][1] for i in range(8000)])
    assert abs(np.corrcoef(np.arange(8000), slots)[0, 1]) < 0.05


def test_many_copies_of_one_row(spark, monkeypatch):
    """A row with most of the table's copies is dealt over parts and shards like others."""
    monkeypatch.setattr(sharding, "COPIES", 100)
    monkeypatch.setattr(sharding, "ROWS", 64)
    docs = spark.range(3000).selectExpr("cast(if(id < 2500, null, id) as long) as doc_id", "if(id < 2500, 'x', 'y') as text")
    rows = placed(docs)
    hot = Counter(r["shard"] for r in rows if r["size"] == 2 and r["doc_id"] is None)
    assert sum(hot.values()) == 2500 and min(hot.values()) > 250


def test_shards_hold_every_row(spark, tmp_path):
    docs = awkward(spark).selectExpr("*", "map('k', doc_id) as m", "1 as shard")
    folder = str(tmp_path / "shards")
    shard, slot = sharding.write_shards(docs, folder, 4)
    assert (shard, slot) == ("_shard", "slot")
    back = spark.read.parquet(folder)
    as_rows = lambda df: sorted(map(repr, df.select(docs.columns).collect()))
    assert as_rows(back) == as_rows(docs)
    places = {(r[shard], r[slot]) for r in back.collect()}
    assert len(places) == docs.count()
