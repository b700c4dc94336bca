"""The first rows of a table by both ways of finding the cut."""

import datetime
import random

import pytest

from tarjuman.operators import shape

SCHEMA = "i int, l long, d double, s string, t timestamp, day date, v string"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    now = datetime.datetime(2024, 1, 1)

    def some(value):
        return None if rng.random() < 0.1 else value

    rows = [
        (some(rng.randint(-50, 50)), some(rng.randint(-10**17, 10**17)),
         some(rng.choice([float("nan"), float("inf"), -1.5, rng.gauss(0, 9)])),
         some(rng.choice(["", "é", "zz"]) + "shared prefix "[: rng.randint(0, 14)] + str(rng.randint(0, 99))),
         some(now + datetime.timedelta(seconds=rng.randint(0, 10**6))),
         some(now.date() + datetime.timedelta(days=rng.randint(0, 40))), f"v{i % 700}")
        for i in range(1500)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def as_set(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("key", [["i"], ["l"], ["d"], ["s"], ["t"], ["day"], ["i", "s"], ["day", "v"]])
def test_sketch_and_preview_agree(spark, table, key, monkeypatch):
    narrowed = []
    near = shape._near
    monkeypatch.setattr(shape, "_near", lambda p, n: narrowed.append(near(p, n)) or narrowed[-1])
    for n in (1, 140, 777, 1499):
        preview = as_set(shape.limit_rows(table, key, n))
        monkeypatch.setattr(shape, "MOST_PREVIEWED", 0)
        assert as_set(shape.limit_rows(table, key, n)) == preview and len(preview) == n
        monkeypatch.undo()
        monkeypatch.setattr(shape, "_near", lambda p, n: narrowed.append(near(p, n)) or narrowed[-1])
    assert all(found is not None for found in narrowed[:1]) and narrowed


def test_sorted_values_are_the_smallest(table):
    want = sorted(r["l"] for r in table.collect() if r["l"] is not None)
    nulls = table.where("l is null").count()
    got = sorted(r["l"] for r in shape.limit_rows(table, "l", nulls + 400).collect() if r["l"] is not None)
    assert got == want[:400]


def test_only_a_range_is_sorted(table, monkeypatch):
    monkeypatch.setattr(shape, "MOST_PREVIEWED", 0)
    seen = []
    exact = shape._exact_cut
    monkeypatch.setattr(shape, "_exact_cut", lambda p, n: seen.append(p.count()) or exact(p, n))
    assert shape.limit_rows(table, "l", 900).count() == 900
    assert seen[0] < 100


def test_more_rows_than_there_are(table, monkeypatch):
    assert shape.limit_rows(table, "l", 5000).count() == 1500
    monkeypatch.setattr(shape, "MOST_PREVIEWED", 0)
    assert shape.limit_rows(table, "l", 5000).count() == 1500
    assert shape.limit_rows(table, "l", 0).count() == 0
