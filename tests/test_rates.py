"""Rate analytics against sequential statements of the limiter, ties and hot lanes included."""

import random
from collections import deque

import pytest

from tarjuman.operators import rate
from tarjuman.operators.ordered import sorted_runs

SECOND = 1_000_000


@pytest.fixture(scope="module")
def log():
    rng = random.Random(3)
    calls = []
    for i in range(3000):
        # One lane holds most calls, and a third of them share one instant.
        lane = "hot" if i % 4 else rng.choice(["a", "b", None])
        at = 500 * SECOND if i % 3 == 0 else rng.randrange(0, 1000 * SECOND, SECOND // 2)
        calls.append((i, lane, at))
    return calls


@pytest.fixture(scope="module")
def calls(spark, log):
    return spark.createDataFrame(log, "id long, lane string, at long")


@pytest.fixture(scope="module", autouse=True)
def many_runs(spark):
    """Keep adaptive execution from joining the few rows here into one run."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_runs_cut_a_lane_whose_calls_share_one_instant(spark):
    calls = spark.range(4000).selectExpr("id", "'hot' as lane", "7L as at")
    runs = sorted_runs(calls, ["lane", "at", "id"])
    sizes = [r["count"] for r in runs.groupBy("run").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 2000
    rows = rate.trailing_calls(calls, "id", "lane", "at", 60).select("calls", "oldest").distinct()
    assert [tuple(r) for r in rows.collect()] == [(4000, 7)]


def by_lane(log):
    lanes = {}
    for call in sorted(log, key=lambda c: (c[2], c[0])):
        lanes.setdefault(call[1], []).append(call)
    return lanes


def test_trailing_calls_and_wait(calls, log):
    window, limit = 60, 12
    got = {r["id"]: r for r in rate.wait_time(calls, "id", "lane", "at", limit, window).collect()}
    trailing = {r["id"]: r for r in
                rate.trailing_calls(calls, "id", "lane", "at", window).collect()}
    assert len(got) == len(trailing) == len(log)
    for lane in by_lane(log).values():
        times = [c[2] for c in lane]
        for i, _, at in lane:
            inside = [t for t in times if at - window * SECOND <= t <= at]
            assert trailing[i]["calls"] == len(inside)
            assert trailing[i]["oldest"] == min(inside)
            wait = 0.0
            if len(inside) >= limit:
                wait = max(0.0, window - (at - min(inside)) / SECOND)
            assert got[i]["wait_seconds"] == pytest.approx(wait)


def test_admission_follows_the_recurrence(calls, log):
    window, limit = 60, 7
    rows = rate.admission_times(calls, "id", "lane", "at", limit, window).collect()
    got = {r["id"]: r["start_micros"] for r in rows}
    assert len(got) == len(log)
    for lane in by_lane(log).values():
        starts = deque(maxlen=limit)
        for i, _, at in lane:
            start = at if len(starts) < limit else max(at, starts[0] + window * SECOND)
            starts.append(start)
            assert got[i] == start
