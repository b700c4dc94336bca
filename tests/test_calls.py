"""Calls of a client: packing, order, errors of items, time limits, the schedule under a limit."""

import os
import subprocess
import sys
import time

import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tarjuman.operators import calls
from tarjuman.operators.calls import Call, CallProvider, Pool, call_log, pack
from tarjuman.operators.providers import transliterating_lists


@given(st.lists(st.integers(0, 30), max_size=40), st.integers(1, 5), st.integers(0, 60))
def test_packing(lengths, items, chars):
    numbers = list(pack(lengths, items, chars))
    groups = {}
    for number, length in zip(numbers, lengths):
        groups.setdefault(number, []).append(length)
    assert numbers == sorted(numbers) and list(groups) == list(range(len(groups)))
    for own in groups.values():
        assert len(own) <= items and (sum(own) <= chars or len(own) == 1)


def prompts_of(spark, texts, parts=2):
    return spark.createDataFrame(list(enumerate(texts)), "i int, prompt string").repartition(parts)


def uneven_client():
    def call(texts):
        assert len(texts) <= 4 and sum(map(len, texts)) <= 40
        if "bad list" in texts:
            raise ValueError("refused")
        return [ValueError("bad item") if t == "bad" else {"success": False, "translation": None, "error": "busy"}
                if t == "busy" else t.upper() for t in texts]

    return call


def test_lists_keep_order_and_errors_of_items(spark):
    texts = [f"t{i}" for i in range(40)] + ["bad", "busy", None, "x" * 90]
    texts[7] = "bad"
    provider = CallProvider("p", uneven_client, many=True, max_items=4, max_chars=40, in_flight=3)
    got = {r["i"]: tuple(r)[1:] for r in provider.answer(prompts_of(spark, texts[:-1])).collect()}
    for i, text in enumerate(texts[:-1]):
        want = {"bad": (False, None, "bad item"), "busy": (False, None, "busy"), None: (False, None, "no prompt")}
        assert got[i] == (text, *want.get(text, (True, (text or "").upper(), None)))


def test_a_failed_list_is_tried_in_halves(spark):
    texts = ["a", "b", "bad list", "c"]
    for tries, failed in ((1, 4), (2, 2), (3, 1)):
        provider = CallProvider("p", uneven_client, many=True, max_items=4, tries=tries, backoff=0.01)
        rows = provider.answer(prompts_of(spark, texts, 1).coalesce(1)).collect()
        assert sum(not r["success"] for r in rows) == failed
        assert all(r["error"] == "refused" for r in rows if not r["success"])


def short_client():
    return lambda texts: texts[:-1]


def test_wrong_number_of_replies(spark):
    rows = CallProvider("p", short_client, many=True).answer(prompts_of(spark, ["a", "b"], 1).coalesce(1)).collect()
    assert {r["error"] for r in rows} == {"1 replies for 2 texts"}


def hanging_client():
    def call(text):
        if text.startswith("hang"):
            time.sleep(600)
        return text

    return call


@pytest.mark.parametrize("in_flight", [1, 3])
def test_a_hanging_call_ends_as_an_error_of_its_text(spark, in_flight):
    texts = ["a", "hang 1", "b", "hang 2", "c", "d"]
    provider = CallProvider("p", hanging_client, timeout=0.5, in_flight=in_flight)
    start = time.time()
    got = {r["prompt"]: (r["success"], r["error"]) for r in provider.answer(prompts_of(spark, texts)).collect()}
    assert time.time() - start < 30
    for text in texts:
        assert got[text] == ((False, "timeout after 0.5 s") if "hang" in text else (True, None))


def test_a_client_that_hangs_or_fails_to_connect():
    pool = Pool(lambda: time.sleep(600), 1, False, 0.3)
    late = Call(["x"])
    pool.run([late])
    assert late.replies == [(False, None, "timeout after 0.3 s")]

    def broken():
        raise OSError("no route")

    failed = [Call(["x"]), Call(["y"])]
    Pool(broken, 1, False, 5).run(failed)
    assert [c.replies for c in failed] == [[(False, None, "no route")]] * 2


def slow_client():
    def call(texts):
        time.sleep(0.2)
        return texts

    return call


def test_calls_in_flight_overlap():
    made = [Call([str(i)]) for i in range(10)]
    start = time.time()
    Pool(slow_client, 10, True, 5).run(made)
    assert time.time() - start < 1.5
    assert [c.replies[0][1] for c in made] == [str(i) for i in range(10)]


def clock_client():
    return lambda texts: [f"{time.time()}"] * len(texts)


def times_of(frame):
    return [float(r["translation"]) for r in frame.collect()]


def check_windows(times, limit, window):
    times = sorted(times)
    assert all(b - a > window for a, b in zip(times, times[limit:]))


def test_one_limit_over_rounds_lanes_and_a_resumed_run(spark, tmp_path):
    """Two rounds of one provider, then another process's provider on the same log."""
    log = str(tmp_path / "log")
    options = dict(per_minute=6, window=2, many=True, max_items=2, lanes=3, in_flight=2, lead=1.0, log=log)
    times = []
    for provider in [CallProvider("p", clock_client, **options)] * 2 + [CallProvider("p", clock_client, **options)]:
        frame = provider.answer(prompts_of(spark, [f"t{i}" for i in range(20)], 3))
        times += sorted({t for t in times_of(frame)})
    check_windows(times, 6, 2)
    logged = call_log(spark, log).where("made")
    assert logged.count() == len(times) and logged.select("pass").distinct().count() >= 3


def test_starts_follow_the_recurrence(spark, tmp_path):
    """With no pace, starts are those of a log that admits what it may at once."""
    log, span = str(tmp_path / "log"), 1.05
    provider = CallProvider("p", clock_client, per_minute=3, window=1, many=True, max_items=1, in_flight=8,
                            pace=0, log=log, lead=1.5)
    for _ in range(2):
        provider.answer(prompts_of(spark, list("abcdefg"), 1).coalesce(1)).collect()
    planned = spark.read.parquet(log).where("state = 'planned'")
    starts = sorted(r["start"] for r in planned.collect())
    assert all(b - a >= span - 1e-6 for a, b in zip(starts, starts[3:]))
    first = sorted(r["start"] for r in planned.where("pass = 0").collect())
    assert [round((s - first[0]) / span, 3) for s in first] == [0, 0, 0, 1, 1, 1, 2]


def test_no_pause_between_rounds_that_stay_below_the_limit(spark):
    provider = CallProvider("p", clock_client, per_minute=1000, window=60, many=True, max_items=5, lead=0.5)
    start = time.time()
    for _ in range(2):
        assert provider.answer(prompts_of(spark, list("abcdef"))).count() == 6
    assert time.time() - start < 40


def test_a_late_task_makes_no_call():
    """What a task finds past its start, it leaves for the next pass."""
    made = []

    def client():
        return lambda texts: made.append(texts) or texts

    rows = pd.DataFrame({
        "prompt": ["a", "b", "c"], "_rank": [0, 0, 1], "_start": [time.time() - 9] * 2 + [time.time() + 0.2],
        "_first": [True, False, True]})
    call = calls._on_time(lambda: Pool(client, 1, True, 5), 0.5)
    told = pd.concat(call(iter([rows.iloc[:1], rows.iloc[1:]])), ignore_index=True)
    assert told["_late"].tolist() == [True, True, False] and made == [["c"]]
    assert told["translation"].tolist() == [None, None, "c"]


def test_a_dead_run_s_plan_counts_as_called(spark, tmp_path):
    """Starts planned by a run that died may have been used; those to come were not."""
    log, now = str(tmp_path / "log"), time.time()
    planned = [("p", now - 0.5, True), ("p", now - 0.4, True), ("p", now + 500.0, True)]
    spark.createDataFrame(planned, "api string, start double, made boolean").write.parquet(f"{log}/pass=0/state=planned")
    provider = CallProvider("p", clock_client, per_minute=2, window=3, many=True, max_items=1, log=log, lead=0.5, in_flight=4)
    times = times_of(provider.answer(prompts_of(spark, ["a", "b"], 1)))
    assert min(times) > now - 0.5 + 3 and max(times) < now + 60


def test_empty_table(spark):
    provider = CallProvider("p", clock_client, per_minute=2, many=True)
    got = provider.answer(spark.createDataFrame([], "i int, prompt string"))
    assert got.columns == ["i", "prompt", "success", "translation", "error"] and got.count() == 0


RETRIED = """
import os, sys, time
from tarjuman.operators.calls import CallProvider
from tarjuman.session import local_session
folder = sys.argv[1]
spark = local_session("2,3", "retried", **{"spark.checkpoint.dir": folder, "spark.driver.memory": "1g"})
def client():
    def call(texts):
        with open(f"{folder}/made", "a") as out:
            out.write(f"{time.time()}\\n")
        if "t7" in texts and not os.path.exists(f"{folder}/died"):
            open(f"{folder}/died", "w").close()
            os._exit(1)
        return texts
    return call
prompts = spark.createDataFrame([(f"t{i}",) for i in range(16)], "prompt string").coalesce(2)
provider = CallProvider("p", client, per_minute=4, window=1, lanes=2, many=True, max_items=1)
got = provider.answer(prompts).collect()
assert sorted(r["translation"] for r in got) == sorted(f"t{i}" for i in range(16)), got
"""


def test_a_task_that_dies_and_is_run_again_keeps_the_limit(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", RETRIED, str(tmp_path)], cwd=root, timeout=300,
                         capture_output=True, text=True, env={**os.environ, "PYTHONPATH": root})
    assert run.returncode == 0, run.stderr[-2000:]
    assert (tmp_path / "died").exists()
    check_windows([float(t) for t in (tmp_path / "made").read_text().split()], 4, 1)


def test_stand_in_for_lists():
    assert transliterating_lists()(["ab", "B"]) == ["اب", "ب"]


def test_slow_calls_are_sent_in_one_pass(spark, tmp_path):
    """Calls that take longer than planned go on at later places; nothing is written again."""
    def client():
        def call(texts):
            time.sleep(0.3)
            return [f"{time.time() - 0.3}"] * len(texts)

        return call

    log = str(tmp_path / "log")
    provider = CallProvider("p", client, per_minute=4, window=1, lanes=2, many=True, max_items=2, lead=0.5,
                            slack=0.05, log=log)
    provider = calls.replace(provider, per_minute=20)
    frame = provider.answer(prompts_of(spark, [f"t{i}" for i in range(60)], 3))
    assert frame.count() == 60 and frame.where("success").count() == 60
    times = sorted(set(times_of(frame)))
    check_windows(times, 20, 0.99)
    logged = call_log(spark, log)
    assert {r["pass"] for r in logged.collect()} == {0} and logged.where("made").count() == len(times)


def test_places_are_used_once_a_window():
    places = calls.Places(1.0, 0.1)
    places.add([10.0, 10.5])
    assert [places.take(9.0), places.take(9.0), places.take(9.0)] == [10.0, 10.5, 11.0]
    assert places.take(14.7) == 15.0 and places.take(14.7) == 15.5
    again = calls.Places(1.0, 0.1, since=12.2)
    again.add([10.0, 12.19])
    assert [again.take(12.2), again.take(12.2)] == [13.0, 13.19]


def test_a_run_that_died_late_may_have_used_its_places_again(spark, tmp_path):
    log, now = str(tmp_path / "log"), time.time()
    planned = [("p", now - 60.5, True), ("p", now - 60.4, True)]
    spark.createDataFrame(planned, "api string, start double, made boolean").write.parquet(f"{log}/pass=0/state=planned")
    recent = calls.recent_calls(spark, log, "p", 2, now - 3, now).collect()
    assert len(recent) == 2 and all(now - 3 <= r["_last"] <= now for r in recent)


def test_batches_are_answered_in_pieces():
    batch = pd.DataFrame({"prompt": ["a" * 10, None, "b" * 25, "c"] * 3, "i": range(12)})
    parts = list(calls.pieces([batch, batch.iloc[:0]], 3, 30))
    assert pd.concat(parts)["i"].tolist() == list(range(12)) and max(map(len, parts)) <= 3
    assert all(sum(len(p or "") for p in part["prompt"]) <= 30 or len(part) == 1 for part in parts)


def test_tasks_answer_pieces_of_a_batch(monkeypatch):
    rows = pd.DataFrame({"prompt": ["x"] * 2500})
    told = list(CallProvider("p", transliterating_lists, many=True)._caller()(iter([rows])))
    assert [len(t) for t in told] == [1000, 1000, 500] and sum(t["success"].sum() for t in told) == 2500
