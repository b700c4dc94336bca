"""Streams: texts called once over all waves, replays, state that stays bounded."""

import time

import pytest
from pyspark.errors import StreamingQueryException

from tarjuman.operators.providers import ColumnProvider, transliterated, transliterator
from tarjuman.plans.translate import translate_table
from tarjuman.streaming.arrivals import arriving_files, translate_stream
from pyspark.sql import functions as F

SCHEMA = "id long, t string"


class Watched:
    """Keeps the texts that each round asked for; fails at round ``fail_at``."""

    def __init__(self, inner, fail_at=None):
        self.inner, self.name, self.remote, self.fail_at, self.rounds = inner, inner.name, False, fail_at, []

    def answer(self, prompts, attempt=1):
        if len(self.rounds) + 1 == self.fail_at:
            raise RuntimeError("killed")
        self.rounds.append(sorted(r[0] for r in prompts.select("prompt").collect()))
        return self.inner.answer(prompts, attempt)


def wave(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, provider, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = arriving_files(spark, str(tmp_path / "in"), schema, max_files=1)
    query = translate_stream(
        stream, ["t"], [provider], ["id"], str(tmp_path / "out"), str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    return query


def result(spark, tmp_path):
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return {r["id"]: (r["t"], r["t_ar"], r["t_api"]) for r in rows}


def test_a_text_in_three_waves_is_called_once(spark, tmp_path):
    provider = Watched(transliterator("p"))
    rows = []
    for number in range(3):
        own = [(10 * number + i, f"the same text {i}") for i in range(4)] + [(10 * number + 9, f"only in {number}"), (10 * number + 8, None)]
        rows += own
        wave(spark, str(tmp_path / "in"), own)
        run(spark, tmp_path, provider)
    asked = [t for texts in provider.rounds for t in texts]
    assert sorted(asked) == sorted({t for _, t in rows if t})
    whole = translate_table(spark.createDataFrame(rows, SCHEMA), ["t"], [transliterator("p")], ["id"])
    assert result(spark, tmp_path) == {r["id"]: (r["t"], r["t_ar"], r["t_api"]) for r in whole.collect()}


def picky():
    """Good replies for short texts at once, for others at the third attempt."""
    return ColumnProvider(
        "p", lambda prompt, attempt: transliterated(prompt),
        lambda prompt, attempt: F.when((F.length(prompt) > 8) & F.lit(attempt < 3), F.lit("busy")))


@pytest.mark.parametrize("fail_at", [1, 2, 3])
def test_a_batch_killed_between_rounds_repeats_no_finished_round(spark, tmp_path, fail_at):
    wave(spark, str(tmp_path / "in"), [(1, "short"), (2, "a longer text"), (3, "another long text")])
    broken, whole = Watched(picky(), fail_at), Watched(picky())
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path, broken)
    run(spark, tmp_path, whole)
    long = ["a longer text", "another long text"]
    assert broken.rounds + whole.rounds == [sorted([*long, "short"]), long, long]
    got = result(spark, tmp_path)
    assert all(api == "p" for _, _, api in got.values()) and len(got) == 3
    again = Watched(picky())
    run(spark, tmp_path, again)
    assert again.rounds == [] and result(spark, tmp_path) == got


def test_state_holds_the_keys_of_a_time_only(spark, tmp_path):
    for number in range(5):
        wave(spark, str(tmp_path / "in"), [(100 * number + i, "text") for i in range(50)] + [(100 * max(number - 1, 0), "text")])
        query = run(spark, tmp_path, transliterator("p"), keep="2 seconds")
        time.sleep(2.5)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) <= 150 < 5 * 50
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.select("id").distinct().count() == 250


@pytest.mark.parametrize("options", [{}, {"keep": None}])
def test_rows_that_come_twice(spark, tmp_path, options):
    for _ in range(2):
        wave(spark, str(tmp_path / "in"), [(1, "one text"), (1, "one text"), (2, "two texts")])
        run(spark, tmp_path, transliterator("p"), **options)
    assert set(result(spark, tmp_path)) == {1, 2}


def test_a_column_called_arrived(spark, tmp_path):
    spark.createDataFrame([(1, "some text", "mine")], "id long, t string, arrived string").write.parquet(str(tmp_path / "in"))
    schema = spark.createDataFrame([], "id long, t string, arrived string").schema
    query = translate_stream(
        arriving_files(spark, str(tmp_path / "in"), schema), ["t"], [transliterator("p")], ["id"],
        str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert [(r["arrived"], r["t_api"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("mine", "p")]
