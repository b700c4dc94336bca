"""Whole runs against a cell-by-cell simulation, with failures, resume and skew."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tarjuman import fixed
from tarjuman.operators import progress, rounds, skew, statistics
from tarjuman.operators.providers import (
    LATIN, LETTERS, CallProvider, ColumnProvider, MemoryProvider, transliterated,
    transliterating_client, transliterator,
)
from tarjuman.plans import translate as plan
from tarjuman.plans.translate import failed_cells, translate, translate_table
from tests.test_properties import (
    plain_clean, plain_mojibake, plain_postprocess, plain_script_ratio, plain_terms,
)

RANK = {"first": 1, "second": 2}


def plain_reply(name, prompt, attempt):
    """The scripted provider: an error, a null, blanks, an echo, damage, excess, or good."""
    code = (len(prompt) * 7 + RANK[name] * 3 + attempt * 5) % 8
    good = prompt.lower().translate(str.maketrans(LATIN, LETTERS))
    table = {0: None, 1: None, 2: "   ", 3: prompt, 4: good + "Ã©", 5: good * 4}
    return code, table.get(code, good)


def scripted(name):
    def code(prompt, attempt):
        return (F.length(prompt) * 7 + RANK[name] * 3 + attempt * 5) % 8

    def reply(prompt, attempt):
        c, good = code(prompt, attempt), transliterated(prompt)
        return (F.when(c == 2, "   ").when(c == 3, prompt)
                .when(c == 4, F.concat(good, F.lit("Ã©"))).when(c == 5, F.repeat(good, F.lit(4)))
                .when(c > 5, good))

    return ColumnProvider(name, reply, lambda p, a: F.when(code(p, a) == 0, F.lit("timeout")))


def plain_valid(original, reply):
    if reply is None:
        return False
    ratio = len(reply) / len(original) if original else 1
    return (len(reply.strip()) >= 1 and plain_script_ratio(reply) >= 0.5
            and plain_script_ratio(reply) > 0 and 0.3 <= ratio <= 3.0
            and not plain_mojibake(reply))


def plain_translate(original, order, retries=3):
    prompt = plain_terms(plain_clean(original))
    made = 0
    for name in order:
        for attempt in range(1, retries + 1):
            made += 1
            code, reply = plain_reply(name, prompt, attempt)
            if code and plain_valid(original, reply):
                return plain_postprocess(reply), name, made
    return None, None, made


def make_texts(n, seed):
    rng = random.Random(seed)
    words = ["hello", "ChatGPT", "World ", "\n \n", "gpt-4", "12", "#$%", "aé", "of", "\x07", "x" * 9]
    return [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def cells(spark):
    bodies, titles = make_texts(400, 1), make_texts(400, 2)
    rows = [
        (i, None if i % 11 == 0 else ("the same hot text" if i % 3 == 0 else bodies[i]),
         None if i % 13 == 0 else titles[i], i * 1.5)
        for i in range(400)
    ]
    return rows, spark.createDataFrame(rows, "id long, body string, title string, n double")


def expected_table(rows, order, columns=("body", "title")):
    out = {}
    for i, body, title, _ in rows:
        texts = {"body": body, "title": title}
        out[i] = tuple(
            plain_translate(texts[c], order)[:2] if texts[c] is not None else (None, None)
            for c in columns
        )
    return out


def as_dict(df, columns=("body", "title")):
    rows = df.collect()
    got = {r["id"]: tuple((r[f"{c}_ar"], r[f"{c}_api"]) for c in columns) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("order, columns", [
    (("first",), ("body",)),
    (("first", "second"), ("body", "title")),
    (("second", "first"), ("body",)),
])
def test_run_equals_simulation(cells, order, columns):
    rows, df = cells
    run = translate(df, list(columns), [scripted(n) for n in order], ["id"])
    assert as_dict(run.table, columns) == expected_table(rows, order, columns)
    assert run.table.columns[:4] == df.columns


def test_attempt_accounting_equals_simulation(cells):
    rows, df = cells
    order = ("first", "second")
    run = translate(df, ["body"], [scripted(n) for n in order], ["id"])
    made = sum(plain_translate(r[1], order)[2] for r in rows if r[1] is not None)
    counted = rounds.attempt_outcomes(run.attempts, F.col("n_cells")).collect()
    assert sum(r["attempts"] for r in counted) == made
    accepted = {r["api"]: r["attempts"] for r in counted if r["outcome"] == "accepted"}
    stats = statistics.stats_from_outcomes(df, run.requests, run.finished, list(order)).first()
    full = statistics.run_stats(run.table, ["body"], list(order)).first()
    assert stats.asDict() == full.asDict()
    assert stats["first_used"] == accepted["first"] and stats["second_used"] == accepted["second"]
    assert stats["total"] == 400 and stats["failed"] > 0
    lost = failed_cells(df, ["body"], ["id"], run).collect()
    listed = statistics.failed_cells(run.table, ["id"], ["body"]).collect()
    assert {r["id"] for r in lost} == {r["id"] for r in listed}
    assert len(lost) == stats["failed"] and {r["error"] for r in lost} == {fixed.EXHAUSTED}


@pytest.mark.parametrize("columns", [("body",), ("body", "title")])
def test_hot_text_is_salted_and_result_unchanged(cells, columns, monkeypatch):
    rows, df = cells
    seen = []
    original = skew.hot_keys

    def tiny(sizes, key, size):
        seen.append(original(sizes, key, size, parts=8, min_rows=5))
        return seen[-1]

    monkeypatch.setattr(plan, "hot_keys", tiny)
    table = translate_table(df, list(columns), [scripted("first")], ["id"])
    assert as_dict(table, columns) == expected_table(rows, ("first",), columns)
    assert max(seen[0].values()) > 1


def test_preserve_off_keeps_rows_without_success(cells):
    rows, df = cells
    for columns in (["body"], ["body", "title"]):
        table = translate_table(df, columns, [scripted("first")], ["id"], preserve=False)
        names = [f"{c}_ar" for c in columns] + [f"{c}_api" for c in columns]
        assert sorted(table.columns) == sorted(["id", *names])
        assert as_dict(table, columns) == expected_table(rows, ("first",), columns)


def test_literal_nulls_are_translated(spark):
    df = spark.createDataFrame([(1, None), (2, "hello")], "id long, t string")
    table = translate_table(df, ["t"], [transliterator("p")], ["id"], null_policy="literal")
    got = {r["id"]: r["t_ar"] for r in table.collect()}
    assert got == {1: "nan".translate(str.maketrans(LATIN, LETTERS)), 2: got[2]} and got[2]


class Counting:
    """Counts the prompts a provider is asked, through an accumulator."""

    def __init__(self, spark, inner, fail_after=None):
        self.inner, self.name, self.remote = inner, inner.name, False
        self.asked, self.rounds, self.fail_after = [], 0, fail_after

    def answer(self, prompts, attempt=1):
        if self.fail_after is not None and self.rounds >= self.fail_after:
            raise RuntimeError("killed")
        self.rounds += 1
        self.asked += [r[0] for r in prompts.select("text_key").collect()]
        return self.inner.answer(prompts, attempt)


@pytest.mark.parametrize("batches, fail_after", [(1, 0), (1, 2), (3, 1)])
def test_killed_run_resumes_to_the_same_table(spark, cells, tmp_path, batches, fail_after):
    rows, df = cells
    folder = str(tmp_path / "progress")
    broken = Counting(spark, scripted("first"), fail_after)
    with pytest.raises(RuntimeError):
        translate(df, ["body"], [broken], ["id"], progress_folder=folder, batches=batches)
    again = Counting(spark, scripted("first"))
    run = translate(df, ["body"], [again], ["id"], progress_folder=folder, resume=True,
                    batches=batches)
    assert as_dict(run.table, ("body",)) == expected_table(rows, ("first",), ("body",))
    keys = [r[0] for r in run.finished.select("text_key").collect()]
    assert len(keys) == len(set(keys)) == run.requests.count()
    if fail_after:
        assert len(set(again.asked)) < run.requests.count()


def test_finished_work_is_not_sent_again(spark, cells, tmp_path):
    _, df = cells
    folder = str(tmp_path / "progress")
    first = translate(df.where("id < 200"), ["body"], [scripted("first")], ["id"],
                      progress_folder=folder)
    with pytest.raises(ValueError, match="finished work"):
        translate(df, ["body"], [scripted("first")], ["id"], progress_folder=folder)
    done = {r[0] for r in first.finished.select("text_key").collect()}
    counting = Counting(spark, scripted("first"))
    translate(df, ["body"], [counting], ["id"], progress_folder=folder, resume=True)
    assert counting.asked and not done & set(counting.asked)


def exchanges_above(plan: str, leaf: str) -> list[str]:
    """The operators on the way from a scan of ``leaf`` up to the join it feeds."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Scan parquet" in line and leaf in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            depth = own
            found.append(line.strip(" :+-"))
            if "Join" in line:
                return found
    return found


def test_the_history_of_a_resumed_run_is_not_shuffled(spark, cells, tmp_path, monkeypatch):
    _, df = cells
    folder = str(tmp_path / "progress")
    translate(df.where("id < 300"), ["body"], [scripted("first")], ["id"], progress_folder=folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        history = progress.Settled(spark, folder, plan.SETTLED)
        requests = plan.distinct_requests(df, ["body"])
        for how in ("left_anti", "left_semi"):
            looked = (requests.join(history.table().select("text_key"), "text_key", how) if how == "left_anti"
                      else history.table().join(requests.select("text_key"), "text_key", how))
            shown = looked._jdf.queryExecution().executedPlan().toString()
            way = exchanges_above(shown, history.name)
            assert "Join" in way[-1] and not any("Exchange" in step for step in way), shown
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_history_is_appended_and_found_by_another_session(spark, cells, tmp_path):
    """Each text once, whatever runs settled it; the table may be unknown to the session."""
    rows, df = cells
    folder = str(tmp_path / "it's progress")
    translate(df.where("id < 200"), ["body"], [scripted("first")], ["id"], progress_folder=folder)
    history = progress.Settled(spark, folder, plan.SETTLED)
    assert history.latest() == 0
    spark.sql(f"drop table {history.name}")
    counting = Counting(spark, scripted("first"))
    run = translate(df, ["body"], [counting], ["id"], progress_folder=folder, resume=True)
    assert as_dict(run.table, ("body",)) == expected_table(rows, ("first",), ("body",))
    keys = [r[0] for r in history.table().select("text_key").collect()]
    assert len(keys) == len(set(keys)) == run.requests.count() and history.latest() == 1
    # Texts of earlier runs that this one does not have are left out.
    part = translate(df.where("id < 20"), ["body"], [counting], ["id"], progress_folder=folder, resume=True)
    assert part.finished.count() == part.requests.count() < len(keys) and part.attempts.count() == 0


def test_resume_from_a_named_batch_drops_later_ones(spark, cells, tmp_path):
    rows, df = cells
    folder = str(tmp_path / "progress")
    translate(df, ["body"], [scripted("first")], ["id"], progress_folder=folder, batch_rows=60)
    latest = progress.latest_batch(spark, folder)
    assert latest >= 2
    run = translate(df, ["body"], [scripted("second")], ["id"], progress_folder=folder,
                    resume=True, upto=0)
    apis = {r["api"] for r in run.finished.where("api is not null").select("api").collect()}
    assert apis == {"first", "second"}
    keys = [r[0] for r in run.finished.select("text_key").collect()]
    assert len(keys) == len(set(keys)) == run.requests.count()
    again = Counting(spark, scripted("second"))
    translate(df, ["body"], [again], ["id"], progress_folder=folder, resume=True)
    assert again.asked == []


def test_call_provider_equals_column_provider(cells):
    _, df = cells
    local = CallProvider("first", transliterating_client)
    assert as_dict(translate_table(df, ["body"], [local], ["id"]), ("body",)) == as_dict(
        translate_table(df, ["body"], [transliterator("first")], ["id"]), ("body",)
    )


def flaky_client():
    def call(text):
        if len(text) % 5 == 0:
            raise ValueError("no luck")
        if len(text) % 5 == 1:
            return {"success": False, "translation": None, "error": "busy"}
        return {"success": True, "translation": text.upper(), "error": None}

    return call


def test_call_errors_stay_with_their_text(spark):
    rows = [(i, "x" * i) for i in range(50)]
    prompts = spark.createDataFrame(rows, "i int, prompt string").repartition(3)
    provider = CallProvider("p", flaky_client, per_minute=600_000, lanes=3, window=1)
    got = {r["i"]: r for r in provider.answer(prompts).collect()}
    assert len(got) == 50
    for i, row in got.items():
        if i % 5 == 0:
            assert (row["success"], row["translation"], row["error"]) == (False, None, "no luck")
        elif i % 5 == 1:
            assert (row["success"], row["error"]) == (False, "busy")
        else:
            assert row["success"] and row["translation"] == "X" * i


def test_memory_as_primary_with_fallback(spark, cells):
    rows, df = cells
    known = spark.createDataFrame(
        [("the same hot text", "نص ساخن متكرر"), ("the same hot text", "نص ساخن متكرر")],
        "text string, translation string",
    )
    order = [MemoryProvider("memory", known), transliterator("machine")]
    table = translate_table(df, ["body"], order, ["id"], max_retries=1)
    used = {r["id"]: (r["body_ar"], r["body_api"]) for r in table.collect()}
    for i, body, _, _ in rows:
        if body == "the same hot text":
            assert used[i] == ("نص ساخن متكرر", "memory")
        else:
            assert used[i][1] in ("machine", None)


def test_memory_answers_every_row(spark):
    memory = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "text string, translation string")
    prompts = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, "c")], "i int, prompt string")
    got = sorted(map(tuple, MemoryProvider("m", memory).answer(prompts).drop("prompt").collect()))
    miss = (False, None, "not in memory")
    assert got == [(1, True, "x", None), (2, *miss), (3, True, "x", None), (4, *miss)]


def test_salted_join_equals_plain_join(spark):
    usual = (F.col("id") % 50).cast("string")
    left = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(usual).alias("k")
    )
    right = spark.createDataFrame([("hot", 1), ("7", 2), ("8", 3), ("none", 4)], "k string, v int")
    sizes = left.groupBy("k").agg(F.count("*").alias("n"))
    hot = skew.hot_keys(sizes, "k", "n", parts=10, min_rows=1)
    assert list(hot) == ["hot"] and hot["hot"] == 4
    for how in ("left", "inner"):
        salted = skew.salted_join(left, right, "k", ["id"], hot, how)
        plain = left.join(right, "k", how)
        assert sorted(map(tuple, salted.select("id", "k", "v").collect()), key=repr) == sorted(
            map(tuple, plain.select("id", "k", "v").collect()), key=repr
        )


def test_latest_number_is_numeric(spark):
    names = [(f"/c/checkpoint_{n}.csv",) for n in (50, 100, 950, 1000)]
    paths = spark.createDataFrame([*names, ("/c/other.csv",)], "path string")
    assert progress.latest_number(paths, "checkpoint_").first()[0] == 1000


def test_restore_leaves_originals(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", None)], "id int, t string, t_ar string")
    done = spark.createDataFrame([(1, "X")], "id int, t_ar string")
    got = {r["id"]: (r["t"], r["t_ar"]) for r in
           progress.restore(df, done, ["id"], ["t_ar"]).collect()}
    assert got == {1: ("a", "X"), 2: ("b", None)}


def test_columns_of_an_earlier_run_and_like_named_ones(spark):
    df = spark.createDataFrame(
        [(1, "hello", "keep", "old", "mine")], "id long, t string, api string, t_ar string, translation string"
    )
    for columns in (["t"], ["t", "api"]):
        row = translate_table(df, columns, [transliterator("p")], ["id"]).first()
        assert (row["api"], row["translation"], row["t_api"]) == ("keep", "mine", "p")
        assert row["t_ar"] not in ("old", None)


def test_bad_columns_are_refused(cells):
    _, df = cells
    for columns, key in ((["nope"], ["id"]), (["body"], ["nope"]), ([], ["id"]), (["body"], [])):
        with pytest.raises(ValueError):
            translate(df, columns, [transliterator("p")], key)


def test_null_and_repeated_keys_keep_their_own_translations(spark):
    rows = [(1, "hello there", "wide world"), (1, "good day", "bad luck"), (None, "hello there", None),
            (None, None, None), (2, None, "bad luck"), (2, "hello there", "wide world")]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    got = translate_table(df, ["a", "b"], [transliterator("p")], ["k"])
    single = {c: {r[c]: r[f"{c}_ar"] for r in translate_table(
        df.select("k", c).distinct(), [c], [transliterator("p")], ["k"]).collect()} for c in "ab"}
    want = [(*r, single["a"][r[1]], single["b"][r[2]]) for r in rows]
    assert sorted(map(repr, want)) == sorted(
        repr(tuple(r)) for r in got.select("k", "a", "b", "a_ar", "b_ar").collect())
    assert single["a"]["hello there"] and single["b"]["bad luck"]


def _timed_client():
    return lambda text: f"{time.time()}"


def test_the_limit_holds_over_rounds_and_lanes(spark):
    provider = CallProvider("p", _timed_client, per_minute=5, lanes=2, window=2)
    prompts = spark.createDataFrame([(f"t{i}",) for i in range(7)], "prompt string")
    times = []
    for attempt in (1, 2):
        times += [float(r["translation"]) for r in provider.answer(prompts, attempt).collect()]
    times.sort()
    assert len(times) == 14
    assert all(later - first > 1.9 for first, later in zip(times, times[5:]))
