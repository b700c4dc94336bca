"""Columns of the caller that are called like the operators' own, and values that were once lost."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tarjuman.llm import decontaminate, jaccard, language, lines, mixing, pseudonyms, quality, toxicity, urls
from tests.llm.rows import words

INNER = [
    "_id", "_fp", "_len", "_runs", "_gone", "_kept", "_lines", "_hit", "_spans", "_words", "_source", "_mix_hash",
    "_bucket", "_row", "_text", "_doc_id", "_class", "_print", "_pii_found", "_pii_new", "_language", "_quality",
    "_rule", "_grams", "_features", "_toxic_features", "_before", "_offset", "_order", "_places", "row", "first", "words",
]


@pytest.fixture(scope="module")
def named(spark):
    texts = [words(60, i % 3) + "\n" + "\n".join(f"line {j}" for j in range(6)) + "\nborn 29.02.2000" for i in range(6)]
    df = spark.createDataFrame(
        [(i, t, "en" if i % 2 else "de", "ab"[i % 2], f"http://x.example.com/{i}") for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, url string")
    return df.withColumns({name: F.lit(f"mine {name}") for name in INNER}).cache()


@pytest.mark.parametrize("run", [
    lambda df: language.identify(df, language.learn(df)),
    lambda df: lines.drop_repeated_lines(df),
    lambda df: mixing.mix(df),
    lambda df: jaccard.keep_one(df),
    lambda df: quality.judge(df, quality.learn(df)),
    lambda df: pseudonyms.pseudonymize(df, "k"),
    lambda df: decontaminate.find_contamination(df, df.limit(1).selectExpr("1 as item_id", "text")),
    lambda df: toxicity.score(df, toxicity.learn(df.selectExpr("*", "cast(doc_id % 2 as int) as label"))),
    lambda df: urls.judge(df),
], ids=["language", "lines", "mixing", "jaccard", "quality", "pseudonyms", "decontaminate", "toxicity", "urls"])
def test_inner_names_are_free(named, run):
    found = run(named)
    rows = found.collect()
    assert rows and set(named.columns) <= set(found.columns)
    assert all(r[name] == f"mine {name}" for r in rows for name in INNER)


def test_copies_do_not_hide_a_language(spark):
    rows = [(f"gleicher Text {i % 2}", "de") for i in range(4000)] + [(words(30, i), "en") for i in range(40)]
    model = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["de", "en"]
    assert model.predict(["gleicher Text 1", words(30, 3)])[0] == ["de", "en"]


def days(count, seed):
    rng = random.Random(seed)
    return [date(1601, 1, 1) + timedelta(days=rng.randrange(146_097)) for _ in range(count)]


def test_slash_dates_of_a_reading_stay_apart(spark):
    """All days of some years and random ones: pseudonyms are as many, and read as the input does."""
    own = {d for y in (1999, 2000) for d in (date(y, 1, 1) + timedelta(days=i) for i in range(365))} | set(days(3000, 1))
    values = {d.strftime("%d/%m/") + f"{d.year:04d}" for d in own} | {d.strftime("%m/%d/") + f"{d.year:04d}" for d in own}
    df = spark.createDataFrame([(v,) for v in sorted(values)], "v string")
    got = {r["v"]: r["p"] for r in df.select("v", pseudonyms.date("k", F.col("v")).alias("p")).collect()}
    assert len(set(got.values())) == len(values)
    by_month = [v for v in values if int(v[3:5]) > 12]
    assert by_month and all(int(got[v][3:5]) > 12 and int(got[v][:2]) <= 12 for v in by_month)
    assert all(int(got[v][3:5]) <= 12 for v in values if int(v[3:5]) <= 12)
    assert sum(got[v] != v for v in values) > 0.99 * len(values)


def test_late_days_are_a_permutation_of_a_cycle(spark):
    cycle = [date(1601, 1, 1) + timedelta(days=i) for i in range(0, 146_097)]
    late = [d for d in cycle if d.day > 12]
    df = spark.createDataFrame([(d.strftime("%m/%d/") + f"{d.year:04d}",) for d in late], "v string")
    assert df.select(pseudonyms.date("k", F.col("v")).alias("p")).distinct().count() == len(late) == 88_497


@pytest.mark.parametrize("spellings", [
    ["+49 151 12345678", "+4915112345678", "+49-151-1234-5678"], ["+1 (743) 555-3824", "+17435553824", "+1.743.555.3824"],
    ["+353 86 123 4567", "+353861234567"], ["+33 6 12 34 56 78", "+33612345678"],
])
def test_one_number_in_several_spellings(spark, spellings):
    df = spark.createDataFrame([(v,) for v in spellings], "v string")
    got = [r["p"] for r in df.select("v", pseudonyms.phone("k", F.col("v")).alias("p")).collect()]
    assert len({"".join(filter(str.isdigit, p)) for p in got}) == 1
    assert all("".join(filter(str.isdigit, p)) != "".join(filter(str.isdigit, v)) for p, v in zip(got, spellings))


def test_a_long_text_of_repeated_lines(spark):
    """Cut in time linear in the lines."""
    body = "\n".join(f"l{i % 7}" for i in range(30_000))
    df = spark.createDataFrame([(1, body), (2, body)], "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.drop_repeated_lines(df).collect()}
    # All seven windows lie in the first nine lines.
    assert got == {1: ("\n".join(f"l{i % 7}" for i in range(9)).rsplit("\n", 2)[0], 29_993), 2: ("", 30_000)}


def test_a_verdict_does_not_depend_on_other_pages(spark):
    def verdict(others):
        df = spark.createDataFrame([("http://a.example.net/en/5",), *others], "url string")
        return [tuple(r) for r in urls.judge(df).where("url like '%a.example.net%'").select("score", "verdict").collect()]

    assert verdict([]) == verdict([("http://x.com/de/1",), ("http://y.com/fr/2",), ("http://z.org/1",)])


def test_another_schedule_changes_the_positions(spark):
    df = spark.range(40).selectExpr("id as doc_id", "repeat('w ', 10) as text", "cast(id % 3 as string) as source")
    first = lambda s: sorted(map(tuple, mixing.mix(df, schedules=s).select("doc_id", F.get("positions", F.lit(0))).collect()))
    assert first(mixing.SCHEDULES) != first(((1.0, 1.0, 1.0),) * 3)
