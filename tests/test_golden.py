"""Known inputs with their expected outputs."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarjuman import fixed
from tarjuman.functions import quality, text
from tarjuman.operators import shape, terms


def values(spark, inputs, function):
    rows = [(i, value) for i, value in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, text string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("text"))).collect()]


TERMS = [
    ("Our shop moved its support desk to ChatGPT last spring.",
     "Our shop moved its support desk to the AI assistant last spring."),
    ("A review of OpenAI's GPT-3 against GPT-4, page 12",
     "A review of the AI provider's the language model against the advanced language model, page 12"),
    ("The OpenAI API and the chatgpt API differ; openai says so.",
     "The the AI API and the the AI API differ; the AI provider says so."),
    ("GPT-4o GPT-4-turbo Chat GPT-4 chatgpt api GPT-3.5-turbo MyChatGPT",
     "GPT-4o the advanced language model-turbo the AI assistant-4 the AI API "
     "the language model-turbo MyChatGPT"),
    ("nothing of the kind", "nothing of the kind"),
    ("ask OpenAı now", "ask the AI provider now"),
]


def test_terms(spark):
    found = values(spark, [given for given, _ in TERMS], text.normalize_terms)
    assert found == [expected for _, expected in TERMS]


def test_custom_terms_override_append_and_are_literal(spark):
    custom = {"ChatGPT": "$1 \\x", "a.b": "dot", "GPT": "G", "C++": "cpp", "-[s]": "t", "éa": "e"}
    inputs = [
        "chatgpt and a.b, axb", "GPT-4 GPT", "ChatGPT API", "c++x c++ xc++y", "x-[ſ]y -[S]", "ÉA éab",
    ]
    found = values(spark, inputs, lambda c: text.normalize_terms(c, custom))
    assert found == [
        "$1 \\x and dot, axb", "the advanced language model G", "the AI API",
        "cppx c++ xc++y", "xty -[S]", "e éab",
    ]


def test_term_order_and_table_merge(spark):
    ordered = text.ordered_terms({"Zebra API": "z", "openai": "o"})
    assert [t for t, _ in ordered[:4]] == ["ChatGPT API", "OpenAI API", "Zebra API", "Chat GPT"]
    custom = spark.createDataFrame(
        [("Zebra API", "z", 0), ("openai", "o", 1)], "term string, replacement string, rank long"
    )
    merged = terms.merge_terms(terms.default_terms(spark), custom)
    assert terms.terms_as_mapping(merged) == {
        **fixed.TERM_REPLACEMENTS, "openai": "o", "Zebra API": "z",
    }
    assert list(terms.terms_as_mapping(merged))[-1] == "Zebra API"


PAIRS = [
    ("The bakery opens at seven", "يفتح المخبز في السابعة", "11111", True),
    ("Rain again", "مطر مرة أخرى", "11111", True),
    ("Tea", "شاي أخضر ساخن مع النعناع والسكر", "11101", False),
    ("Two tickets", "", "00001", False),
    ("Two tickets", "deux billets", "10011", False),
    ("", "مرحبا", "11111", True),
    ("abc", "مرحبÃ©", "11110", False),
]


def test_validation_pairs(spark):
    df = spark.createDataFrame(
        [(i, o, t) for i, (o, t, _, _) in enumerate(PAIRS)], "i int, o string, t string"
    )
    checks = quality.quality_checks(F.length("o"), F.col("t"))
    rows = df.withColumns(checks).withColumn(
        "valid", quality.is_valid({c: F.col(c) for c in checks})
    ).orderBy("i").collect()
    for row, (_, _, flags, valid) in zip(rows, PAIRS):
        assert "".join(str(int(row[c])) for c in quality.CHECKS) == flags
        assert row["valid"] == valid


def test_null_reply_is_not_valid(spark):
    df = spark.createDataFrame([("a", None)], "o string, t string")
    verdict = quality.is_valid(quality.quality_checks(F.length("o"), F.col("t")))
    assert df.select(verdict).first()[0] is False


@pytest.mark.parametrize("given, expected", [
    ("إلى  أهل\nآل ", "الى اهل ال"), ("مدرسة", "مدرسة"), (None, ""), ("  x ", "x"),
])
def test_postprocess(spark, given, expected):
    assert values(spark, [given], quality.postprocess) == [expected]


def test_issues_come_in_order(spark):
    inputs = ["def f(): http://x a@b.co #$%#$%#$%#$%#$%#$%#$%#$%#$%", "plain words", "Class"]
    assert values(spark, inputs, text.content_issues) == [
        ["contains_code", "contains_urls", "contains_emails", "high_special_char_ratio"], [], [],
    ]


def test_text_columns(spark):
    rows = [
        (1, "Where is the nearest pharmacy?", "travel"),
        (2, "Slice the onions very thinly", "cooking"),
        (3, "The match ended in a draw", "sport"),
    ]
    df = spark.createDataFrame(rows, "id long, prompt string, category string")
    found = {r["column"]: r for r in shape.detect_text_columns(df).collect()}
    assert found["prompt"]["is_text"] and not found["category"]["is_text"]
    assert found["prompt"]["avg_len"] == pytest.approx((30 + 28 + 25) / 3)
    assert found["category"]["avg_len"] == pytest.approx((6 + 7 + 5) / 3)
    assert shape.text_columns(df) == ["prompt"]
    nested = df.select(F.array("prompt").alias("prompts"))
    assert shape.text_columns(nested) == []


def test_keep_columns_order_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "id int, x string, x_api string, x_ar string")
    kept = shape.keep_columns(df, ["x_ar", "id", "absent"], ["x", "y"])
    assert kept.columns == ["x_ar", "id", "x_api"]


def test_limit_takes_exactly_n_rows(spark):
    rows = [(k, v) for k in (1, 2, 2, 2, 3, None) for v in ("b", "a", "a", None)]
    df = spark.createDataFrame(rows, "k int, v string").repartition(3)
    order = sorted((-1 if k is None else k) for k, _ in rows)
    for n in (0, 1, 3, 4, 7, 9, 11, 12, 23, 24, 25):
        got = shape.limit_rows(df, "k", n).collect()
        assert sorted(-1 if r["k"] is None else r["k"] for r in got) == order[:n]
        assert not Counter(map(tuple, got)) - Counter(rows)
    same = spark.range(1000).select(F.lit(1).alias("k"), F.lit("v").alias("v"))
    assert shape.limit_rows(same, ["k"], 370).count() == 370
    assert [tuple(r) for r in shape.limit_rows(df.where("k = 3"), ["k", "v"], 2).sort("v").collect()] == [(3, None), (3, "a")]


