"""Column expressions against plain statements of their rules, on random Unicode."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tarjuman import fixed
from tarjuman.functions import quality, text

SPACES = [chr(c) for c in range(0x110000) if re.match(r"\s", chr(c))]
PIECES = [
    *SPACES, *[chr(c) for c in range(0, 0xa1)], "\n \n", "\n\n\n", "\r\n", "  ",
    "é", "ß", "İ", "ı", "ſ", "K", "́", "​", "﻿", "᠎", "😀", "𝔘", "中",
    "إ", "أ", "آ", "ا", "ة", "؀", "ۿ", "܀", "ݐ", "ݿ", "ހ",
    "ࢠ", "ࣿ", "ऀ", "ﭐ", "مرحبا", "Ã©", "Ã¨", "Ã ", "Ã ", "Ã§", "â€™",
    "â€œ", "â€�", "�", "Ã", "â€", "ChatGPT", "chatgpt", "CHAT GPT", "OpenAI's",
    "OpenAI", "OPENAI API", "ChatGPT API", "GPT-4", "gpt-3.5", "GPT-3", "GPT", "gpt", "-", "_",
    "word", "def", "class ", "import", "```", "http://", "https:/", "a@b.co", "x.y@z.a|b",
    "@", ".", "%", "#$%", "0", "Z",
]


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(7)
    drawn = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(6000)]
    return [*drawn, *PIECES, *[a + b for a in SPACES for b in ("x", "\n", " ")]]


@pytest.fixture(scope="module")
def table(spark, samples):
    df = spark.createDataFrame(list(enumerate(samples)), "i int, text string").repartition(4)
    return df.cache()


def plain_strip_control(s):
    keep = {9, 10, 13}
    return "".join(c for c in s if not (
        (ord(c) < 32 and ord(c) not in keep) or 127 <= ord(c) <= 159))


def plain_clean(s):
    s = re.sub("[ \t]+", " ", plain_strip_control(s))
    return re.sub(r"\n\s*\n", "\n\n", s).strip()


def plain_terms(s):
    for term, new in sorted(fixed.TERM_REPLACEMENTS.items(), key=lambda t: -len(t[0])):
        s = re.sub(rf"\b{re.escape(term)}\b", lambda _, new=new: new, s, flags=re.I)
    return s


def plain_script_ratio(s):
    script = sum(1 for c in s if "؀" <= c <= "ۿ" or "ݐ" <= c <= "ݿ"
                 or "ࢠ" <= c <= "ࣿ")
    return script / max(sum(1 for c in s if not re.match(r"\s", c)), 1)


def plain_mojibake(s):
    return any(t in s for t in ("Ã©", "Ã¨", "Ã ", "Ã§", "â€™", "â€œ", "�"))


def plain_postprocess(s):
    for form in "إأآ":
        s = s.replace(form, "ا")
    return re.sub(r"\s+", " ", s).strip()


def plain_code(s):
    return "```" in s or bool(re.search(r"\b(def|class|function|import|const|var|let)\b", s))


def plain_special(s):
    special = sum(1 for c in s if not (c.isascii() and c.isalnum()) and not re.match(r"\s", c))
    return special / max(len(s), 1)


RULES = {
    "strip_control": (text.strip_control, plain_strip_control),
    "collapse_blanks": (text.collapse_blanks, lambda s: re.sub("[ \t]+", " ", s)),
    "collapse_newlines": (text.collapse_newlines, lambda s: re.sub(r"\n\s*\n", "\n\n", s)),
    "trim": (text.trim_text, str.strip),
    "clean": (text.clean_text, plain_clean),
    "code": (text.contains_code, plain_code),
    "urls": (text.contains_urls, lambda s: bool(re.search("https?://", s))),
    "emails": (text.contains_emails, lambda s: bool(re.search(
        r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", s))),
    "special": (text.special_char_ratio, plain_special),
    "has_script": (quality.has_script, lambda s: plain_script_ratio(s) > 0),
    "script_ratio": (quality.script_ratio, plain_script_ratio),
    "mojibake": (quality.has_mojibake, plain_mojibake),
    "postprocess": (quality.postprocess, plain_postprocess),
    "terms": (text.normalize_terms, plain_terms),
}


@pytest.mark.parametrize("name", list(RULES))
def test_expression_follows_its_rule(table, samples, name):
    expression, rule = RULES[name]
    rows = table.select("i", expression(F.col("text")).alias("v")).collect()
    assert rows
    wrong = [(samples[r["i"]], r["v"], rule(samples[r["i"]])) for r in rows
             if r["v"] != rule(samples[r["i"]])]
    assert not wrong[:3]


def test_guard_does_not_change_terms(table):
    chain = F.col("text")
    for term, new in text.ordered_terms():
        pattern = f"(?iu){text.BOUNDARY}{re.escape(term)}{text.BOUNDARY}"
        chain = F.regexp_replace(chain, pattern, new)
    guarded = text.normalize_terms(F.col("text"))
    assert table.where(~guarded.eqNullSafe(chain)).count() == 0


def test_blanks_are_sought_in_what_the_script_leaves(spark):
    """The dear part of the script share sees the few other characters, not the text again."""
    texts = ["اب جد", "ab اب\t x", "  ", "", None, "اب؟ ۱ ݐࢠ", "Ã©　ا"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plan = df.select(quality.script_ratio(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace(regexp_replace(" in plan
    other = f"{fixed.ARABIC}A-Z"
    got = df.select(quality.script_ratio(F.col("t")), quality.script_ratio(F.col("t"), other)).collect()
    assert all(a == b for a, b in got)


def test_scripted_replies_are_transliterated_once_a_document(spark, tmp_path):
    from catalog import inputs

    spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = inputs.candidates(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(lower(") == 1


def test_single_spaces_and_alef_forms(spark):
    rng = random.Random(4)
    pieces = [*fixed.WHITESPACE_CHARS, " ", " ", " ", "ab", "ا", *map(chr, range(0x61e, 0x62a))]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", quality.normalize_arabic(F.col("t")).alias("v")).collect():
        folded = re.sub(f"[{fixed.ALEF_FORMS}]", fixed.ALEF, row["t"])
        assert row["v"] == re.sub(f"[{re.escape(fixed.WHITESPACE_CHARS)}]+", " ", folded).strip(" ")


def test_a_request_is_cleaned_once(spark):
    """The aggregate cleans, a step of its own looks for terms in what was cleaned."""
    from tarjuman.plans.translate import distinct_requests

    plan = distinct_requests(spark.createDataFrame([("a",)], "t string"), ["t"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(fixed.CONTROL) == 1
