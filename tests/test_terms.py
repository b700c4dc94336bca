"""Many terms by one automaton against a pattern per term."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tarjuman.functions import text as T
from tarjuman.functions.term_search import TermSearch, fold, searched_terms
from tarjuman.operators import terms
from tarjuman.operators.providers import transliterator
from tarjuman.plans.translate import translate_table


def plain(text, ordered):
    """A Python pattern per term, one after the other."""
    for term, replacement in ordered:
        text = re.sub(rf"\b{re.escape(term)}\b", lambda m: replacement, text, flags=re.IGNORECASE)
    return text


PIECES = ["a", "ab", "b", "A", "aB", "API", "GPT", "-", ".", "'s", " ", "  ", "é", "É", "k", "K", "ſ", "s",
          "ß", "ı", "İ", "i", "1", "_", "#", "\U00010400", "\U00010428", "\n"]


def mapping(rng, n):
    found = {}
    while len(found) < n:
        term = "".join(rng.choices(PIECES, k=rng.randint(1, 5))).strip()
        if term:
            found[term] = "".join(rng.choices(PIECES, k=rng.randint(0, 6)))
    return found


@pytest.mark.parametrize("seed", range(3))
def test_automaton_equals_a_pattern_per_term(spark, seed):
    rng = random.Random(seed)
    ordered = T.ordered_terms(mapping(rng, 40))
    texts = [("".join(rng.choices([*PIECES, *(t for t, _ in ordered)], k=rng.randint(0, 25))),) for _ in range(600)]
    rows = spark.createDataFrame([*texts, (None,)], "t string").select(
        "t", T.chained_terms(F.col("t"), ordered).alias("chain"), searched_terms(F.col("t"), ordered).alias("search"))
    found = rows.collect()
    assert all(r["chain"] == r["search"] for r in found), [r for r in found if r["chain"] != r["search"]][:3]
    assert sum(r["t"] != r["search"] for r in found) > 300


def test_against_python_patterns():
    rng = random.Random(11)
    words = ["alpha", "beta", "Gamma", "delta-x", "x", "API", "v2.0", "it's"]
    ordered = sorted(((a + " " + b if rng.random() < 0.5 else a, rng.choice(words)) for a in words for b in words),
                     key=lambda item: -len(item[0]))
    search = TermSearch(ordered)
    for _ in range(2000):
        text = "".join(rng.choice([*words, *(w.upper() for w in words)]) + rng.choice([" ", ", ", "", "\n"]) for _ in range(8))
        assert search.replace(text) == plain(text, ordered)


def test_fold_keeps_the_length():
    for c in map(chr, range(0x20, 0x3000)):
        assert len(fold(c)) == 1


def test_no_terms_and_empty_terms():
    assert TermSearch([]).replace("as it is") == "as it is"
    assert T.ordered_terms({"": "x"}) == T.ordered_terms()


def test_a_merged_table_feeds_a_run(spark):
    """Ten thousand terms in a table, merged with the defaults, as the terms of a translation."""
    custom = spark.range(10_000).selectExpr(
        "concat('term', id) as term", "if(id = 77, 'ChatGPT', concat('word ', id)) as replacement", "id as `rank`")
    df = spark.createDataFrame([(1, "use TERM12 and term9999"), (2, "term77"), (3, "term10000 OpenAI")], "id long, t string")
    table = translate_table(df, ["t"], [transliterator("p")], ["id"], custom_terms=custom)
    want = {1: "use word 12 and word 9999", 2: "ChatGPT", 3: "term10000 the AI provider"}
    plain_table = translate_table(
        spark.createDataFrame(list(want.items()), "id long, t string"), ["t"], [transliterator("p")], ["id"], terms=False)
    assert {r["id"]: r["t_ar"] for r in table.collect()} == {r["id"]: r["t_ar"] for r in plain_table.collect()}
    merged = terms.merge_terms(terms.default_terms(spark), custom)
    assert len(terms.terms_as_mapping(merged)) == 10_013


def test_a_long_table_equals_the_mapping(spark, monkeypatch):
    """Terms that lead to others, repeated ones and odd cases; nothing is collected."""
    rng = random.Random(5)
    custom = mapping(rng, 60)
    chained = {f"{c}{i}": f"{c}{i + 1}" for c in "pq" for i in range(9, 12)}
    custom = {**custom, **chained, "big one": "p9 q9", "ChatGPT": "big one", "ͅ": "x", "ͅa": "b", "zι": "y"}
    ordered = T.ordered_terms(custom)
    texts = sorted({"".join(rng.choices([*PIECES, "ͅ", "z", *(t for t, _ in ordered)], k=rng.randint(0, 25))) for _ in range(500)})
    rows = [(t, r, i) for i, (t, r) in enumerate(custom.items())]
    rows += [(rows[3][0], rows[3][1], 900), ("", "nothing", 901), (None, "nothing", 902)]
    table = spark.createDataFrame(rows, "term string, replacement string, rank long")
    prompts = spark.createDataFrame(list(enumerate([*texts, None])), "k int, prompt string")
    monkeypatch.setattr(terms, "terms_as_mapping", None)
    assert terms.is_long(table) and not terms.is_long(table.limit(64)) and not terms.is_long(custom)
    got = {r["k"]: r["prompt"] for r in terms.replace_terms(prompts, "k", table).collect()}
    search = TermSearch(ordered)
    assert got == {i: search.replace(t) for i, t in enumerate(texts)} | {len(texts): None}


def test_a_run_does_not_collect_a_long_table(spark, monkeypatch):
    monkeypatch.setattr(terms, "terms_as_mapping", None)
    custom = spark.range(200).selectExpr("concat('term', id) as term", "nullif(concat('word ', id), 'word 7') as replacement", "id as `rank`")
    df = spark.createDataFrame([(1, "use TERM12"), (2, "term7"), (3, "plain")], "id long, t string")
    table = translate_table(df, ["t"], [transliterator("p")], ["id"], custom_terms=custom)
    assert {r["id"]: r["t_ar"] is None for r in table.collect()} == {1: False, 2: True, 3: False}
