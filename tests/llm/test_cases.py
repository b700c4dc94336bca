"""Components against a plain search, and the pipeline's stages on awkward and on no rows."""

import random

import pytest

import corpus_pipeline
from tarjuman.llm.components import components
from tests.llm.rows import awkward, empty

SF = "/root/testdata/sf0.001"


def plain(links):
    label = {}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            label.setdefault(a, a), label.setdefault(b, b)
            low, high = sorted((top(a), top(b)))
            label[high] = low
    return {x: top(x) for x in label}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(None, 2), (3, None)], [(5, 4), (4, 5), (4, 5)], [(0, i) for i in range(1, 300)],
    [(i, i + 1) for i in range(120)], [(random.Random(i).randrange(90), random.Random(-i - 1).randrange(90)) for i in range(70)],
], ids=["none", "itself", "nulls", "repeated", "star", "chain", "random"])
def test_components(spark, links):
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in found} == plain(links) and len(found) == len(plain(links))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_no_rows(spark, name, stage):
    rows = awkward(spark)
    found = stage(spark, rows, SF)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert found.columns == rows.columns
    ids = {r["doc_id"] for r in found.collect()}
    assert ids <= {r["doc_id"] for r in rows.collect()}
    if name == "language":
        assert ids <= {1, 2, 7, 8, 9, None}
    if name == "near_duplicates":
        assert 7 in ids and 8 not in ids and {3, 4, 5} <= ids
    if name == "tokens":
        assert found.count() == rows.count()
    assert stage(spark, empty(spark), SF).count() == 0
