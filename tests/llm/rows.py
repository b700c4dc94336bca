"""Small tables with the awkward cases every operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, `class` string, label int"


def words(n: int, seed: int = 0) -> str:
    """n words, different for every seed."""
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 1000003:x}" for i in range(n))


def awkward(spark):
    """Nulls in every column, empty, blank, short and very long texts, ties and repeated rows."""
    long = words(40_000, 3)
    rows = [
        (1, "The cat and the dog are in the house of the king.", "en", "a"),
        (2, "Der Hund und die Katze sind in dem Haus der Frau.", "de", "b"),
        (2, "Der Hund und die Katze sind in dem Haus der Frau.", "de", "b"),
        (3, None, "en", "a"), (4, "", "de", None), (5, " \n\t ", None, None), (6, "12 34 !!", "en", "a"),
        (7, long, "en", "a"), (8, long, "en", "a"), (None, "no id at all here", "en", "c"),
        (None, None, None, None), (9, "one\ntwo\nthree\nfour", "en", "c"), (9, "other text of the same id", "en", "c"),
    ]
    return spark.createDataFrame([r + (None, None, "x", "y", None) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same_columns(before, after, added):
    kept = [c for c in before.columns if c not in added]
    assert after.columns[:len(kept)] == kept
    assert set(after.columns) == set(kept) | set(added)
