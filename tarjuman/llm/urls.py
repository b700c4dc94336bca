"""URL filter: rules first, then logistic regression on hashed character n-grams.

Only DataFrame operations and Spark ML. The labelled table is small by contract: at
most ``MOST_LABELLED`` URLs, chosen by the hash of host and path.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no
rule, and is judged by the model like any other; without a labelled URL of both kinds
the model knows only one verdict, or allows everything; repeated rows are judged alike;
an empty table gives an empty result; other columns are carried along.
"""

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarjuman.llm.common import ascii_lower

#: What the model learns by default: (host, path, block), a small table of its own, so that a
#: URL's verdict does not depend on the other pages.
LABELLED = (
    ("en.example.org", "/wiki/history", 0), ("library.example.edu", "/catalogue/12.html", 0),
    ("docs.example.net", "/en/guide/7", 0), ("www.example.com", "/fr/article/31", 0),
    ("blog.example.net", "/en/2024/notes", 0), ("news.example.org", "/en/story/88", 0),
    ("science.example.edu", "/papers/5", 0), ("www.example.net", "/en/recipes/3.html", 0),
    ("example.com", "/fr/histoire/9", 0), ("forum.example.net", "/fr/question/45", 0),
    ("archive.example.org", "/fr/livre/2", 0), ("www.example.edu", "/lectures/1", 0),
    ("ads.example.com", "/click/9981", 1), ("track.example.net", "/pixel.gif", 1),
    ("casino.example.com", "/bonus/777", 1), ("www.example.com", "/de/gewinnspiel/5", 1),
    ("shop.example.com", "/de/angebot/12", 1), ("login.example.net", "/signin/reset", 1),
    ("cdn.example.com", "/banner/300x250.js", 1), ("popup.example.net", "/win/free/1", 1),
    ("example.com", "/de/kredit/4", 1), ("cheap-pills.example.com", "/order/2", 1),
    ("dating.example.net", "/join/now", 1), ("download.example.com", "/crack/setup.exe", 1),
)

#: (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
GRAMS = (2, 3, 4)
DIMENSIONS = 1 << 14
MOST_LABELLED = 4_000


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The fitting rule as ``struct(rule, verdict)``: longest host and path, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[0]))
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        pair = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, pair).otherwise(chosen)
    return chosen


def char_grams(host: Column, path: Column, orders=GRAMS) -> Column:
    """Character n-grams of host and path, each told apart by a mark in front."""
    def grams(marked: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.substring(marked, 1, 1), marked.substr(i, F.lit(n))))

    host, path = F.concat(F.lit("h"), host, F.lit(".")), F.concat(F.lit("p"), path, F.lit("/"))
    return F.concat(*[grams(part, n) for part in (host, path) for n in orders])


def judge(pages: DataFrame, url: str = "url", rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` (that it is blocked) and ``verdict``.

    ``labelled`` (host, path, block as 0.0 or 1.0) is what the model learns, by default
    the table ``LABELLED``.
    """
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "score", "verdict")]
    # The caller's columns travel in one, so that their names are free.
    row = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias("none"))
    own = F.col(f"`{url}`")
    parsed = pages.select(row.alias("_row"), host_of(own).alias("host"), path_of(own).alias("path"))
    ruled = parsed.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = pages.sparkSession.createDataFrame(
            [(h, p, float(b)) for h, p, b in LABELLED], "host string, path string, block double")
    few = labelled.orderBy(F.xxhash64("host", "path"), "host", "path").limit(MOST_LABELLED)
    hashing = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=DIMENSIONS)
    train = hashing.transform(few.withColumn("_grams", char_grams(F.col("host"), F.col("path")))).coalesce(4)
    kinds = {row[0] for row in few.select("block").distinct().collect()}
    if len(kinds) == 2:
        model = LogisticRegression(
            featuresCol="_features", labelCol="block", probabilityCol="_chance",
            rawPredictionCol="_raw", predictionCol="_guess", maxIter=30, regParam=0.01,
        ).fit(train)
        marked = hashing.transform(ruled.withColumn("_grams", char_grams(F.col("host"), F.col("path"))))
        scored = model.transform(marked).withColumn("score", vector_to_array("_chance")[1])
    else:
        scored = ruled.withColumn("score", F.lit(max(kinds, default=0.0)))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        *[F.col("_row").getField(c).alias(c) for c in names], "host", "path", F.col("_rule.rule").alias("rule"),
        "score", F.coalesce(F.col("_rule.verdict"), own).alias("verdict"),
    )
