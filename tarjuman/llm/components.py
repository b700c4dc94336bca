"""Connected components of a link table, by minimum labels with pointer jumping.

Defined cases: links of a node with itself and links with a null end are left out; repeated
links, and links in both directions, count once; an empty table gives no labels; a node with
very many links is one row per link, of which only minima are shuffled.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarjuman.workspace import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)``: the smallest node reachable over ``links``, for nodes with a link.

    A round takes the smallest label among a node and its neighbours, then that label's
    own label. Every round is written, and the rounds grow with the logarithm of the
    longest chain in practice. Nodes with very many links only meet partial minima.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"))
    labels = materialize(labels, "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "label", F.least("label", "near").alias("new")
        )
        least = materialize(least, "labels")
        above = least.select(F.col("node").alias("new"), F.col("new").alias("above"))
        jumped = materialize(least.join(above, "new").select("node", "label", F.least("new", "above").alias("new")), "labels")
        changed = not jumped.where("label <> new").limit(1).isEmpty()
        labels = jumped.select("node", F.col("new").alias("label"))
        if not changed:
            return labels
