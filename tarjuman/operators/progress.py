"""Progress tables: write finished work in batches, resume from them.

A progress table is a folder of Parquet batches ``batch_id=N``. It may be keyed
by cell or by text; ``key`` names the columns. A batch is written once and never
rewritten with other content, so a run costs each row one write.
"""

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tarjuman.sources.scans import list_files, path_exists
from tarjuman.workspace import materialize


def batch_path(folder: str, batch_id: int) -> str:
    return f"{folder.rstrip('/')}/batch_id={batch_id}"


def write_batch(done: DataFrame, folder: str, batch_id: int) -> None:
    """Write one batch of finished work; repeating it replaces that batch only."""
    done.write.mode("overwrite").parquet(batch_path(folder, batch_id))


def batch_number(path: Column, prefix: str = "batch_id=") -> Column:
    """The number that follows ``prefix`` in a path, null when there is none."""
    digits = F.regexp_extract(path, rf"{prefix}(\d+)", 1)
    return F.when(digits != "", digits.cast("long"))


def latest_number(paths: DataFrame, prefix: str = "batch_id=") -> DataFrame:
    """Highest checkpoint number among ``paths``, compared as a number."""
    return paths.agg(F.max(batch_number(F.col("path"), prefix)).alias("latest"))


def latest_batch(spark: SparkSession, folder: str) -> int | None:
    """Highest finished batch; data files appear only once their job commits."""
    if not path_exists(spark, folder):
        return None
    return latest_number(list_files(spark, folder)).first()[0]


def read_progress(
    spark: SparkSession, folder: str, schema: StructType, upto: int | None = None
) -> DataFrame | None:
    """Finished work, up to batch ``upto`` when given; None when there is none."""
    if not path_exists(spark, folder):
        return None
    full = StructType([*schema.fields, StructField("batch_id", LongType())])
    done = spark.read.schema(full).parquet(folder)
    return done if upto is None else done.where(F.col("batch_id") <= upto)


def discard_after(folder: str, like: DataFrame, upto: int, latest: int) -> None:
    """Empty the batches after ``upto``, so that work goes on from that one."""
    for batch_id in range(upto + 1, latest + 1):
        nothing = like.limit(0).withColumn("round", F.lit(0))
        writer = nothing.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("round").parquet(batch_path(folder, batch_id))


def pending(work: DataFrame, done: DataFrame | None, key: list[str]) -> DataFrame:
    """Work not finished yet. Null keys equal each other."""
    if done is None:
        return work
    known = done.select(*[F.col(f"`{k}`").alias(f"_of_{k}") for k in key]).distinct()
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`")) for k in key]
    return work.join(known, same, "left_anti")


def restore(
    df: DataFrame, done: DataFrame, key: list[str], generated: list[str]
) -> DataFrame:
    """Fill the generated columns from finished work; originals are left alone.

    ``done`` holds a key once. Null keys equal each other.
    """
    saved = done.select(
        *[F.col(f"`{k}`").alias(f"_of_{k}") for k in key],
        *[F.col(f"`{c}`").alias(f"_saved_{c}") for c in generated],
    )
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`")) for k in key]
    joined = df.join(saved, same, "left").drop(*[f"_of_{k}" for k in key])
    values = {}
    for c in generated:
        stored = F.col(f"_saved_{c}")
        values[c] = F.coalesce(stored, F.col(f"`{c}`")) if c in df.columns else stored
    return joined.withColumns(values).drop(*[f"_saved_{c}" for c in generated])


class Settled:
    """Finished work by key, bucketed: one folder of files beside a progress folder.

    A run appends what it settled, so the history is written once and not rewritten. Rows
    are dealt to buckets by their key, and joins with them by that key deal out the other
    side only: looking up the texts of a run neither shuffles nor sorts the history.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, key: str = "text_key"):
        self.spark, self.key = spark, key
        self.schema = StructType([*schema.fields, StructField("batch_id", LongType())])
        self.base = f"{folder.rstrip('/')}_settled"
        self.name = f"tarjuman_{hashlib.md5(self.base.encode()).hexdigest()[:20]}"

    def _buckets(self) -> int | None:
        """The number of buckets that the files were dealt to."""
        if not path_exists(self.spark, self.base):
            return None
        found = list_files(self.spark, self.base).agg(F.max(batch_number(F.col("path"), "/buckets="))).first()[0]
        return found

    def table(self) -> DataFrame | None:
        """The history, None where there is none."""
        buckets = self._buckets()
        if buckets is None:
            return None
        if not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            place = re.sub(r"(['\\\\])", r"\\\1", f"{self.base}/buckets={buckets}")
            self.spark.sql(
                f"create table {self.name} ({columns}) using parquet clustered by (`{self.key}`) "
                f"sorted by (`{self.key}`) into {buckets} buckets location '{place}'")
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def latest(self) -> int | None:
        """The highest batch whose work is in the history."""
        known = self.table()
        return None if known is None else known.agg(F.max("batch_id")).first()[0]

    def add(self, settled: DataFrame) -> None:
        """Append the work of batches that are not in the history."""
        buckets = self._buckets() or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.table()
        ordered = settled.select([f.name for f in self.schema.fields]).repartition(buckets, self.key)
        (
            ordered.write.format("parquet").mode("append").bucketBy(buckets, self.key).sortBy(self.key)
            .option("path", f"{self.base}/buckets={buckets}").saveAsTable(self.name)
        )

    def rebuild(self, settled: DataFrame) -> None:
        """Replace the history, as later batches were dropped."""
        kept = materialize(settled, "settled")
        self.spark.sql(f"drop table if exists {self.name}")
        buckets = (self._buckets() or 0) + 1
        kept = kept.select([f.name for f in self.schema.fields]).repartition(buckets, self.key)
        (
            kept.write.format("parquet").mode("overwrite").bucketBy(buckets, self.key).sortBy(self.key)
            .option("path", f"{self.base}/buckets={buckets}").saveAsTable(self.name)
        )
