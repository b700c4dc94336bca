"""What the operators of this subpackage share."""

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the size and quality contracts: runs without ASCII white space. The same
#: class is what ``bytes.split()`` uses.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else, so results do not depend on a locale."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null. Blanks that a word follows, plus a word at the start."""
    blanks = F.regexp_replace(text, WORD, "x")
    return F.coalesce(F.length(F.translate(blanks, " \t\n\x0b\f\r", "")), F.lit(0)).cast("long")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the texts a Python worker holds at once, by rows and by bytes.

    Both settings only say how rows are dealt to Python; no result depends on them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8MB")


@contextmanager
def batches_of(spark: SparkSession, rows: int, size: str):
    """Bound Arrow batches by rows and bytes for the actions inside; the caller's settings come back."""
    wanted = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": size,
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def text_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Columns that stand for a row: its id (null-safe) and a fingerprint of its text.

    Rows equal in both are copies of one document and share every result, so a table
    with one row per key may be joined back without changing the number of rows.
    """
    return [
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("_fp"),
        F.coalesce(F.length(text), F.lit(-1)).alias("_len"),
    ]


KEY = ["_id", "_fp", "_len"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
