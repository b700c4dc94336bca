"""Shared folder for tables a run has to write between steps."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, reachable from every executor.

    Only a local master may go without the setting: it gets a temporary folder,
    removed when the process ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    application = context.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="tarjuman-")
        atexit.register(shutil.rmtree, _LOCAL_FOLDERS[application], ignore_errors=True)
    return _LOCAL_FOLDERS[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so later steps neither recompute it nor
    see another run of a non-deterministic part of it."""
    folder = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
