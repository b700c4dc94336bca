"""Session settings this library is tuned for."""

from pyspark.sql import SparkSession

# Settings that matter at scale. Long texts make rows wide and uneven, so Arrow
# batches are bounded by bytes as well as rows, and adaptive execution may split
# a partition that turned out too large. Streams keep the keys they have seen on
# disk rather than in executor memory.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: str | int = "*", name: str = "tarjuman", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for setting, value in {**SETTINGS, **extra}.items():
        builder = builder.config(setting, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
