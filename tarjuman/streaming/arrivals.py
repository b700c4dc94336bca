"""Incremental translation of files as they arrive."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tarjuman.operators.progress import batch_path
from tarjuman.operators.shape import free_name
from tarjuman.plans.translate import translate_part
from tarjuman.sources.scans import path_exists
from tarjuman.workspace import materialize


def arriving_files(
    spark: SparkSession, folder: str, schema: StructType,
    max_files: int | None = None, name_glob: str | None = None,
) -> DataFrame:
    """A stream over the Parquet files of ``folder``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.parquet(folder)


def translate_stream(
    stream: DataFrame, columns: Sequence[str], providers: Sequence, key: Sequence[str],
    output: str, checkpoint: str, unique: bool = False, keep: str | None = "7 days",
    memory: str | None = None, **options,
) -> StreamingQuery:
    """Translate what has arrived, each row and each text once, into ``output/batch_id=N``.

    Rows that arrive twice are dropped by key. Keys are kept in the state store for
    ``keep`` after their arrival, by a watermark on the arrival time, so the state holds
    the keys of that time and not of all time; a row that comes again later is taken for
    a new one. None keeps keys for ever; ``unique`` promises that no key comes twice.

    Texts are remembered below ``memory``, by default beside the stream's checkpoint: a
    text of an earlier micro-batch is not sent again, whatever became of it. A
    micro-batch replayed after a failure finds its folder complete and does nothing, or
    goes on behind its finished rounds and writes its folder whole, so the output holds
    every row exactly once.
    """
    fresh = stream
    if not unique and keep is None:
        fresh = stream.dropDuplicates(list(key))
    elif not unique:
        arrived = free_name(stream.columns, "arrived")
        timed = stream.withColumn(arrived, F.current_timestamp()).withWatermark(arrived, keep)
        fresh = timed.dropDuplicatesWithinWatermark(list(key)).drop(arrived)
    memory = memory or f"{checkpoint.rstrip('/')}/texts"
    return (
        fresh.writeStream.foreachBatch(_writer(columns, providers, key, output, unique, options, memory))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _writer(
    columns, providers, key, output: str, unique: bool, options: dict, memory: str | None = None,
) -> Callable:
    memory = memory or f"{output.rstrip('/')}_texts"

    def write(batch: DataFrame, batch_id: int) -> None:
        target = batch_path(output, batch_id)
        if path_exists(batch.sparkSession, f"{target}/_SUCCESS"):
            return
        # Each use of the batch would run the stream's stateful part again.
        arrived = batch if unique else materialize(batch, "arrived")
        if arrived.isEmpty():
            return  # nothing new, or a batch that only lets old keys go
        translated = translate_part(arrived, columns, providers, key, memory, batch_id, **options)
        translated.write.mode("overwrite").parquet(target)

    return write
