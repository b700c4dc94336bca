"""A table in, the table with translations out."""

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tarjuman import fixed
from tarjuman.functions.text import clean_text, normalize_terms
from tarjuman.operators import progress
from tarjuman.operators.rounds import ATTEMPTS, outcomes, run_rounds
from tarjuman.operators.shape import (
    cell_text, pivot_cells, row_hash, translated_names, unpivot_cells,
)
from tarjuman.operators.skew import hot_keys, salted_join
from tarjuman.operators.terms import as_mapping, is_long, replace_terms
from tarjuman.workspace import materialize, new_folder

CELL_COLUMNS = {"column", "text", "text_key", "translation", "api"}


@dataclass(frozen=True)
class Translation:
    """What a run produced.

    ``table`` is the translated table, ``requests`` the distinct texts of the
    table, ``finished`` the outcome per text, by this run or an earlier one, and
    ``attempts`` every provider call of this run.
    """

    table: DataFrame
    requests: DataFrame
    finished: DataFrame
    attempts: DataFrame


def text_key(text: Column) -> Column:
    """Identity of a text across runs and tables."""
    return F.sha2(text, 256)


def distinct_requests(
    df: DataFrame, columns: Sequence[str], null_policy: str = "skip",
    terms: bool = True, custom_terms: Mapping[str, str] | None = None,
) -> DataFrame:
    """Each text once, however many cells hold it, with what a provider is sent.

    Grouping by the text itself keeps this a hash aggregate that shrinks copies
    before the shuffle; cleaning then runs once per distinct text.
    """
    texts = [cell_text(F.col(f"`{c}`"), null_policy) for c in columns]
    cells = df.select((texts[0] if len(texts) == 1 else F.explode(F.array(*texts))).alias("text"))
    counted = cells.where(F.col("text").isNotNull()).groupBy("text").agg(
        F.count(F.lit(1)).alias("n_cells")
    )
    cleaned = counted.select(
        text_key(F.col("text")).alias("text_key"),
        clean_text(F.col("text")).alias("prompt"),
        F.length("text").alias("original_length"),
        "n_cells",
    )
    if not terms:
        return cleaned
    # A step of its own: within the aggregate the cleaning would run again for each use.
    prompt = normalize_terms(F.col("prompt"), custom_terms)
    return cleaned.select("text_key", prompt.alias("prompt"), "original_length", "n_cells")


def _written_requests(
    df: DataFrame, columns: Sequence[str], null_policy: str, terms: bool,
    custom_terms: Mapping[str, str] | DataFrame | None,
) -> DataFrame:
    """The table of distinct requests, with terms from a mapping or a table of any size."""
    if not (terms and is_long(custom_terms)):
        found = distinct_requests(df, columns, null_policy, terms, as_mapping(custom_terms) if terms else None)
        return materialize(found, "requests")
    cleaned = materialize(distinct_requests(df, columns, null_policy, terms=False), "requests")
    return replace_terms(cleaned, "text_key", custom_terms)


def translate(
    df: DataFrame,
    columns: Sequence[str],
    providers: Sequence,
    key: Sequence[str],
    *,
    null_policy: str = "skip",
    terms: bool = True,
    custom_terms: Mapping[str, str] | DataFrame | None = None,
    max_retries: int = fixed.MAX_RETRIES,
    backoff: float = fixed.BACKOFF_MULTIPLIER,
    script: str = fixed.ARABIC,
    suffix: str = "ar",
    preserve: bool = True,
    progress_folder: str | None = None,
    resume: bool = False,
    upto: int | None = None,
    batches: int = 1,
    batch_rows: int | None = None,
) -> Translation:
    """Translate ``columns`` of ``df``.

    ``key`` names rows in lists of failures and in narrow results. It may be null or
    repeated: translations find their cells by the texts, not by the key.
    Distinct texts go to the providers in rounds, in ``batches`` (or batches of
    about ``batch_rows`` texts); finished rounds are kept in ``progress_folder``.
    With ``resume`` the texts finished there are not sent again; ``upto`` names the
    batch to go on from and drops later ones. ``custom_terms`` override and extend the
    provider terms: a mapping, or a table ``(term, replacement, rank)``. Only the provider calls run here; the
    returned table is lazy.
    """
    spark = df.sparkSession
    df, columns, key = checked_columns(df, columns, key, suffix)
    requests = _written_requests(df, columns, null_policy, terms, custom_terms)

    lasting = progress_folder or new_folder(spark, "progress")
    latest = progress.latest_batch(spark, lasting)
    if not resume and latest is not None:
        raise ValueError(f"{lasting} holds finished work; resume from it or name another folder")
    history = progress.Settled(spark, lasting, SETTLED) if progress_folder else None
    if upto is not None and latest is not None:
        progress.discard_after(lasting, _attempts(spark, lasting), upto, latest)
        latest = min(latest, upto)
        history.rebuild(_settled(_attempts(spark, lasting)))
    first = 0 if latest is None else latest + 1

    todo = requests
    if latest is not None:
        # A run that was stopped left batches that the history does not have.
        known = history.latest()
        left = _attempts(spark, lasting).where(F.col("batch_id") > (-1 if known is None else known))
        history.add(_settled(left))
        todo = requests.join(history.table().select("text_key"), "text_key", "left_anti")
    if batch_rows:
        batches = max(1, math.ceil(todo.count() / batch_rows))
    for number, batch in enumerate(_split(todo, requests, batches), start=first):
        folder = progress.batch_path(lasting, number)
        run_rounds(batch, providers, folder, max_retries, backoff, script)
    attempts = _attempts(spark, lasting).where(F.col("batch_id") >= first)
    finished = outcomes(attempts)
    if history:
        history.add(_settled(attempts))
        # What earlier runs settled, for the texts of this one.
        mine = history.table().join(requests.select("text_key"), "text_key", "left_semi")
        finished = materialize(mine.drop("batch_id"), "finished")
    table = join_outcomes(df, columns, key, finished, requests, null_policy, suffix, preserve)
    return Translation(table, requests, finished, attempts)


def _settled(attempts: DataFrame) -> DataFrame:
    """Outcomes with the batch that settled them."""
    return outcomes(attempts, "batch_id")


SETTLED = StructType([StructField(c, StringType()) for c in ("text_key", "translation", "api", "error")])


def checked_columns(
    df: DataFrame, columns: Sequence[str], key: Sequence[str], suffix: str
) -> tuple[DataFrame, list[str], list[str]]:
    """The table without columns of an earlier run, and the columns and key each once."""
    columns, key = list(dict.fromkeys(columns)), list(dict.fromkeys(key))
    missing = [c for c in [*key, *columns] if c not in df.columns]
    if missing or not columns or not key:
        raise ValueError(f"Columns and key must be in the table; missing: {missing}")
    if set(key) & CELL_COLUMNS:
        raise ValueError(f"Key columns may not be called any of {sorted(CELL_COLUMNS)}")
    return df.drop(*(set(translated_names(columns, suffix)) - {*key, *columns})), columns, key


def translate_part(
    df: DataFrame, columns: Sequence[str], providers: Sequence, key: Sequence[str],
    memory: str, number: int, *, null_policy: str = "skip", terms: bool = True,
    custom_terms: Mapping[str, str] | DataFrame | None = None, max_retries: int = fixed.MAX_RETRIES,
    backoff: float = fixed.BACKOFF_MULTIPLIER, script: str = fixed.ARABIC, suffix: str = "ar",
    preserve: bool = True,
) -> DataFrame:
    """Translate part ``number`` of a table that comes in parts.

    ``memory`` is the progress folder of all parts: a text that an earlier part settled
    is not sent again. Only outcomes of this part's texts are taken from it, by a
    semi-join, which reads the memory once. A part that is done again, as its run was
    stopped, goes on behind the rounds it had finished.
    """
    spark = df.sparkSession
    df, columns, key = checked_columns(df, columns, key, suffix)
    requests = _written_requests(df, columns, null_policy, terms, custom_terms)
    keys = requests.select("text_key")
    if progress.latest_batch(spark, memory) is None:
        known = outcomes(spark.createDataFrame([], ATTEMPTS))
    else:
        earlier = _attempts(spark, memory).where(F.col("batch_id") != number)
        known = materialize(outcomes(earlier).join(keys, "text_key", "left_semi"), "known")
    folder = progress.batch_path(memory, number)
    run_rounds(progress.pending(requests, known, ["text_key"]), providers, folder, max_retries, backoff, script, True)
    own = outcomes(_attempts(spark, memory).where(F.col("batch_id") == number))
    return join_outcomes(df, columns, key, known.unionByName(own), requests, null_policy, suffix, preserve)


def _attempts(spark: SparkSession, folder: str) -> DataFrame:
    """All attempts below a progress folder, from ``batch_id=N/round=N``."""
    places = [StructField("batch_id", LongType()), StructField("round", IntegerType())]
    schema = StructType([*ATTEMPTS.fields, *places])
    return spark.read.schema(schema).parquet(folder)


def _split(todo: DataFrame, requests: DataFrame, batches: int) -> list[DataFrame]:
    """``todo`` in parts of even size, each readable without scanning the others."""
    if batches == 1:
        return [todo]
    spark = todo.sparkSession
    folder = new_folder(spark, "batches")
    dealt = todo.withColumn("part", F.pmod(F.xxhash64("text_key"), F.lit(batches)).cast("int"))
    # Pieces keep every core busy, while a task writes to few parts.
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = max(shuffle, requests.rdd.getNumPartitions())
    piece = F.pmod(F.hash("text_key"), F.lit(math.ceil(width / batches)))
    dealt.repartition(width, "part", piece).write.partitionBy("part").parquet(folder)
    parts = spark.read.schema(dealt.schema).parquet(folder)
    return [parts.where(F.col("part") == i).drop("part") for i in range(batches)]


def join_outcomes(
    df: DataFrame, columns: Sequence[str], key: Sequence[str], finished: DataFrame,
    requests: DataFrame, null_policy: str = "skip", suffix: str = "ar", preserve: bool = True,
) -> DataFrame:
    """Put translations beside their cells.

    One column is joined directly by the digest of its text. Several are joined by the
    digest of all their texts: rows that agree in them share their translations, so
    each combination is looked up once, and the wide rows are shuffled once only.
    """
    columns = list(columns)
    hot = hot_keys(requests, "text_key", "n_cells")
    good = finished.where(F.col("translation").isNotNull()).select("text_key", "translation", "api")
    kept = df.columns if preserve else list(key)
    base = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, *columns])])
    digests = [text_key(cell_text(F.col(f"`{c}`"), null_policy)) for c in columns]
    # Rows without a text match nothing; keys of their own keep them off one task.
    keyed = base.withColumn("_row_hash", row_hash(base))
    alone = F.concat(F.lit("null:"), F.col("_row_hash").cast("string"))
    names = translated_names(columns, suffix)
    if len(columns) == 1:
        replies = good.toDF("_row_key", *names)
        keyed = keyed.withColumn("_row_key", F.coalesce(digests[0], alone))
    else:
        some = F.coalesce(*digests).isNotNull()
        whole = F.sha2(F.concat_ws(",", *[F.coalesce(d, F.lit("-")) for d in digests]), 256)
        keyed = keyed.withColumn("_row_key", F.when(some, whole).otherwise(alone))
        parts = [d.alias(f"d{i}") for i, d in enumerate(digests)]
        kinds = df.where(some).select(whole.alias("_row_key"), *parts)
        kinds = kinds.groupBy("_row_key", *[f"d{i}" for i in range(len(columns))]).agg(
            F.count(F.lit(1)).alias("n_rows"))
        kinds = materialize(kinds, "row-kinds")
        cells = F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("text_key")) for i, c in enumerate(columns)
        ])
        cells = kinds.select("_row_key", F.inline(cells)).where(F.col("text_key").isNotNull())
        translated = salted_join(cells, good, "text_key", ["_row_key", "column"], hot, "inner")
        replies = pivot_cells(translated, ["_row_key"], columns, suffix)
        hot = hot_keys(kinds, "_row_key", "n_rows")
    joined = salted_join(keyed, replies, "_row_key", ["_row_hash"], hot)
    return joined.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, *names])])


def failed_cells(
    df: DataFrame, columns: Sequence[str], key: Sequence[str], run: Translation,
    null_policy: str = "skip",
) -> DataFrame:
    """``(*key, column, error)`` per cell whose text got no translation."""
    lost = run.finished.where(F.col("api").isNull()).select("text_key", "error")
    cells = unpivot_cells(df, list(key), list(columns), null_policy).where(
        F.col("text").isNotNull()
    )
    keyed = cells.select(*key, "column", text_key(F.col("text")).alias("text_key"))
    hot = hot_keys(run.requests, "text_key", "n_cells")
    return salted_join(keyed, lost, "text_key", [*key, "column"], hot, "inner").drop("text_key")


def translate_table(
    df: DataFrame, columns: Sequence[str], providers: Sequence, key: Sequence[str], **options
) -> DataFrame:
    """The table of :func:`translate` alone."""
    return translate(df, columns, providers, key, **options).table
