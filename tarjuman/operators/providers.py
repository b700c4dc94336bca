"""Translation providers: how a table of prompts gets its replies.

A provider adds ``success``, ``translation`` and ``error`` to a table holding
``prompt``. Only :class:`CallProvider` runs Python code, in Arrow batches; see ``calls``.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarjuman.operators.calls import REPLY_FIELDS, CallProvider
from tarjuman.operators.skew import hot_keys, salted_join

__all__ = [
    "REPLY_FIELDS", "CallProvider", "ColumnProvider", "MemoryProvider", "transliterated",
    "transliterating_client", "transliterating_lists", "transliterator",
]


@dataclass(frozen=True)
class ColumnProvider:
    """A reply that is an expression of the prompt and the attempt number.

    ``error`` gives a reason where the call fails, null where it succeeds.
    """

    name: str
    reply: Callable[[Column, int], Column]
    error: Callable[[Column, int], Column] | None = None
    remote: bool = False

    def answer(self, prompts: DataFrame, attempt: int = 1) -> DataFrame:
        prompt = F.col("prompt")
        failure = self.error(prompt, attempt) if self.error else F.lit(None).cast("string")
        called = prompts.withColumn("error", failure)
        success = F.col("error").isNull()
        return called.withColumns({
            "success": success,
            "translation": F.when(success, self.reply(prompt, attempt)),
        }).select(*prompts.columns, "success", "translation", "error")


@dataclass(frozen=True)
class MemoryProvider:
    """Replies looked up in a translation memory ``(text, translation)``.

    The memory may be of any size: Spark broadcasts it only when its statistics
    say it is small. Prompts are matched as whole texts, through their digest;
    the other columns of the prompts tell copies of a prompt apart.
    """

    name: str
    memory: DataFrame
    remote: bool = False

    def answer(self, prompts: DataFrame, attempt: int = 1) -> DataFrame:
        known = self.memory.groupBy(F.sha2("text", 256).alias("_digest")).agg(
            F.min("translation").alias("_known")
        )
        others = [c for c in prompts.columns if c != "prompt"] or ["prompt"]
        # A null prompt matches nothing; a key of its own keeps nulls off one task.
        alone = F.concat(F.lit("null:"), F.xxhash64(*others).cast("string"))
        asked = prompts.withColumn("_digest", F.coalesce(F.sha2("prompt", 256), alone))
        sizes = asked.groupBy("_digest").agg(F.count(F.lit(1)).alias("_size"))
        hot = hot_keys(sizes, "_digest", "_size")
        found = salted_join(asked, known, "_digest", others, hot)
        hit = F.col("_known").isNotNull()
        return found.select(
            *prompts.columns,
            hit.alias("success"),
            F.col("_known").alias("translation"),
            F.when(~hit, F.lit("not in memory")).alias("error"),
        )


# The letters of the deterministic stand-in provider.
LATIN = "abcdefghijklmnopqrstuvwxyz"
LETTERS = "ابتثجحخدذرزسشصضطظعغفقكلمنه"


def transliterated(text: Column) -> Column:
    """A reproducible stand-in for a translation: Latin letters become Arabic ones."""
    return F.translate(F.lower(text), LATIN, LETTERS)


def transliterator(name: str) -> ColumnProvider:
    return ColumnProvider(name, lambda prompt, attempt: transliterated(prompt))


def transliterating_client() -> Callable[[str], str]:
    """The same stand-in as a Python client."""
    table = str.maketrans(LATIN, LETTERS)
    return lambda text: text.lower().translate(table)


def transliterating_lists() -> Callable[[list[str]], list[str]]:
    """The same stand-in as a client that takes lists."""
    one = transliterating_client()
    return lambda texts: [one(text) for text in texts]
