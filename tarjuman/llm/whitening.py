"""Embedding whitening on integer entries, components by QDWH divide and conquer.

An entry ``c`` becomes ``floor(SCALE * c)``. Mean and covariance are taken over each
distinct vector once, so copies do not bend them: the distinct vectors are written, sums
are exact, and every task adds centred products of its rows to one matrix. Only matrices
of dimension by dimension, and sums per dimension, reach the driver; there ``qdwh`` finds
the components, whose first ones go to all tasks. The dimension is the size bound of what
is broadcast and collected.

Defined cases: rows with a null vector, or one with a null or non-finite entry, are
dropped; entries beyond a long take its ends, deviations beyond 38 digits are null; vectors shorter than the longest are filled
up with zeros, an empty one with zeros alone; repeated rows all return; components whose
variance is nothing but rounding are not returned, so one distinct vector or an empty
table give none; other columns are carried along and keep their names.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarjuman.llm.qdwh import eigenvectors
from tarjuman.operators.shape import free_name
from tarjuman.workspace import materialize

SCALE = 256
LOTS = 32
_SAFE = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """What is fitted: count and exact sums of the distinct vectors, components as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = float("nan")

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """``n * x - sums``, as longs if they all fit, else as Python's integers."""
        most = max((abs(int(m)) for m in (rows.min(initial=0), rows.max(initial=0))), default=0)
        fits = self.n * most + max(map(abs, self.sums), default=0) < _SAFE
        kind = np.int64 if fits else object
        return rows.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ (self.vectors / np.sqrt(self.values))


def is_whole(vector: Column) -> Column:
    """Whether the vector and all its entries are there and finite."""
    finite = lambda c: c.isNotNull() & (F.abs(c) < float("inf"))  # noqa: E731, NaN is above all
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def quantised(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c * SCALE).cast("long"))


def _stacked(vectors, size: int) -> np.ndarray:
    rows = np.zeros((len(vectors), size), np.int64)
    for i, vector in enumerate(vectors):
        rows[i, :len(vector)] = vector
    return rows


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct vector of ``(x)`` once; those that differ in zeros at the end are one."""
    filled = F.expr("transform(sequence(1, greatest(most, 1)), i -> coalesce(try_element_at(x, i), 0L))")
    most = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    even = rows.withColumn("most", F.lit(most)).select(
        F.when(F.size("x") == most, F.col("x")).otherwise(filled).alias("x"))
    return materialize(even.distinct(), "vectors")


def added(fit: DataFrame, size: int, of_rows: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of a float matrix over all vectors: per task, then per lot of tasks."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            own = of_rows(_stacked(batch["x"], size))
            total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"lot": [TaskContext.get().partitionId() % LOTS], "sum": [total.tobytes()]})

    def together(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(part) for part in group["sum"])
        return pd.DataFrame({"lot": group["lot"][:1], "sum": [total.tobytes()]})

    parts = fit.mapInPandas(partial, "lot int, sum binary")
    lots = parts.groupBy("lot").applyInPandas(together, "lot int, sum binary").orderBy("lot").collect()
    return sum((np.frombuffer(bytes(row["sum"])) for row in lots), np.zeros(1))


def exact_sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            rows = _stacked(batch["x"], size)
            n += len(rows)
            # Halves of 32 bits, whose sums over a batch fit a long.
            total = total + ((rows >> 32).sum(axis=0).astype(object) << 32) + (rows & 0xFFFFFFFF).sum(axis=0).astype(object)
        yield pd.DataFrame({"at": range(-1, size), "sum": [Decimal(n), *map(Decimal, total.tolist())]})

    sums = fit.mapInPandas(partial, "at int, sum decimal(38,0)").groupBy("at").agg(F.sum("sum").alias("sum"))
    found = {row["at"]: int(row["sum"]) for row in sums.collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(size)]


def fit(vectors: DataFrame, embedding: str = "embedding", components: int | None = None) -> Whitening:
    """Fit the whitening of the first ``components`` components, all by default."""
    known = vectors.select(F.col(f"`{embedding}`").try_cast("array<double>").alias("v"))
    distinct = fit_list(known.where(is_whole(F.col("v"))).select(quantised(F.col("v")).alias("x")))
    size = distinct.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    n, sums = exact_sums(distinct, size)
    start = Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)
    if not n:
        return start

    def products(rows: np.ndarray) -> np.ndarray:
        own = start.centred(rows).astype(np.float64) / n
        return (own.T @ own).ravel()

    covariance = added(distinct, size, products).reshape(size, size) / n
    values, basis = eigenvectors(covariance)
    real = values > size * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    kept = int(real.sum()) if components is None else min(components, int(real.sum()))
    model = Whitening(n, sums, values[:kept], basis[:, :kept], float(np.trace(covariance)))

    def spread(rows: np.ndarray) -> np.ndarray:
        own = model.whitened(model.centred(rows))
        return np.vstack([own.T @ own, own.sum(axis=0)]).ravel()

    error = 0.0
    if kept:
        moments = added(distinct, size, spread).reshape(kept + 1, kept) / n
        error = float(np.abs(moments[:-1] - np.outer(moments[-1], moments[-1]) - np.eye(kept)).max())
    return Whitening(n, sums, model.values, model.vectors, model.trace, error)


def whiten(vectors: DataFrame, model: Whitening, embedding: str = "embedding") -> tuple[DataFrame, str, str]:
    """The rows with a whole vector, with their squared deviation ``n * x - sums`` as an exact
    decimal and their whitened vector. Returns the names of the two new columns as well."""
    deviation, whitened = free_name(vectors.columns, "deviation"), free_name(vectors.columns, "whitened")
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def project(batch: pd.Series) -> pd.DataFrame:
        known = shared.value
        centred = known.centred(_stacked(batch, len(known.sums)))
        bound = len(known.sums) * max(abs(int(centred.min(initial=0))), abs(int(centred.max(initial=0)))) ** 2
        squares = (centred if bound < _SAFE else centred.astype(object)) ** 2
        return pd.DataFrame({
            "d": [Decimal(int(d)) if d < 10 ** 38 else None for d in squares.sum(axis=1)],
            "w": list(known.whitened(centred)),
        })

    own = F.col(f"`{embedding}`").try_cast("array<double>")
    both = F.pandas_udf(project, "d decimal(38,0), w array<double>")
    inner = free_name([*vectors.columns, deviation, whitened], "projected")
    rows = vectors.where(is_whole(own)).withColumn(inner, both(quantised(own)))
    return rows.select(
        *[F.col(f"`{c}`") for c in vectors.columns],
        F.col(inner).getField("d").alias(deviation), F.col(inner).getField("w").alias(whitened),
    ), deviation, whitened
