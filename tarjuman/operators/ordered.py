"""Running values along an order, without one task per group.

A window over a whole group sends the group to one task. Here rows are range
partitioned by the order instead, so a group of any size is cut into runs of
even length, ties included; a window works within a run, and one small row per
run and group carries the result of the earlier runs over.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarjuman.workspace import materialize

_LOW_BITS = (1 << 33) - 1


def sorted_runs(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``run`` and ``pos``: globally ordered by (run, pos).

    ``order`` must end in a unique key, which is what lets ties be split. The
    table is written, as the cut points must not move between its uses. Their
    number is left open, so that adaptive execution can fit it to the data.
    """
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("run", F.shiftright("_place", 33).cast("int"))
        .withColumn("pos", F.col("_place").bitwiseAND(F.lit(_LOW_BITS)))
        .drop("_place")
    )
    return materialize(placed, "runs")


@dataclass(frozen=True)
class Measure:
    """A running value called ``name``: ``total`` of ``value`` up to each row.

    ``merge`` combines the total carried over with the one within the run.
    ``backwards`` runs from the end of the order.
    """

    name: str
    value: Column
    total: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]
    backwards: bool = False

    def along(self, column: str) -> Column:
        return F.col(column).desc() if self.backwards else F.col(column).asc()


def running(runs: DataFrame, by: list[str], *measures: Measure) -> DataFrame:
    """Add the measures, each over the rows of its group up to this one.

    A group is one value of ``by`` and must be contiguous, or nested in a
    contiguous one, in the order of ``runs``.
    """
    totals = runs.groupBy("run", *by).agg(
        *[m.total(m.value).alias(f"_total_{m.name}") for m in measures]
    )
    local, carries = {}, []
    for m in measures:
        within = Window.partitionBy("run", *by).orderBy(m.along("pos"))
        within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local[f"_local_{m.name}"] = m.total(m.value).over(within)
        # At most one row per run in each group.
        earlier = Window.partitionBy(*by).orderBy(m.along("run"))
        earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
        carry = m.total(F.col(f"_total_{m.name}")).over(earlier)
        carries.append(carry.alias(f"_carry_{m.name}"))
    groups = {c: f"_of_{c}" for c in ["run", *by]}
    carried = totals.select(*[F.col(c).alias(name) for c, name in groups.items()], *carries)
    same = [F.col(c).eqNullSafe(F.col(name)) for c, name in groups.items()]
    merged = {
        m.name: m.merge(F.col(f"_carry_{m.name}"), F.col(f"_local_{m.name}")) for m in measures
    }
    spent = [*groups.values(), *[f"_{part}_{m.name}" for m in measures for part in ("carry", "local")]]
    return runs.withColumns(local).join(carried, same, "left").withColumns(merged).drop(*spent)


def add(carry: Column, local: Column) -> Column:
    return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))


def position(runs: DataFrame, by: list[str], name: str) -> DataFrame:
    """Add the zero-based place of each row in its group."""
    numbered = running(runs, by, Measure(name, F.lit(1).cast("long"), F.sum, add))
    return numbered.withColumn(name, F.col(name) - 1)
