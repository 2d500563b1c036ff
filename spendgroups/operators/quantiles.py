"""Counts of equal values, and exact quantiles computed from them.

Equal values are counted first, so a value that a third of all rows share is a
single row from then on. The counts are written to the shared folder: the source
is read once, whatever is computed from them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgroups.functions.numbers import number
from spendgroups.schema import NUMERIC
from spendgroups.session import checkpointed

# Facts on this many columns and groups are small enough to be broadcast.
FEW_GROUPS = 10_000
SALTS = 32
# A slice of more values than this is cut again before anything in it is put in order.
SLICE_VALUES = 200_000
PIECES = 256


@dataclass(frozen=True)
class ValueCounts:
    """``(column, [by], value, n)``, with the number of such rows."""

    table: DataFrame
    size: int
    by: str | None = None

    @property
    def keys(self) -> list[str]:
        return ["column"] if self.by is None else ["column", self.by]

    @cached_property
    def few_groups(self) -> bool:
        """True if facts on each column and group are small enough to broadcast."""
        if self.by is None:
            return True
        groups = self.table.select(*self.keys).distinct()
        return groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS

    def with_facts(self, rows: DataFrame, facts: DataFrame) -> DataFrame:
        """Join ``facts``, one row per column and group, to ``rows``.

        Facts are broadcast if they are few. Otherwise, as one group may hold a
        large part of the rows, the join is spread over salts by value.
        """
        if self.few_groups:
            return rows.join(F.broadcast(facts), self.keys)
        salt = F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        return (
            rows.withColumn("_salt", salt)
            .join(facts.withColumn("_salt", copies), [*self.keys, "_salt"])
            .drop("_salt")
        )

    def quantiles(self, probs: Mapping[str, float]) -> DataFrame:
        return exact_quantiles(self, probs)


def long_values(
    df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), grain: float | None = None
) -> DataFrame:
    """``(keep..., column, value)``, one row per number."""
    values = {name: number(name) for name in cols}
    if grain is not None:
        values = {name: F.round(value / grain) * grain for name, value in values.items()}
    table = df.select(*keep, *[value.alias(name) for name, value in values.items()])
    return table.unpivot(list(keep), list(cols), "column", "value").where(
        F.col("value").isNotNull()
    )


def count_values(
    df: DataFrame,
    cols: Sequence[str] = NUMERIC,
    by: str | None = None,
    grain: float | None = None,
) -> ValueCounts:
    """Count equal numbers in ``cols``, in one scan.

    ``grain`` rounds values to its multiples, which moves each by at most half
    of it; for columns with very many distinct values. Rows without a ``by``
    value belong to no group and are left out.
    """
    keys = [] if by is None else [by]
    if by is not None:
        df = df.where(F.col(by).isNotNull())
    counts = (
        long_values(df, cols, keys, grain)
        .groupBy("column", *keys, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    table = checkpointed(counts)
    return ValueCounts(table, table.count(), by)


def exact_quantiles(counts: ValueCounts, probs: Mapping[str, float]) -> DataFrame:
    """Quantiles, linear between neighbours.

    Result: ``(column, [by], total, <one column per name in probs>)``.

    A slice is a range of values of one column and group that holds a wanted rank; at
    first it is all of them. As long as a slice has more than ``SLICE_VALUES`` different
    values, it is cut into pieces at approximate quantiles, and the totals of the pieces
    tell which of them hold the ranks. So what is put in order in one task is bounded,
    whatever the table, and results do not depend on how often a slice was cut.
    """
    keys = counts.keys
    whole = counts.table.groupBy(*keys).agg(
        F.sum("n").alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.count(F.lit(1)).alias("values"),
        F.lit(0).cast("bigint").alias("before"),
    )
    slices = checkpointed(whole)
    while (slices.agg(F.max("values")).first()[0] or 0) > SLICE_VALUES:
        slices = checkpointed(_cut(counts, slices, probs))
    inside = Window.partitionBy(*keys, "low").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = _inside(counts, slices).withColumn("end", F.col("before") + F.sum("n").over(upto))

    def at(rank: Column) -> Column:
        holds = (rank >= F.col("end") - F.col("n")) & (rank < F.col("end"))
        return F.max(F.when(holds, F.col("value")))

    places = spots(probs)
    ends = {}
    for name, spot in places.items():
        ends[f"{name}_low"] = at(F.floor(spot))
        ends[f"{name}_high"] = at(F.ceil(spot))
    found = ranked.groupBy(*keys, "total").agg(*[e.alias(n) for n, e in ends.items()])
    quantiles = [
        (
            F.col(f"{name}_low")
            + (F.col(f"{name}_high") - F.col(f"{name}_low")) * (spot - F.floor(spot))
        ).alias(name)
        for name, spot in places.items()
    ]
    return found.select(*keys, "total", *quantiles)


def spots(probs: Mapping[str, float]) -> dict[str, Column]:
    """The places of the quantiles among the ``total`` values in order, from 0."""
    return {name: F.lit(p) * (F.col("total") - 1) for name, p in probs.items()}


def _inside(counts: ValueCounts, slices: DataFrame) -> DataFrame:
    """The values of each slice."""
    return counts.with_facts(counts.table, slices).where("value BETWEEN low AND high")


def _cut(counts: ValueCounts, slices: DataFrame, probs: Mapping[str, float]) -> DataFrame:
    """The pieces of the slices that hold a wanted rank, as slices."""
    keys = counts.keys
    steps = ", ".join(f"{i / PIECES!r}D" for i in range(1, PIECES))
    cuts = (
        _inside(counts, slices)
        .groupBy(*keys, "low", "high", "total", "before")
        .agg(F.expr(f"percentile_approx(value, array({steps}), 10000)").alias("cuts"))
    )
    piece = F.size(F.filter("cuts", lambda cut: cut < F.col("value")))
    pieces = (
        _inside(counts, checkpointed(cuts))
        .groupBy(*keys, "low", "total", "before", piece.alias("piece"))
        .agg(
            F.sum("n").alias("held"),
            F.count(F.lit(1)).alias("values"),
            F.min("value").alias("least"),
            F.max("value").alias("most"),
        )
    )
    upto = (
        Window.partitionBy(*keys, "low")
        .orderBy("piece")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = pieces.withColumn("upto", F.col("before") + F.sum("held").over(upto))
    first = F.col("upto") - F.col("held")
    ranks = F.array(*[r for s in spots(probs).values() for r in (F.floor(s), F.ceil(s))])
    return placed.where(F.exists(ranks, lambda r: (r >= first) & (r < F.col("upto")))).select(
        *keys, "total", F.col("least").alias("low"), F.col("most").alias("high"), "values",
        first.alias("before"),
    )
