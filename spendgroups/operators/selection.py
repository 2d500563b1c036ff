"""Exact quantiles by digits: rows are counted by the leading bits of their values.

Doubles are mapped to whole numbers in the same order. A pass counts the rows of every
column and group by the next eleven bits, within the few ranges that hold a wanted rank.
Only counts are shuffled, never values: at most 2,048 for each such range, whatever the
table, and at most six passes are needed. The rows are read from one narrow written copy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgroups.operators.quantiles import ValueCounts, long_values, spots
from spendgroups.schema import NUMERIC
from spendgroups.session import broadcast_if_few, checkpointed, stored

# How far a value is shifted to leave the digits counted so far: 11 bits more each pass.
SHIFTS = (53, 42, 31, 20, 9, 0)
_MANTISSA = 52


def with_ordered_bits(df: DataFrame, value: str, out: str) -> DataFrame:
    """Add ``out``: a whole number for each double, in the order of the doubles. It has the
    bits of the absolute value, negated below zero; both zeros have 0."""
    size = F.abs(value)
    guess = F.least(F.greatest(F.floor(F.log2("_size")), F.lit(-1022)), F.lit(1023))
    # A logarithm may be off by a little near a power of two; the power itself is exact.
    exponent = (
        F.when((F.col("_size") < F.col("_power")) & (F.col("_guess") > -1022), F.col("_guess") - 1)
        .when((F.col("_size") / 2 >= F.col("_power")) & (F.col("_guess") < 1023), F.col("_guess") + 1)
        .otherwise(F.col("_guess"))
    )
    part = F.col("_size") / F.pow(F.lit(2.0), "_exponent") * 2.0**_MANTISSA
    normal = F.shiftleft(F.col("_exponent") + 1022, _MANTISSA) + part.cast("bigint")
    # Below the smallest normal number the bits are a multiple of 2^-1074.
    tiny = (F.col("_size") * 2.0**537 * 2.0**537).cast("bigint")
    bits = (
        F.when(F.col("_size") < 2.0**-1022, tiny)
        .when(F.col("_size") > 1.7976931348623157e308, F.lit(2047 << _MANTISSA))
        .otherwise(normal)
    )
    steps = {"_size": size, "_guess": guess, "_power": F.pow(F.lit(2.0), "_guess")}
    steps |= {"_exponent": exponent, "_bits": bits}
    found = df
    for name, step in steps.items():
        found = found.withColumn(name, step)
    signed = F.when(F.col(value) < 0, -F.col("_bits")).otherwise(F.col("_bits"))
    return found.withColumn(out, signed).drop(*steps)


@dataclass(frozen=True)
class ValueRows(ValueCounts):
    """``(column, [by], value, bits, n)`` with a row for every number; ``n`` is 1.

    Takes the place of value counts where a column has very many different values.
    """

    @cached_property
    def few_groups(self) -> bool:
        return super().few_groups

    def quantiles(self, probs: Mapping[str, float]) -> DataFrame:
        return quantiles_by_digits(self, probs)


def value_rows(df: DataFrame, cols: Sequence[str] = NUMERIC, by: str | None = None) -> ValueRows:
    """The numbers of ``cols``, written once. Rows without a ``by`` value are left out."""
    keys = [] if by is None else [by]
    if by is not None:
        df = df.where(F.col(by).isNotNull())
    table = with_ordered_bits(long_values(df, cols, keys), "value", "bits")
    return ValueRows(stored(table, "values").withColumn("n", F.lit(1).cast("bigint")), -1, by)


def _held(pieces: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    """The pieces that hold a wanted rank; ``before`` rows of the group come ahead."""
    ranks = F.array(*[r for s in spots(probs).values() for r in (F.floor(s), F.ceil(s))])
    first = F.col("before")
    return pieces.where(
        F.exists(ranks, lambda r: (r >= first) & (r < first + F.col("n")))
    ).select(*keys, "total", "before", "n", "prefix", "least", "most")


def quantiles_by_digits(rows: ValueRows, probs: Mapping[str, float]) -> DataFrame:
    """Quantiles, linear between neighbours: ``(column, [by], total, <names in probs>)``.

    The results of ``exact_quantiles``, from the rows instead of counts of equal values.
    """
    keys = rows.keys
    bits, pieces = F.col("bits"), None
    for shift in SHIFTS:
        here, parent = rows.table, []
        if pieces is not None:
            if pieces.where("least < most").isEmpty():
                break
            # A piece of one value stays as it is.
            done = pieces.where("least = most")
            wider = pieces.where("least < most")
            last = SHIFTS[SHIFTS.index(shift) - 1]
            asked = wider.select(*keys, F.col("prefix").alias("parent"), "total", F.col("before").alias("ahead"))
            here = here.withColumn("parent", F.shiftright(bits, last))
            here = here.join(broadcast_if_few(asked), [*keys, "parent"])
            parent = ["parent", "total", "ahead"]
        counted = here.groupBy(*keys, *parent, F.shiftright(bits, shift).alias("prefix")).agg(
            F.sum("n").alias("n"), F.min("value").alias("least"), F.max("value").alias("most")
        )
        within = Window.partitionBy(*keys, *parent[:1])
        upto = within.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("n").over(upto), F.lit(0))
        if pieces is None:
            counted = counted.withColumn("total", F.sum("n").over(within))
            counted = counted.withColumn("before", before)
        else:
            counted = counted.withColumn("before", F.col("ahead") + before)
        found = _held(counted, keys, probs)
        pieces = checkpointed(found if pieces is None else found.unionByName(done))

    def at(rank: Column) -> Column:
        holds = (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))
        return F.max(F.when(holds, F.col("least")))

    ends = {}
    for name, spot in spots(probs).items():
        ends[f"{name}_low"], ends[f"{name}_high"] = at(F.floor(spot)), at(F.ceil(spot))
    found = pieces.groupBy(*keys, "total").agg(*[e.alias(n) for n, e in ends.items()])
    low, high = (lambda n: F.col(f"{n}_low")), (lambda n: F.col(f"{n}_high"))
    return found.select(
        *keys,
        "total",
        *[
            (low(n) + (high(n) - low(n)) * (spot - F.floor(spot))).alias(n)
            for n, spot in spots(probs).items()
        ],
    )
