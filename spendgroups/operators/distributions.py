"""The tables behind the charts: histograms, densities, boxes, grids, counts.

Histograms and densities are taken straight from the rows, boxes from counts of equal
values. Whoever wants several of them may count once and pass ``counts`` to all.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgroups.functions.numbers import is_number, number
from spendgroups.operators.quantiles import (
    ValueCounts,
    count_values,
    long_values,
)
from spendgroups.schema import INCOME, NUMERIC, SCORE
from spendgroups.session import checkpointed

# Beyond this many bandwidths the kernel is below 1e-17 of its height.
KERNEL_REACH = 9.0
# Width of the boxes that values are gathered in, in bandwidths, and the terms kept of each.
BOX = 0.5
TERMS = 20


def _weighted(df: DataFrame, cols: Sequence[str], counts: ValueCounts | None) -> DataFrame:
    """``(column, value, n)``: the counted values, or every value of a row once."""
    if counts is not None:
        return counts.table.select("column", "value", "n")
    return long_values(df, cols).withColumn("n", F.lit(1).cast("bigint"))


def _bin_edges(values: DataFrame, bins: int | str, counts: ValueCounts | None) -> DataFrame:
    """``(column, first, last, bins)``, one row per column."""
    edges = values.groupBy("column").agg(
        F.min("value").alias("first"),
        F.max("value").alias("last"),
        F.bool_and(F.col("value") == F.floor("value")).alias("whole"),
    )
    if bins != "auto":
        chosen = F.lit(int(bins))
    else:
        quartiles = counts.quantiles({"q1": 0.25, "q3": 0.75})
        edges = edges.join(F.broadcast(quartiles), "column")
        spread = F.col("last") - F.col("first")
        size = F.col("total").cast("double")
        sturges = spread / (F.log2(size) + 1)
        freedman = 2 * (F.col("q3") - F.col("q1")) * F.pow(size, -1.0 / 3.0)
        root = spread / F.sqrt(size)
        width = F.least(F.greatest(freedman, root / 2), sturges)
        width = F.when(F.col("whole"), F.greatest(width, F.lit(1.0))).otherwise(width)
        chosen = F.ceil(spread / F.nullif(width, F.lit(0.0))).cast("int")
    # A column with a single value has one bin.
    chosen = F.when(F.col("last") > F.col("first"), chosen).otherwise(1)
    return edges.select("column", "first", "last", chosen.alias("bins"))


def histogram(
    df: DataFrame,
    cols: Sequence[str] = NUMERIC,
    bins: int | str = 20,
    counts: ValueCounts | None = None,
) -> DataFrame:
    """Equal bins from least to greatest value: ``(column, bin, lo, hi, n)``.

    ``bins="auto"`` takes the smaller of the Sturges and Freedman-Diaconis
    widths, the latter held above half the square-root width, and at least 1 for
    columns whose values are all whole. The last bin is closed. Empty bins are listed.

    Given a number of bins, there are two aggregates over the rows, and only bins are
    shuffled. ``"auto"`` needs quartiles, and so counts of equal values.
    """
    if bins == "auto" and counts is None:
        counts = count_values(df, cols)
    values = _weighted(df, cols, counts)
    edges = checkpointed(_bin_edges(values, bins, counts))
    first, last, number_of = F.col("first"), F.col("last"), F.col("bins")
    step = (last - first) / number_of
    value = F.col("value")

    # The quotient may miss an edge by a rounding error, so compare with the edges.
    guess = F.least(F.floor((value - first) / (last - first) * number_of), number_of - 1)
    guess = F.when(last > first, guess).otherwise(0).cast("int")
    place = (
        F.when(value < first + F.col("guess") * step, F.col("guess") - 1)
        .when(
            (F.col("guess") < number_of - 1)
            & (value >= first + (F.col("guess") + 1) * step),
            F.col("guess") + 1,
        )
        .otherwise(F.col("guess"))
    )
    shape = ["column", "first", "last", "bins"]
    filled = (
        values.join(F.broadcast(edges), "column")
        .withColumn("guess", guess)
        .select(*shape, place.alias("bin"), "n")
    )
    empty = edges.select(
        *shape,
        F.explode(F.sequence(F.lit(0), number_of - 1)).alias("bin"),
        F.lit(0).cast("bigint").alias("n"),
    )
    upper = F.when(F.col("bin") == number_of - 1, last).otherwise(
        first + (F.col("bin") + 1) * step
    )
    return (
        filled.union(empty)
        .groupBy(*shape, "bin")
        .agg(F.sum("n").alias("n"))
        .select(
            "column", "bin", (first + F.col("bin") * step).alias("lo"), upper.alias("hi"), "n"
        )
    )


def _spread(placed: DataFrame, spread: DataFrame, points: int) -> DataFrame:
    """``(column, point, mass)``: what all values together add to each grid point.

    With ``t`` the distance of a point and ``s`` that of a value from the middle of the
    value's box, in bandwidths, ``exp(-(t - s)^2 / 2)`` is ``exp(-t^2 / 2)`` times the sum
    over k of ``t^k / k!`` times ``s^k exp(-s^2 / 2)``. Only sums of the last over the values
    of a box are gathered, so a value costs the same however many points it reaches.
    ``|s|`` is at most 1/4: the terms left out are below ``(1/4)^20 / sqrt(20!)``, under
    1e-21 of a value's height, and those beyond the reach below 1e-17.
    """
    first, width = F.col("first"), F.col("width")
    box = F.floor((F.col("value") - first) / (BOX * width))
    middle = first + (F.col("box") + 0.5) * BOX * width
    inside = placed.withColumn("box", box).withColumn("s", (F.col("value") - middle) / width)
    part = F.col("n") * F.exp(-F.col("s") * F.col("s") / 2)
    sums = []
    for k in range(TERMS):
        sums.append(F.sum(part).alias(f"m{k}"))
        part = part * F.col("s")
    boxes = inside.groupBy("column", "box").agg(*sums).join(F.broadcast(spread), "column")
    step = (F.col("last") - first) / (points - 1)
    low = F.greatest(F.lit(0), F.ceil((middle - KERNEL_REACH * width - first) / step))
    high = F.least(F.lit(points - 1), F.floor((middle + KERNEL_REACH * width - first) / step))
    reached = (
        boxes.withColumns({"low": low.cast("int"), "high": high.cast("int")})
        .where("low <= high")
        .withColumn("point", F.explode(F.sequence("low", "high")))
        .withColumn("t", (first + F.col("point") * step - middle) / width)
    )
    t, total = F.col("t"), F.lit(0.0)
    for k in reversed(range(TERMS)):
        total = total * t / (k + 1) + F.col(f"m{k}")
    return reached.select("column", "point", (F.exp(-t * t / 2) * total).alias("mass"))


def density_curve(
    df: DataFrame,
    cols: Sequence[str] = NUMERIC,
    points: int = 200,
    bins: int = 20,
    grain: float | None = None,
    counts: ValueCounts | None = None,
) -> DataFrame:
    """Gaussian density on an even grid: ``(column, point, x, density, height)``.

    The bandwidth is the sample deviation times ``n^(-1/5)``. ``height`` is the
    density scaled to a histogram of ``bins`` bins. A column that does not vary
    has no curve. Values are gathered in boxes of half a bandwidth, combined before the
    shuffle; the boxes, not the values, are spread over the points (``_spread`` states the
    error, which is that of double precision). ``grain`` rounds values to its multiples.
    """
    if grain is not None and counts is None:
        counts = count_values(df, cols, grain=grain)
    values = _weighted(df, cols, counts)
    value, n = F.col("value"), F.col("n")
    centre = values.groupBy("column").agg(
        F.sum("n").cast("double").alias("total"),
        (F.sum(n * value) / F.sum("n")).alias("mean"),
        F.min("value").alias("first"),
        F.max("value").alias("last"),
    )
    square = F.pow(value - F.col("mean"), 2)
    spread = checkpointed(
        values.join(F.broadcast(centre), "column")
        .groupBy("column", "total", "first", "last")
        .agg(F.sum(n * square).alias("squares"))
        .where((F.col("total") > 1) & (F.col("squares") > 0))
        .withColumn(
            "width",
            F.sqrt(F.col("squares") / (F.col("total") - 1)) * F.pow("total", F.lit(-0.2)),
        )
        .drop("squares")
    )
    x = F.col("first") + F.col("point") * (F.col("last") - F.col("first")) / (points - 1)
    felt = _spread(values.join(F.broadcast(spread), "column"), spread, points)
    every_point = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    grid = spread.select("column", every_point.alias("point"), F.lit(0.0).alias("mass"))
    scale = F.col("total") * F.col("width") * math.sqrt(2 * math.pi)
    bin_width = (F.col("last") - F.col("first")) / bins
    return (
        felt.union(grid)
        .groupBy("column", "point")
        .agg(F.sum("mass").alias("mass"))
        .join(F.broadcast(spread), "column")
        .withColumn("density", F.col("mass") / scale)
        .select(
            "column",
            "point",
            x.alias("x"),
            "density",
            (F.col("density") * F.col("total") * bin_width).alias("height"),
        )
    )


def _fences(counts: ValueCounts) -> DataFrame:
    quartiles = counts.quantiles({"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return quartiles.withColumns(
        {"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach}
    )


def box_stats(
    df: DataFrame,
    cols: Sequence[str] = NUMERIC,
    by: str | None = None,
    counts: ValueCounts | None = None,
) -> DataFrame:
    """Boxes: ``(column, [by], n, q1, median, q3, lo, hi, n_out)``.

    The whiskers ``lo`` and ``hi`` are the outermost values within 1.5 times the
    quartile distance of the box; ``n_out`` counts the rows beyond them.
    """
    counts = counts or count_values(df, cols, by)
    value = F.col("value")
    inside = value.between(F.col("low_fence"), F.col("high_fence"))
    return (
        counts.with_facts(counts.table, _fences(counts))
        .groupBy(*counts.keys, "total", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, value)).alias("least"),
            F.max(F.when(inside, value)).alias("greatest"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_out"),
        )
        .select(
            *counts.keys,
            F.col("total").alias("n"),
            "q1",
            "median",
            "q3",
            F.least("least", "q1").alias("lo"),
            F.greatest("greatest", "q3").alias("hi"),
            "n_out",
        )
    )


def box_outliers(
    df: DataFrame,
    cols: Sequence[str] = NUMERIC,
    by: str | None = None,
    keep: Sequence[str] = (),
    counts: ValueCounts | None = None,
) -> DataFrame:
    """Rows beyond the whiskers: ``(keep..., column, [by], value)``."""
    counts = counts or count_values(df, cols, by)
    facts = _fences(counts).select(*counts.keys, "low_fence", "high_fence")
    groups = [] if by is None else [by]
    rows = long_values(df, cols, [*keep, *groups])
    return (
        counts.with_facts(rows, facts)
        .where(~F.col("value").between(F.col("low_fence"), F.col("high_fence")))
        .select(*keep, *counts.keys, "value")
    )


def count_by(df: DataFrame, col: str) -> DataFrame:
    """``(value, n)``; rows without a value are counted under NULL."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def point_pyramid(
    df: DataFrame,
    x: str = INCOME,
    y: str = SCORE,
    by: str | None = None,
    width: float = 1.0,
    factors: Sequence[int] = (1, 2, 4, 8, 16),
) -> DataFrame:
    """``point_grid`` in several widths: ``(factor, x_bin, y_bin, [by], n)``.

    The squares of a level are ``factor`` times ``width`` wide. Rows are read and counted
    once, in the narrowest squares; the levels are counted from those.
    """
    groups = [] if by is None else [by]
    finest = point_grid(df, x, y, by, width)
    levels = finest.withColumn("factor", F.explode(F.array(*[F.lit(int(f)) for f in factors])))
    return levels.groupBy(
        "factor",
        *[F.floor(F.col(c) / F.col("factor")).alias(c) for c in ("x_bin", "y_bin")],
        *groups,
    ).agg(F.sum("n").alias("n"))


def point_grid(
    df: DataFrame,
    x: str = INCOME,
    y: str = SCORE,
    by: str | None = None,
    width: float = 1.0,
) -> DataFrame:
    """Points counted per square of a grid: ``(x_bin, y_bin, [by], n)``.

    With width 1 and whole numbers no detail is lost. Points that miss a
    coordinate cannot be placed.
    """
    groups = [] if by is None else [by]
    return (
        df.where(is_number(x) & is_number(y))
        .groupBy(
            F.floor(number(x) / width).alias("x_bin"),
            F.floor(number(y) / width).alias("y_bin"),
            *groups,
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
