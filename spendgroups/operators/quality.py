"""Checks and summaries of a whole table, each in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendgroups.functions.numbers import number
from spendgroups.schema import NUMERIC
from spendgroups.session import broadcast_if_few, stored


def missing_cells(field: T.StructField) -> Column:
    value = F.col(field.name)
    absent = value.isNull()
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        absent = absent | F.isnan(value)
    return F.struct(
        F.lit(field.name).alias("column"), F.count_if(absent).alias("n_missing")
    )


def _description(name: str) -> Column:
    value = number(name)
    return F.struct(
        F.lit(name).alias("column"),
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def _range(name: str) -> Column:
    value = number(name)
    return F.struct(
        F.lit(name).alias("column"), F.min(value).alias("lo"), F.max(value).alias("hi")
    )


def _pearson(first: str, second: str) -> Column:
    """Correlation over rows that have both values; NULL if one does not vary.

    The built-in function raises a division error where a column is constant.
    """
    a, b = number(first), number(second)
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0))


def _correlations(cols: Sequence[str]) -> list[Column]:
    def entry(a: str, b: str, r: Column) -> Column:
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r"))

    entries = [entry(c, c, F.when(F.stddev_pop(number(c)) > 0, 1.0)) for c in cols]
    for a, b in combinations(cols, 2):
        r = _pearson(a, b)
        entries += [entry(a, b, r), entry(b, a, r)]
    return entries


def _unfolded(df: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """One aggregate row, turned into one row per entry."""
    names = [f"_{i}" for i in range(len(entries))]
    folded = df.agg(*[e.alias(n) for e, n in zip(entries, names)])
    return folded.select(F.inline(F.array(*names)))


def missing_counts(df: DataFrame) -> DataFrame:
    """NULL or NaN cells of every column: ``(column, n_missing)``."""
    return _unfolded(df, [missing_cells(field) for field in df.schema])


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(field.dataType) for field in kind)
    return isinstance(kind, (T.MapType, T.VariantType))


def row_address(df: DataFrame) -> Column:
    """128 bits that are equal for equal rows, as a struct of two numbers.

    Hashes pass over NULL, so which cells are NULL goes in too. Columns that cannot be
    hashed take no part.
    """
    cells = [F.col(f"`{f.name}`") for f in df.schema if not _holds_map(f.dataType)]
    cells.append(F.array(*[F.col(f"`{c}`").isNull() for c in df.columns]))
    return F.struct(
        F.xxhash64(*cells).alias("high"), F.xxhash64(F.lit(1), *cells).alias("low")
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, and rows beyond the first of equal ones: ``(n_rows, n_duplicates)``.

    Row addresses are counted first. Only rows whose address repeats are compared cell by
    cell, so a table without duplicates has none of its cells shuffled. NULL equals NULL
    and NaN equals NaN; a table without columns or rows counts as it stands.
    """
    if not df.columns:
        n = F.count(F.lit(1))
        return df.agg(n.alias("n_rows"), F.greatest(n - 1, F.lit(0)).alias("n_duplicates"))
    counted = df.select(row_address(df).alias("_address")).groupBy("_address")
    counted = counted.agg(F.count(F.lit(1)).alias("_n"))
    # Addresses that do not repeat become one row before they are shuffled again.
    again = F.when(F.col("_n") > 1, F.col("_address")).alias("_address")
    counts = stored(counted.groupBy(again).agg(F.sum("_n").alias("_n")), "addresses")
    none = F.lit(0).cast("bigint")
    total = counts.agg(F.coalesce(F.sum("_n"), none).alias("n_rows"), none.alias("n_duplicates"))
    repeated = counts.where(F.col("_address").isNotNull()).select("_address")
    if repeated.isEmpty():
        return total
    # The address has a name that no column of the table has.
    name = "_address"
    while name in df.columns:
        name += "_"
    rows = df.withColumn(name, row_address(df)).join(
        broadcast_if_few(repeated.withColumnRenamed("_address", name)), name, "left_semi"
    )
    equal = rows.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("_equal"))
    found = equal.agg(none.alias("n_rows"), F.sum(F.col("_equal") - 1).alias("n_duplicates"))
    return total.unionByName(found).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_duplicates").alias("n_duplicates")
    )


def describe_numeric(df: DataFrame, cols: Sequence[str] = NUMERIC) -> DataFrame:
    """``(column, n, mean, sd, min, max)``, with the sample deviation."""
    return _unfolded(df, [_description(c) for c in cols])


def training_domain(df: DataFrame, cols: Sequence[str] = NUMERIC) -> DataFrame:
    """``(column, lo, hi)``."""
    return _unfolded(df, [_range(c) for c in cols])


def correlation(df: DataFrame, cols: Sequence[str] = NUMERIC) -> DataFrame:
    """Pearson matrix in long form: ``(a, b, r)``."""
    return _unfolded(df, _correlations(cols))


def table_overview(df: DataFrame, cols: Sequence[str] = NUMERIC) -> DataFrame:
    """Row count, missing cells, description and correlations from one scan.

    One row with arrays: ``n_rows``, ``missing``, ``described``, ``correlations``.
    """
    parts = {
        "missing": [missing_cells(field) for field in df.schema],
        "described": [_description(c) for c in cols],
        "correlations": _correlations(cols),
    }
    flat = [
        entry.alias(f"{part}_{i}")
        for part, entries in parts.items()
        for i, entry in enumerate(entries)
    ]
    folded = df.agg(F.count(F.lit(1)).alias("n_rows"), *flat)
    arrays = [
        F.array(*[f"{part}_{i}" for i in range(len(entries))]).alias(part)
        for part, entries in parts.items()
    ]
    return folded.select("n_rows", *arrays)
