"""Operators on single rows: defaults, casts, lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgroups.functions.ranges import warning_list
from spendgroups.schema import (
    AGE,
    COLUMN_TYPES,
    CUSTOMER_ID,
    DEFAULTS,
    INCOME,
    NUMERIC,
    SCORE,
    TRAIN_DOMAIN,
)
from spendgroups.session import broadcast_if_few, stored


def fill_missing_columns(df: DataFrame, defaults: Mapping[str, object] = DEFAULTS) -> DataFrame:
    """Add each column the table lacks, with its default. NULL cells stay."""
    absent = {
        name: F.lit(value).cast(COLUMN_TYPES[name])
        for name, value in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(absent) if absent else df


def apply_opt_out(
    df: DataFrame, flags: Mapping[str, str], defaults: Mapping[str, object] = DEFAULTS
) -> DataFrame:
    """Put the default where the flag column of a value is false; columns keep their types."""
    return df.withColumns(
        {
            name: F.when(
                F.coalesce(F.col(flag), F.lit(True)), F.col(name)
            ).otherwise(F.lit(defaults[name]).cast(df.schema[name].dataType))
            for name, flag in flags.items()
        }
    )


def with_range_warnings(
    df: DataFrame,
    domain: Mapping[str, tuple] = TRAIN_DOMAIN,
    flags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``warnings``, an array with one text per value out of range."""
    return df.withColumn("warnings", warning_list(domain, flags))


def cast_customers(df: DataFrame, text_ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """Cast raw columns to the standard types: ``(ok, rejects)``.

    Age is cut to whole years. A row is rejected, as it came and with the names
    of the columns at fault, if a number is missing or unreadable.
    """
    casts: dict[str, Column] = {}
    for name in NUMERIC:
        value = F.col(name).cast("string").try_cast("double")
        value = F.when(~F.isnan(value), value)
        casts[name] = value.try_cast(COLUMN_TYPES[name]) if name == AGE else value
    if CUSTOMER_ID in df.columns:
        key = F.col(CUSTOMER_ID).cast("string")
        casts[CUSTOMER_ID] = key if text_ids else key.try_cast("bigint")
    faults = F.filter(
        F.array(*[F.when(value.isNull(), name) for name, value in casts.items()]),
        lambda name: name.isNotNull(),
    )
    marked = df.withColumn("faults", faults)
    ok = marked.where(F.size("faults") == 0).drop("faults").withColumns(casts)
    return ok, marked.where(F.size("faults") > 0)


def split_rejects(
    df: DataFrame, needed: Sequence[str] = (INCOME, SCORE)
) -> tuple[DataFrame, DataFrame]:
    """Rows with a number in every needed column, and the other rows."""
    good = F.lit(True)
    for name in needed:
        value = F.col(name).cast("double")
        good = good & value.isNotNull() & ~F.isnan(F.coalesce(value, F.lit(0.0)))
    return df.where(good), df.where(~good)


def lookup_ids(
    df: DataFrame,
    ids: DataFrame,
    key: str = CUSTOMER_ID,
    first_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose id is listed in ``ids``.

    ``first_by`` names the order in which the first of several rows with the
    same id is taken; without it all of them are returned.
    """
    listed = broadcast_if_few(stored(ids.select(key).distinct(), "ids"))
    found = df.join(listed, key, "left_semi")
    if first_by is None:
        return found
    row = F.struct(*df.columns)
    return (
        found.groupBy(key)
        .agg(F.min_by(row, F.struct(*first_by)).alias("_row"))
        .select("_row.*")
    )


def lookup_positions(
    df: DataFrame, positions: DataFrame, position: str = "position"
) -> DataFrame:
    """Rows at the listed 0-based positions of a table with a position column."""
    listed = broadcast_if_few(stored(positions.select(position).distinct(), "positions"))
    return df.join(listed, position, "left_semi").select(*df.columns)
