"""Customer tables derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgroups.schema import AGE, CUSTOMER_ID, GENDER, INCOME, SCORE


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


def _div(amount: Column, by: int) -> Column:
    """Whole-number quotient."""
    return F.call_function("div", amount, F.lit(by))


def profile(spark: SparkSession, folder: str) -> DataFrame:
    """Clean customers; whole numbers only."""
    spent = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(_cents("o_totalprice")).alias("cents"))
    )
    n_orders = F.coalesce("n_orders", F.lit(0))
    cents = F.coalesce("cents", F.lit(0))
    even = F.col("c_custkey") % 2 == 0
    return (
        table(spark, folder, "customer")
        .join(spent, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias(CUSTOMER_ID),
            F.when(even, "Female").otherwise("Male").alias(GENDER),
            F.least(F.lit(70), 18 + 2 * n_orders).cast("int").alias(AGE),
            (15 + _div((_cents("c_acctbal") + 100_000) * 122, 1_100_000))
            .cast("int")
            .alias(INCOME),
            F.least(F.lit(99), F.greatest(F.lit(1), _div(cents, 6_250_000)))
            .cast("int")
            .alias(SCORE),
        )
    )


def loaded_profile(spark: SparkSession, folder: str) -> DataFrame:
    """``profile`` with the types a loaded customer table has."""
    return profile(spark, folder).withColumns(
        {name: F.col(name).cast("double") for name in (INCOME, SCORE)}
    )


def profile_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """``profile`` with missing, odd and repeated rows."""
    key = F.col(CUSTOMER_ID)

    def every(n: int) -> Column:
        return key % n == 0

    copies = F.when(every(50), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    income = (
        F.when(every(23), F.lit(float("nan"))).when(every(31), 400.0).otherwise(F.col(INCOME))
    )
    return (
        profile(spark, folder)
        .withColumns(
            {
                GENDER: F.when(~every(11), F.col(GENDER)),
                AGE: F.when(every(17), None).when(every(29), 75).otherwise(F.col(AGE)),
                INCOME: income.cast("double"),
                SCORE: F.when(~every(37), F.col(SCORE).cast("double")),
                "_copy": F.explode(copies),
            }
        )
        .drop("_copy")
    )


def blobs(spark: SparkSession, folder: str) -> DataFrame:
    """Five known groups, ``c_custkey % 5``; each ninth age is missing."""
    key = F.col("c_custkey")
    part = key % 5

    def centre(values: list[int]) -> Column:
        return F.array(*[F.lit(v) for v in values])[part.cast("int")]

    return table(spark, folder, "customer").select(
        key.alias(CUSTOMER_ID),
        F.when(key % 2 == 0, "Female").otherwise("Male").alias(GENDER),
        F.when(key % 9 != 0, 18 + key % 50).cast("int").alias(AGE),
        (centre([88, 88, 25, 25, 55]) + F.floor(key / 5) % 7 - 3).cast("double").alias(INCOME),
        (centre([82, 17, 80, 20, 50]) + F.floor(key / 35) % 9 - 4).cast("double").alias(SCORE),
    )
