"""What each group is like, and what to do with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgroups.functions.numbers import number, one_decimal
from spendgroups.functions.strategy import strategy
from spendgroups.schema import AGE, INCOME, SCORE


def group_profile(pred: DataFrame, by: str = "group_id") -> DataFrame:
    """``(by, n_rows, n_age, mean_income, mean_score)``.

    ``n_age`` counts the rows with an age; it is absent if ages are.
    """
    ages = [F.count(AGE).alias("n_age")] if AGE in pred.columns else []
    return pred.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *ages,
        F.avg(number(INCOME)).alias("mean_income"),
        F.avg(number(SCORE)).alias("mean_score"),
    )


def group_report(pred: DataFrame, by: str = "group_id") -> DataFrame:
    """The profile with the strategy that fits the means of each group."""
    return (
        group_profile(pred, by)
        .withColumn("_plan", strategy("mean_income", "mean_score"))
        .withColumns(
            {
                "strategy": F.col("_plan.code"),
                "description": F.col("_plan.description"),
                "action": F.col("_plan.action"),
            }
        )
        .drop("_plan")
    )


def report_text(report: DataFrame, by: str = "group_id") -> DataFrame:
    """A report for reading: means as text with one decimal."""
    return report.select(
        by,
        one_decimal("mean_income").alias("mean_income"),
        one_decimal("mean_score").alias("mean_score"),
        "strategy",
    )
