"""Scoring whole tables with a fitted model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgroups.functions.ranges import warning_list
from spendgroups.functions.strategy import strategy, strategy_code
from spendgroups.operators.cluster import GroupModel, assign_groups
from spendgroups.operators.columns import split_rejects
from spendgroups.schema import INCOME, SCORE, TRAIN_DOMAIN


def score_customers(
    df: DataFrame,
    model: GroupModel,
    record: Mapping | None = None,
    check_range: bool = False,
    flags: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(scored, rejects)``; rejects lack an income or a score.

    A scored row has the columns of ``df`` and the group, the strategy for the
    customer's own values with its texts, the strategy for the group's means,
    and, if the record of the model is given, its name and date. ``check_range``
    adds ``warnings`` about values outside the table the model was trained on, but
    for values that their column of ``flags`` opts out.
    """
    good, rejects = split_rejects(df)
    codes = _group_strategies(model)
    scored = assign_groups(good, model).withColumn("_plan", strategy(INCOME, SCORE))
    added = {
        "group_strategy": F.array(*codes)[F.col("group_id")],
        "customer_strategy": F.col("_plan.code"),
        "description": F.col("_plan.description"),
        "action": F.col("_plan.action"),
    }
    if record is not None:
        added["model_name"] = F.lit(record["name"])
        added["model_date"] = F.lit(record["date"])
    if check_range:
        domain = model.training_domain() or TRAIN_DOMAIN
        added["warnings"] = warning_list(
            {c: d for c, d in domain.items() if c in df.columns}, flags
        )
    return scored.withColumns(added).select(*df.columns, "group_id", *added), rejects


def _group_strategies(model: GroupModel) -> list:
    """Strategy of each group id, from the training means, else the centres."""
    means = {i: centre for i, centre in zip(model.group_ids(), model.centres())}
    for group in model.groups:
        means[group["group_id"]] = (group["mean_income"], group["mean_score"])
    return [
        strategy_code(F.lit(float(means[i][0])), F.lit(float(means[i][1])))
        for i in range(len(means))
    ]
