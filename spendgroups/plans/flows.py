"""The whole flows: explore a table, train on it, score with a saved model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgroups.operators import distributions, quality
from spendgroups.operators.cluster import GroupModel, assign_groups, fit_groups
from spendgroups.operators.columns import (
    apply_opt_out,
    cast_customers,
    fill_missing_columns,
    split_rejects,
)
from spendgroups.operators.profile import group_report
from spendgroups.operators.quantiles import count_values
from spendgroups.operators.scoring import score_customers
from spendgroups.schema import FEATURES, GENDER, K_DEFAULT, NUMERIC
from spendgroups.session import checkpointed, stored
from spendgroups.sources import models


def explore(df: DataFrame, bins: int | str = 20) -> dict[str, DataFrame]:
    """The tables that describe a customer table, by name.

    The value counts behind the charts are taken once for all of them; so are the one row
    of measures behind the overview and the correlations, and the grid of points.
    """
    cols = [c for c in NUMERIC if c in df.columns]
    counts = count_values(df, cols)
    overview = checkpointed(quality.table_overview(df, cols))
    by = [GENDER] if GENDER in df.columns else []
    grid = stored(distributions.point_grid(df, by=by[0] if by else None), "points")
    tables = {
        "overview": overview,
        "duplicates": quality.duplicate_count(df),
        "correlation": overview.select(F.inline("correlations")),
        "histogram": distributions.histogram(df, cols, bins, counts=counts),
        "density": distributions.density_curve(df, cols, counts=counts),
        "boxes": distributions.box_stats(df, cols, counts=counts),
        "outliers": distributions.box_outliers(df, cols, counts=counts),
        "points": grid.groupBy("x_bin", "y_bin").agg(F.sum("n").alias("n")),
    }
    if by:
        tables["genders"] = distributions.count_by(df, GENDER)
        tables["points_by_gender"] = grid
    return tables


@dataclass
class TrainingResult:
    model: GroupModel
    path: str
    grouped: DataFrame
    rejects: DataFrame
    report: DataFrame

    def sizes(self) -> DataFrame:
        return distributions.count_by(self.grouped, "group_id")

    def points(self) -> DataFrame:
        return distributions.point_grid(self.grouped, by="group_id")

    def boxes(self) -> DataFrame:
        return distributions.box_stats(self.grouped, FEATURES, by="group_id")


def train(
    df: DataFrame, name: str, root: str, k: int = K_DEFAULT, source: str = "batch"
) -> TrainingResult:
    """Fit, save and describe a model; rows without income or score are rejects."""
    good, rejects = split_rejects(df)
    model = fit_groups(good, k)
    path = models.save_model(df.sparkSession, model, name, source, root)
    grouped = assign_groups(good, model)
    return TrainingResult(model, path, grouped, rejects, group_report(grouped))


def score(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    root: str,
    flags: Mapping[str, str] | None = None,
    raw: bool = False,
    text_ids: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Score a table with a saved model: ``(scored, rejects)``.

    Columns that the table lacks get their defaults, as do the values for which the
    column that ``flags`` names is false; an empty cell does not. A ``raw`` table is cast
    then, and rows with a cell that is missing or unreadable are the rejects, with
    ``faults``; else the rejects are the rows without income or score.
    """
    df = fill_missing_columns(df)
    if flags:
        df = apply_opt_out(df, flags)
    if raw:
        df, unreadable = cast_customers(df, text_ids)
    record = models.model_record(spark, name, root)
    model = models.load_model(spark, name, root, record)
    scored, rejects = score_customers(df, model, record, check_range=True, flags=flags)
    return scored, unreadable if raw else rejects
