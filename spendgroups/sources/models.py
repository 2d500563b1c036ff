"""Saving, listing and loading fitted models."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgroups.functions.numbers import time_text
from spendgroups.operators.cluster import GroupModel
from spendgroups.sources import commits

# The first five fields are found in every record, the others only in our own.
META_FIELDS = {
    "name": "string",
    "k": "int",
    "date": "string",
    "source": "string",
    "paths": "struct<hdfs: string, local: string>",
    "version": "string",
    "cost": "double",
    "n_rows": "bigint",
    "domain": "array<struct<column: string, lo: double, hi: double>>",
    "scaling": "array<struct<column: string, mean: double, sd: double>>",
    "groups": "array<struct<group_id: int, prediction: int, n_rows: bigint,"
    " mean_income: double, mean_score: double>>",
}
META_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in META_FIELDS.items())


def _checked(name: str) -> str:
    if not name or name.startswith((".", "_")) or any(c in name for c in "/\\*?[]{}"):
        raise ValueError(f"not usable as a model name: {name!r}")
    return name


def save_model(
    spark: SparkSession, fitted: GroupModel, name: str, source: str, root: str
) -> str:
    """Save a fitted model and return its path.

    A model of the same name is replaced: the new one is written to a folder of
    its own, and its record, added last, makes it the one that counts. If the
    write fails, the older model stays in place. Of two writers the one whose record
    gets the higher number wins, whatever their clocks say.
    """
    path = f"{root}/{_checked(name)}/{uuid.uuid4().hex}"
    fitted.pipeline.write().overwrite().save(path)
    # The letter puts numbers behind the times that older records have.
    version = f"n{commits.claim(spark, f'{root}/{name}_versions'):012d}"
    on_hdfs = path.startswith("hdfs:")
    record = {
        "name": name,
        "k": fitted.k,
        "source": source,
        "paths": {"hdfs": path if on_hdfs else None, "local": None if on_hdfs else path},
        "version": version,
        "cost": fitted.cost,
        "n_rows": fitted.n_rows,
        "domain": fitted.domain,
        "scaling": fitted.scaling,
        "groups": fitted.groups,
    }
    (
        spark.createDataFrame([record], META_SCHEMA)
        .withColumn("date", time_text())
        .write.mode("append")
        .json(f"{root}/{name}_meta.json")
    )
    return path


def list_models(spark: SparkSession, root: str) -> DataFrame:
    """One row per model name, the newest; records that cannot be read are left out."""
    try:
        records = (
            spark.read.schema(META_SCHEMA)
            .option("multiLine", True)
            .option("mode", "DROPMALFORMED")
            .json(f"{root}/*_meta.json")
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], META_SCHEMA)
        raise
    newest = F.max_by(
        F.struct(*META_FIELDS), F.struct(F.col("version"), F.col("date"))
    )
    return (
        records.where(F.col("name").isNotNull())
        .groupBy("name")
        .agg(newest.alias("record"))
        .select("record.*")
    )


def model_record(spark: SparkSession, name: str, root: str) -> dict:
    """The record of one model."""
    row = list_models(spark, root).where(F.col("name") == name).first()
    if row is None:
        raise LookupError(f"no model named {name!r} under {root}")
    return row.asDict(recursive=True)


def load_stages(record: Mapping, root: str | None = None) -> tuple[PipelineModel, str]:
    """Load from the first path that works; returns model and path.

    The recorded paths come first, then, if ``root`` is given, the folder there that
    bears the model's name.
    """
    paths = record.get("paths") or {}
    by_name = None if root is None else f"{root}/{record['name']}"
    failures = []
    for path in (paths.get("local"), paths.get("hdfs"), by_name):
        if path is None:
            continue
        try:
            return PipelineModel.load(path), path
        except Exception as error:  # any storage may fail in its own way
            failures.append(f"{path}: {error}")
    raise LookupError(f"model {record.get('name')!r} not loaded; tried {failures}")


def load_model(
    spark: SparkSession, name: str, root: str, record: Mapping | None = None
) -> GroupModel:
    """A saved model with the facts recorded at its training."""
    record = model_record(spark, name, root) if record is None else record
    pipeline, _ = load_stages(record, root)
    return GroupModel.restored(pipeline, record)
