"""Hand-over of intermediate tables through the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgroups.session import new_folder, remove_folder

_ROOT = str(Path(__file__).resolve().parents[2])
# Whether the shuffle files of a query go when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written in here leaves no shuffle files; else they stay until the driver
    happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage, so that a lost executor costs no more than its own tasks,
    and leaves a table with statistics that several readers can use. Shuffle files of the
    write are removed.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def released(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote and that nothing reads any more."""
    for df in tables:
        for path in {file.rpartition("/")[0] for file in df.inputFiles()}:
            remove_folder(df.sparkSession, path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where it is.

    Workers of a cluster have it installed, or get it with ``--py-files``.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([*filter(None, paths), _ROOT])


def doc_key(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text; an id that is NULL counts as empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until the table has no such column."""
    taken = {name.lower() for name in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free
