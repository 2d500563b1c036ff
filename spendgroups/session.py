"""Session for local runs, and the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A list of this many narrow rows is small enough to be sent to every executor.
FEW_LISTED = 200_000


def local_session(cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("spendgroups")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary
    folder. On a cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root and root.startswith("file:") and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir names a folder of one machine")
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="spendgroups-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder, not yet created, under the shared root."""
    return f"{shared_root(spark)}/spendgroups/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``new_folder`` named and that nothing reads any more."""
    if f"{shared_root(spark)}/spendgroups/" not in f"{path}/":
        raise ValueError(f"not a folder of ours: {path}")
    remove_tree(spark, path)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that is in it, on whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, lineage cut."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, with its lineage cut."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_few(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df``, marked for broadcast if a count shows it to be small.

    Spark's own choice comes only after the large side of the join was shuffled.
    """
    limit = FEW_LISTED if limit is None else limit
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
