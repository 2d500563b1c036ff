"""Customer lists kept for lookups: rows laid out by position, and an index by id.

Rows lie in folders of a fixed number of positions each, in order, so a lookup reads the
folders, and in them the row groups, that may hold what is asked for. The index has one
row for each id, in folders by a hash of the id, and says where the id stands first.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendgroups.schema import CUSTOMER_ID
from spendgroups.session import broadcast_if_few, remove_tree, stored
from spendgroups.sources import commits

BLOCK_ROWS = 1 << 20
POSITION, BLOCK, BUCKET, FIRST = "_position", "_block", "_bucket", "_first"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(CUSTOMER_ID), F.lit(buckets)).cast("int")


def write_list(rows: DataFrame, root: str, block_rows: int = BLOCK_ROWS) -> str:
    """Write rows that have their ``_position`` as the current list under ``root``.

    The list gets folders of its own and is published by a numbered record after the
    write, so a write that fails leaves the list before it in use.
    """
    spark = rows.sparkSession
    path = f"{root}/customer_list/{uuid.uuid4().hex}"
    block = F.floor(F.col(POSITION) / block_rows).cast("int")
    placed = rows.withColumn(BLOCK, block).sortWithinPartitions(BLOCK, POSITION)
    placed.write.partitionBy(BLOCK).parquet(f"{path}/rows")
    written = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    count = written.count()
    buckets = max(1, -(-count // block_rows))
    if CUSTOMER_ID in rows.columns:
        # Equal ids are one row before they are shuffled.
        index = written.where(F.col(CUSTOMER_ID).isNotNull()).groupBy(CUSTOMER_ID)
        index = index.agg(F.min(POSITION).alias(FIRST), F.count(F.lit(1)).alias("n"))
        index = index.withColumn(BUCKET, _bucket(buckets)).repartition(BUCKET)
        index = index.sortWithinPartitions(BUCKET, CUSTOMER_ID)
        index.write.partitionBy(BUCKET).parquet(f"{path}/ids")
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    record = {
        "path": path,
        "date": datetime.now(zone).strftime("%Y-%m-%d %H:%M:%S"),
        "schema": placed.schema.jsonValue(),
        "n_rows": count,
        "block_rows": block_rows,
        "buckets": buckets,
    }
    commits.publish(spark, f"{root}/customer_list_index", record)
    return path


def current_list(spark: SparkSession, root: str) -> dict[str, Any]:
    """The record of the list published last."""
    record = commits.current(spark, f"{root}/customer_list_index")
    if record is None:
        raise FileNotFoundError(f"no customer list saved under {root}")
    return record


def list_rows(spark: SparkSession, record: dict[str, Any]) -> DataFrame:
    """The rows of a list with ``_position`` and ``_block``."""
    schema = T.StructType.fromJson(record["schema"])
    return spark.read.schema(schema).parquet(f"{record['path']}/rows")


def list_schema(spark: SparkSession, root: str) -> DataFrame:
    """``column, type`` of the current list, in order."""
    schema = T.StructType.fromJson(current_list(spark, root)["schema"])
    fields = [(f.name, f.dataType.simpleString()) for f in schema if f.name not in (POSITION, BLOCK)]
    return spark.createDataFrame(fields, "column string, type string")


def lookup_listed_positions(
    spark: SparkSession, root: str, positions: DataFrame, position: str = "position"
) -> DataFrame:
    """Rows of the current list at the 0-based ``positions``, with that column.

    Only the folders and row groups are read that may hold one of them. Positions that are
    NULL, repeated or not in the list are passed over.
    """
    return _at_positions(spark, current_list(spark, root), positions, position)


def _at_positions(
    spark: SparkSession, record: dict[str, Any], positions: DataFrame, name: str
) -> DataFrame:
    asked = positions.select(F.col(name).cast("bigint").alias(POSITION)).distinct()
    asked = stored(asked.where(F.col(POSITION).between(0, record["n_rows"] - 1)), "positions")
    ends = asked.agg(F.min(POSITION).alias("lo"), F.max(POSITION).alias("hi")).first()
    rows = list_rows(spark, record)
    if ends["lo"] is None:
        return rows.where("false").withColumnRenamed(POSITION, name).drop(BLOCK)
    block = F.floor(F.col(POSITION) / record["block_rows"]).cast("int")
    # The filter tells Spark that the list is worth pruning by.
    asked = asked.withColumn(BLOCK, block).where(F.col(POSITION) >= ends["lo"])
    held = rows.where(F.col(POSITION).between(ends["lo"], ends["hi"]))
    found = held.join(broadcast_if_few(asked), [BLOCK, POSITION], "left_semi")
    return found.withColumnRenamed(POSITION, name).drop(BLOCK)


def lookup_listed_ids(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """Rows of the current list with the listed ids; of rows with one id the first.

    The index tells where the ids stand, so neither it nor the list is read as a whole.
    """
    record = current_list(spark, root)
    schema = T.StructType.fromJson(record["schema"])
    if CUSTOMER_ID not in schema.names:
        raise ValueError(f"the list under {root} has no {CUSTOMER_ID}")
    kind = schema[CUSTOMER_ID].dataType
    asked = stored(ids.select(F.col(CUSTOMER_ID).cast(kind)).distinct().dropna(), "ids")
    asked = asked.withColumn(BUCKET, _bucket(record["buckets"]))
    asked = asked.where(F.col(BUCKET) >= 0)
    fields = T.StructType().add(CUSTOMER_ID, kind)
    fields = fields.add(FIRST, T.LongType()).add(BUCKET, T.IntegerType())
    index = spark.read.schema(fields).parquet(f"{record['path']}/ids")
    found = index.join(broadcast_if_few(asked), [BUCKET, CUSTOMER_ID], "left_semi")
    return _at_positions(spark, record, found.select(FIRST), FIRST).drop(FIRST)


def drop_old_lists(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` lists and return how many went.

    Queries that still read an older list fail; keep as many as may be in use.
    """
    if keep < 1:
        raise ValueError("the current list stays")
    index = f"{root}/customer_list_index"
    old = list(commits.published(spark, index))[keep:]
    for number, record in old:
        # The record goes first, so that none ever names a list that is not there.
        commits.retract(spark, index, number)
        remove_tree(spark, record["path"])
    return len(old)
