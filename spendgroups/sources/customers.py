"""Reading customer tables, and the saved customer list."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendgroups.functions.numbers import number
from spendgroups.schema import (
    AGE,
    COLUMN_TYPES,
    CUSTOMER_ID,
    HEADER_MAP,
    MISSING_WORDS,
    customer_schema,
)
from spendgroups.session import broadcast_if_few, checkpointed, stored
from spendgroups.sources import listed


def normalize_columns(df: DataFrame, names: Mapping[str, str] = HEADER_MAP) -> DataFrame:
    """Rename source headers; a header that is absent is passed over."""
    return df.withColumnsRenamed(dict(names))


def _loaded(df: DataFrame) -> DataFrame:
    """The one load rule: fixed types, NaN as NULL."""
    for name, kind in COLUMN_TYPES.items():
        if name in df.columns and isinstance(kind, (T.DoubleType, T.IntegerType)):
            df = df.withColumn(name, number(name).cast(kind))
    return df


def read_customers(
    spark: SparkSession,
    path: str,
    mode: str = "PERMISSIVE",
    text_ids: bool = False,
    keep_nan: bool = False,
) -> DataFrame:
    """Customer CSV with a header line.

    The header decides the order of the columns, the fixed schema their types.
    A cell that is unreadable or a word for a missing value becomes NULL, so that only
    its row is refused later. A line with too few or too many cells is filled up or cut
    in ``PERMISSIVE`` mode; in ``FAILFAST`` mode it fails the read. ``keep_nan`` leaves NaN
    in number columns in place, to be counted. A column not in the schema is kept as text.
    """
    header = spark.read.option("header", True).csv(path).columns
    fields = [T.StructField(name, T.StringType()) for name in header]
    table = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", mode)
        .csv(path)
    )
    table = normalize_columns(table)
    types = {f.name: f.dataType for f in customer_schema(text_ids)}
    types[AGE] = T.DoubleType()  # ages may be written as 25.0
    read = {}
    for name in table.columns:
        kind = types.get(name)
        if isinstance(kind, T.StringType):
            read[name] = F.when(~F.col(name).isin(*MISSING_WORDS), F.col(name))
        elif kind is not None:
            read[name] = F.col(name).try_cast(kind)
    table = table.withColumns(read) if read else table
    return table if keep_nan else _loaded(table)


def customers_from_rows(
    spark: SparkSession, rows: Iterable[tuple], text_ids: bool = False
) -> DataFrame:
    """A few rows from memory, in the order of the customer schema."""
    fixed = []
    for key, gender, age, income, score in rows:
        key = key if key is None else (str(key) if text_ids else int(key))
        amounts = (None if x is None else float(x) for x in (income, score))
        fixed.append((key, gender, age if age is None else int(age), *amounts))
    return _loaded(spark.createDataFrame(fixed, customer_schema(text_ids)))


def preview(df: DataFrame, key: str = CUSTOMER_ID, rows: int = 5) -> DataFrame:
    """The first rows by key."""
    return df.orderBy(key).limit(rows)


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Add the 0-based row number in file order to a table read from files.

    File order is file name, then place in the file. Only the row count of each
    block of a file is added up in one place, never rows. How files are cut into
    blocks depends on the cores at hand, so the blocks are counted on a written
    copy of the rows, and the rows are taken from the same copy.
    """
    placed = df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_start": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )
    placed = stored(placed, "placed")
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy("_file", "_start")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    )
    blocks = broadcast_if_few(checkpointed(blocks))
    return (
        placed.join(blocks, ["_file", "_start"])
        .withColumn(name, F.col("_row") - F.col("_first") + F.col("_before"))
        .select(*df.columns, name)
    )


def save_customer_list(
    spark: SparkSession, csv_path: str, root: str, text_ids: bool = False
) -> str:
    """Make a CSV the current customer list and return the path of its folder.

    The rows are kept with their positions in the file, laid out for lookups. A file whose
    lines do not fit its header raises and leaves the list before it in use; an
    unreadable cell is NULL in the list.
    """
    rows = read_customers(spark, csv_path, mode="FAILFAST", text_ids=text_ids)
    return listed.write_list(with_position(rows, listed.POSITION), root)


def load_customer_list(spark: SparkSession, root: str) -> DataFrame:
    """The customer list saved last."""
    rows = listed.list_rows(spark, listed.current_list(spark, root))
    return rows.drop(listed.POSITION, listed.BLOCK)


def current_customer_list(
    spark: SparkSession, root: str, csv_path: str | None = None, text_ids: bool = False
) -> DataFrame:
    """Save the CSV if one is given, else reuse the list saved before."""
    if csv_path is not None:
        save_customer_list(spark, csv_path, root, text_ids)
    return load_customer_list(spark, root)
