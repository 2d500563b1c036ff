"""Measures of a table kept file by file, so that an added file needs only its own scan.

What is kept of a file are counts, means and sums of products around the means; they add
up to the same overview as a scan of all rows, without the loss of digits that plain sums
of squares would bring.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgroups.functions.numbers import number
from spendgroups.operators.quality import missing_cells
from spendgroups.schema import NUMERIC
from spendgroups.session import broadcast_if_few, stored

FILE = ["file", "bytes", "changed"]
_STORE = (
    "file string, bytes bigint, changed timestamp, of string, n_rows bigint, "
    "missing array<struct<column: string, n_missing: bigint>>, "
    "moments array<struct<a: string, b: string, n: bigint, mean_a: double, mean_b: double, "
    "aa: double, bb: double, ab: double, "
    "lo_a: double, hi_a: double, lo_b: double, hi_b: double>>"
)


def _file() -> list[Column]:
    about = ("file_path", "file_size", "file_modification_time")
    return [F.col(f"_metadata.{a}").alias(name) for a, name in zip(about, FILE)]


def _moments(first: str, second: str) -> Column:
    """What is kept of the rows that have both values."""
    both = number(first).isNotNull() & number(second).isNotNull()
    a, b = (F.when(both, number(c)) for c in (first, second))
    n = F.count(a)
    return F.struct(
        F.lit(first).alias("a"),
        F.lit(second).alias("b"),
        n.alias("n"),
        F.avg(a).alias("mean_a"),
        F.avg(b).alias("mean_b"),
        (F.var_pop(a) * n).alias("aa"),
        (F.var_pop(b) * n).alias("bb"),
        (F.covar_pop(a, b) * n).alias("ab"),
        F.min(a).alias("lo_a"),
        F.max(a).alias("hi_a"),
        F.min(b).alias("lo_b"),
        F.max(b).alias("hi_b"),
    )


def _measured(df: DataFrame, cols: Sequence[str]) -> str:
    """Names what is kept: measures of other columns or types are not mixed with it."""
    return f"{df.schema.simpleString()} {','.join(cols)}"


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """``file, bytes, changed`` of the files under a folder; no file is opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return listing.load(folder).select(*_file())


def _kept(spark: SparkSession, store: str, of: str) -> DataFrame:
    """One row for each measured file, though two runs may have measured it."""
    try:
        kept = spark.read.schema(_STORE).parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = spark.createDataFrame([], _STORE)
    return kept.where(F.col("of") == of).dropDuplicates(FILE)


def measure_new_files(
    df: DataFrame, folder: str, store: str, cols: Sequence[str] = NUMERIC
) -> int:
    """Measure the files of ``df`` under ``folder`` that ``store`` lacks; how many they were.

    ``df`` is read from all files under ``folder``, row by row: columns may be renamed or
    cast, but rows of different files must not be joined. A file is known by path, size and
    time of change, so one that was replaced is measured again.
    """
    spark, of = df.sparkSession, _measured(df, cols)
    files = files_of(spark, folder)
    new = stored(files.join(_kept(spark, store, of), FILE, "left_anti"), "new-files")
    count = new.count()
    if count == 0:
        return 0
    rows = df.withColumns(dict(zip([f"_{name}" for name in FILE], _file())))
    names = new.select("file").limit(10_001).collect()
    if len(names) <= 10_000:
        # A filter on the path itself keeps Spark from opening the other files.
        rows = rows.where(F.col("_metadata.file_path").isin([name["file"] for name in names]))
    else:
        wanted = new.select("file").withColumnRenamed("file", "_file")
        rows = rows.join(broadcast_if_few(wanted), "_file", "left_semi")
    entries = {
        "missing": [missing_cells(field) for field in df.schema],
        "moments": [_moments(a, b) for a, b in combinations_with_replacement(cols, 2)],
    }
    flat = [e.alias(f"{part}_{i}") for part in entries for i, e in enumerate(entries[part])]
    folded = rows.groupBy(*[F.col(f"_{name}").alias(name) for name in FILE]).agg(
        F.count(F.lit(1)).alias("n_rows"), *flat
    )
    arrays = [
        F.array(*[f"{part}_{i}" for i in range(len(entries[part]))]).alias(part) for part in entries
    ]
    measured = folded.select(*FILE, F.lit(of).alias("of"), "n_rows", *arrays)
    # A file without rows is measured too.
    measured = new.join(measured, FILE, "left").fillna({"n_rows": 0, "of": of})
    fields = spark.createDataFrame([], _STORE).schema
    measured = measured.select([F.col(f.name).cast(f.dataType) for f in fields])
    measured.write.mode("append").parquet(store)
    return count


def _merged(moments: DataFrame) -> DataFrame:
    """One row for each pair of columns from one for each pair and file."""
    n = F.col("n")
    totals = moments.groupBy("a", "b").agg(
        F.sum(n).alias("total"),
        (F.sum(n * F.col("mean_a")) / F.nullif(F.sum(n), F.lit(0))).alias("all_a"),
        (F.sum(n * F.col("mean_b")) / F.nullif(F.sum(n), F.lit(0))).alias("all_b"),
    )
    # As many rows as pairs of columns.
    far = moments.join(F.broadcast(totals), ["a", "b"])
    a, b = F.col("mean_a") - F.col("all_a"), F.col("mean_b") - F.col("all_b")
    return far.groupBy("a", "b").agg(
        F.first("total").alias("n"),
        F.first("all_a").alias("mean"),
        F.sum(F.col("aa") + n * a * a).alias("aa"),
        F.sum(F.col("bb") + n * b * b).alias("bb"),
        F.sum(F.col("ab") + n * a * b).alias("ab"),
        F.min("lo_a").alias("lo_a"),
        F.max("hi_a").alias("hi_a"),
        F.min("lo_b").alias("lo_b"),
        F.max("hi_b").alias("hi_b"),
    )


def kept_overview(
    df: DataFrame, folder: str, store: str, cols: Sequence[str] = NUMERIC
) -> DataFrame:
    """The overview of a table from the kept measures, after measuring what is new.

    The same row as ``table_overview`` gives: ``n_rows``, ``missing``, ``described``,
    ``correlations``. Files that are gone or were replaced do not count. No rows at all
    give counts of 0 and no measures.
    """
    spark = df.sparkSession
    measure_new_files(df, folder, store, cols)
    kept = _kept(spark, store, _measured(df, cols))
    kept = stored(kept.join(files_of(spark, folder), FILE, "left_semi"), "measures")
    missing = kept.select(F.inline("missing")).groupBy("column").agg(F.sum("n_missing").alias("n"))
    pairs = _merged(kept.select(F.inline("moments")))
    # One row for each column or pair of columns; their order is that of the columns.
    absent = {row["column"]: row["n"] for row in missing.collect()}
    found = {(row["a"], row["b"]): row for row in pairs.collect()}
    n_rows = kept.agg(F.sum("n_rows")).first()[0] or 0

    def described(c: str) -> tuple:
        row = found.get((c, c))
        if row is None or not row["n"]:
            return c, 0, None, None, None, None
        spread = 0.0 if row["lo_a"] == row["hi_a"] else row["aa"]
        sd = (spread / (row["n"] - 1)) ** 0.5 if row["n"] > 1 else None
        return c, row["n"], row["mean"], sd, row["lo_a"], row["hi_a"]

    def correlations() -> list[tuple]:
        """Without a value where a column does not vary, as in ``correlation``."""
        out = []
        for a, b in combinations_with_replacement(cols, 2):
            row = found.get((a, b))
            varies = row is not None and row["n"] and row["lo_a"] < row["hi_a"]
            if not varies or not row["lo_b"] < row["hi_b"]:
                r = None
            else:
                r = 1.0 if a == b else row["ab"] / (row["aa"] * row["bb"]) ** 0.5
            out += [(a, b, r)] if a == b else [(a, b, r), (b, a, r)]
        return out

    facts = (
        n_rows,
        [(c, absent.get(c, 0)) for c in df.columns],
        [described(c) for c in cols],
        correlations(),
    )
    return spark.createDataFrame(
        [facts],
        "n_rows bigint, missing array<struct<column: string, n_missing: bigint>>, "
        "described array<struct<column: string, n: bigint, mean: double, sd: double, "
        "min: double, max: double>>, "
        "correlations array<struct<a: string, b: string, r: double>>",
    )
