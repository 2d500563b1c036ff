import pandas as pd
import pytest
from pyspark.sql import functions as F

from spendgroups import session
from spendgroups.operators import quality
from spendgroups.schema import NUMERIC

NAN = float("nan")


def by_column(df):
    return {row["column"]: row for row in df.collect()}


def test_missing_counts_null_and_nan(spark):
    table = spark.createDataFrame(
        [(1, "a", NAN), (None, None, None), (3, "NaN", 1.0)], "i int, s string, d double"
    )
    found = by_column(quality.missing_counts(table))
    assert {c: r.n_missing for c, r in found.items()} == {"i": 1, "s": 1, "d": 2}


def test_duplicates_treat_nan_and_null_as_equal(spark):
    rows = [(1, NAN), (1, NAN), (1, None), (1, None), (1, None), (2, 0.0)]
    table = spark.createDataFrame(rows, "i int, d double")
    assert tuple(quality.duplicate_count(table).first()) == (6, 3)


def test_duplicates_are_compared_cell_by_cell(spark, monkeypatch):
    rows = [(None, "a", {1: 2}), ("a", None, {1: 2}), ("a", None, {1: 2}), ("a", None, {1: 3})]
    table = spark.createDataFrame(rows, "`a.b` string, _address string, m map<int, int>")
    assert tuple(quality.duplicate_count(table).first()) == (4, 1)
    # Addresses that all clash cost time, never a row.
    monkeypatch.setattr(quality, "row_address", lambda df: F.struct(F.lit(1).alias("high")))
    assert tuple(quality.duplicate_count(table).first()) == (4, 1)
    monkeypatch.setattr(session, "FEW_LISTED", 0)
    assert tuple(quality.duplicate_count(table).first()) == (4, 1)


def test_only_repeated_rows_are_shuffled(spark):
    texts = spark.range(1000).select("id", F.repeat(F.lit("long"), 50).alias("text"))
    plan = quality.duplicate_count(texts)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan
    twice = texts.unionByName(texts.where("id < 3"))
    assert tuple(quality.duplicate_count(twice).first()) == (1003, 3)


def test_empty_table(customers):
    empty = customers((1, 1, 1)).where("false")
    assert tuple(quality.duplicate_count(empty).first()) == (0, 0)
    assert {r.n for r in quality.describe_numeric(empty).collect()} == {0}
    assert {r.r for r in quality.correlation(empty).collect()} == {None}
    assert {r.n_missing for r in quality.missing_counts(empty).collect()} == {0}


def test_describe_skips_nan(customers):
    found = by_column(quality.describe_numeric(customers((20, NAN, 1), (30, 10, None), (None, 20, 4))))
    assert tuple(found["Age"]) == ("Age", 2, 25.0, pytest.approx(50**0.5), 20.0, 30.0)
    assert found["AnnualIncome"]["mean"] == 15.0
    assert found["SpendingScore"]["n"] == 2


def test_correlation_equals_pandas(customers):
    rows = [(20, 5, 1), (25, 9, None), (31, NAN, 7), (None, 30, 4), (44, 12, 9), (50, 3, 2)]
    expected = pd.DataFrame(rows, columns=list(NUMERIC)).astype(float).corr()
    for row in quality.correlation(customers(*rows)).collect():
        assert row.r == pytest.approx(expected.loc[row.a, row.b])


def test_constant_column_has_no_correlation(customers):
    matrix = quality.correlation(customers((20, 5, 1), (20, 9, 3), (20, 7, 4)))
    found = {(r.a, r.b): r.r for r in matrix.collect()}
    assert found["Age", "Age"] is None and found["Age", "AnnualIncome"] is None
    assert found["AnnualIncome", "AnnualIncome"] == 1.0


def test_overview_agrees_with_its_parts(customers):
    table = customers((20, NAN, 1), (30, 10, None), (None, 20, 4))
    row = quality.table_overview(table).first()
    assert row.n_rows == 3
    assert row.missing == quality.missing_counts(table).collect()
    assert row.described == quality.describe_numeric(table).collect()
    assert row.correlations == quality.correlation(table).collect()


def test_domain(customers):
    found = by_column(quality.training_domain(customers((20, NAN, 1), (30, 10, 7))))
    assert tuple(found["AnnualIncome"])[1:] == (10.0, 10.0)
    assert tuple(found["SpendingScore"])[1:] == (1.0, 7.0)


def test_overview_is_one_scan(spark, folder):
    table = spark.read.parquet(f"{folder}/customer.parquet").selectExpr(
        "c_custkey AS CustomerID", "c_nationkey AS Age", "c_acctbal AS AnnualIncome",
        "c_acctbal AS SpendingScore",
    )
    plan = quality.table_overview(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "c_name" not in plan and "c_mktsegment" not in plan
