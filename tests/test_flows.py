import pytest
from pyspark.sql import functions as F

from spendgroups import session
from spendgroups.operators import columns, distributions, quality
from spendgroups.plans import fixtures, flows


def test_explore(spark, folder):
    tables = flows.explore(fixtures.loaded_profile(spark, folder))
    assert tables["overview"].first().n_rows == 150
    assert tables["histogram"].agg(F.sum("n")).first()[0] == 450
    assert tables["density"].count() == 600
    assert tables["boxes"].count() == 3
    assert tables["points_by_gender"].agg(F.sum("n")).first()[0] == 150
    assert all(table.columns for table in tables.values())


def test_explore_takes_shared_tables_once(spark, folder):
    table = fixtures.loaded_profile(spark, folder)
    tables = flows.explore(table)
    for name, alone in {
        "correlation": quality.correlation(table),
        "points": distributions.point_grid(table),
    }.items():
        assert sorted(tables[name].collect()) == sorted(alone.collect())
        plan = tables[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "o_custkey" not in plan and "c_custkey" not in plan


def test_score_raw_cells(spark, folder, tmp_path):
    flows.train(fixtures.blobs(spark, folder), "five", str(tmp_path))
    cells = [
        ("1", "30", "88", True), ("2", "31.7", "?", False), ("3", "40", "?", True),
        ("x4", "40", "88", True), ("5", None, "88", True),
    ]
    raw = spark.createDataFrame(
        cells, "CustomerID string, Age string, AnnualIncome string, given boolean"
    )
    flags = {"AnnualIncome": "given"}
    scored, rejects = flows.score(spark, raw, "five", str(tmp_path), flags, raw=True)
    assert sorted((r.CustomerID, r.Age, r.AnnualIncome, r.SpendingScore) for r in scored.collect()) == [
        (1, 30, 88.0, 50.0), (2, 31, 60.0, 50.0)
    ]
    assert {r.CustomerID: r.faults for r in rejects.collect()} == {
        "3": ["AnnualIncome"], "x4": ["CustomerID"], "5": ["Age"]
    }
    named, none = flows.score(spark, raw.limit(0), "five", str(tmp_path), raw=True, text_ids=True)
    assert named.count() == none.count() == 0


def test_explore_with_few_columns(spark, folder):
    tables = flows.explore(fixtures.loaded_profile(spark, folder).drop("Gender", "Age"))
    assert tables["boxes"].count() == 2 and "genders" not in tables


def test_train_then_score(spark, folder, tmp_path):
    blobs = fixtures.blobs(spark, folder)
    result = flows.train(blobs, "five", str(tmp_path))
    assert [r.n for r in result.sizes().collect()] == [30] * 5
    assert result.boxes().count() == 10
    assert result.points().agg(F.sum("n")).first()[0] == 150
    assert result.report.agg(F.sum("n_rows")).first()[0] == 150
    assert result.rejects.count() == 0
    table = fixtures.profile_dirty(spark, folder)
    dirty = flows.train(table, "dirty", str(tmp_path), k=3)
    assert dirty.grouped.count() + dirty.rejects.count() == table.count()
    scored, rejects = flows.score(spark, table, "five", str(tmp_path))
    assert scored.count() + rejects.count() == table.count()
    assert scored.where(F.size("warnings") > 0).count() > 0
    bare, none = flows.score(spark, blobs.drop("SpendingScore"), "five", str(tmp_path))
    assert {r.SpendingScore for r in bare.collect()} == {50.0} and none.count() == 0
    odd = blobs.withColumns({"SpendingScore": F.lit(900.0), "given": F.col("CustomerID") % 2 == 0})
    flags = {"SpendingScore": "given"}
    flagged, _ = flows.score(spark, odd, "five", str(tmp_path), flags)
    warned = F.exists("warnings", lambda w: w.startswith("SpendingScore"))
    wrong = F.when(F.col("given"), (F.col("SpendingScore") != 900) | ~warned).otherwise(
        (F.col("SpendingScore") != 50) | warned
    )
    assert flagged.where(wrong).count() == 0


@pytest.mark.parametrize("limit", [0, 1000])
def test_lists_are_broadcast_only_if_few(spark, folder, monkeypatch, limit):
    monkeypatch.setattr(session, "FEW_LISTED", limit)
    ids = spark.range(100).withColumnRenamed("id", "CustomerID")
    table = spark.range(0, 10_000, 7).withColumnRenamed("id", "CustomerID")
    found = columns.lookup_ids(table, ids)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("broadcast" in plan) == (limit > 0)
    assert found.count() == 15
