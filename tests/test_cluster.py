import os

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spendgroups import session
from spendgroups.operators import cluster as c
from spendgroups.operators import profile, scoring
from spendgroups.plans import fixtures
from spendgroups.sources import models

KNOWN = {0: (25, 20), 1: (25, 80), 2: (55, 50), 3: (88, 17), 4: (88, 82)}


@pytest.fixture(scope="module")
def blobs(spark, folder):
    return fixtures.blobs(spark, folder).cache()


@pytest.mark.parametrize("partitions", [1, 7])
def test_known_groups_are_found(blobs, partitions):
    model = c.fit_groups(blobs.repartition(partitions), 5)
    assert model.cost == pytest.approx(1.068102, abs=1e-6)
    assert [g["n_rows"] for g in model.groups] == [30] * 5
    for group in model.groups:
        income, score = KNOWN[group["group_id"]]
        assert group["mean_income"] == pytest.approx(income, abs=0.5)
        assert group["mean_score"] == pytest.approx(score, abs=3)


def test_every_row_counts(spark, blobs):
    """Repeated rows weigh as much as others, and no more rows are needed to see it."""
    many = blobs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40))))
    model = c.fit_groups(many, 5)
    assert [g["n_rows"] for g in model.groups] == [1200] * 5
    # The sample deviation shrinks a little as rows are repeated.
    assert model.cost == pytest.approx(40 * 1.068102 * (150 / 149) * (5999 / 6000), rel=1e-5)


def test_nan_does_not_reach_the_domain(spark):
    rows = [(float("nan"), 10.0, 10.0), (20.0, 90.0, 80.0), (41.0, 50.0, 70.0)]
    table = spark.createDataFrame(rows, "Age double, AnnualIncome double, SpendingScore double")
    assert c.fit_groups(table, 2).training_domain()["Age"] == (20.0, 41.0)


def test_what_a_fit_wrote_is_removed(spark, blobs, monkeypatch):
    folders = []
    monkeypatch.setattr(c, "remove_folder", lambda s, path: (folders.append(path), remove(s, path)))
    remove = session.remove_folder
    c.fit_groups(blobs, 5)
    c.elbow_sweep(blobs, [2, 3])
    assert len(folders) == 2 and not any(os.path.exists(f.removeprefix("file:")) for f in folders)
    with pytest.raises(ValueError):
        remove(spark, "/somewhere/else")


@pytest.mark.parametrize("k", [1, 11])
def test_k_is_checked(blobs, k):
    with pytest.raises(ValueError):
        c.fit_groups(blobs, k)
    with pytest.raises(ValueError):
        c.grouping_stages(k)


def test_fewer_points_than_k(customers):
    table = customers((20, 10, 10), (30, 10, 10), (40, 90, 90))
    model = c.fit_groups(table, 5)
    report = profile.group_report(c.assign_groups(table, model)).orderBy("group_id").collect()
    assert [(r.n_rows, r.strategy) for r in report] == [(2, "saver"), (1, "vip")]


def test_no_usable_row(customers):
    with pytest.raises(ValueError):
        c.fit_groups(customers((20, None, 10), (30, 5, float("nan"))), 2)


def test_constant_feature(customers):
    model = c.fit_groups(customers((20, 10, 50), (30, 90, 50), (40, 91, 50), (41, 9, 50)), 2)
    assert [g["n_rows"] for g in model.groups] == [2, 2]


def test_facts_kept_with_a_model(customers):
    model = c.fit_groups(customers((20, 10, 10), (None, 90, 80), (50, None, 70)), 2)
    assert model.n_rows == 2
    assert model.training_domain() == {
        "Age": (20.0, 20.0), "AnnualIncome": (10.0, 90.0), "SpendingScore": (10.0, 80.0)
    }
    assert model.scaling[0]["mean"] == 50.0
    assert model.scaling[0]["sd"] == pytest.approx(3200**0.5)


def test_plain_estimator(blobs):
    fitted = c.grouping_stages(5).fit(blobs)
    assert fitted.stages[-1].summary.trainingCost == pytest.approx(1.068102, abs=1e-6)


def test_scaled_features(blobs):
    scaled = Pipeline(stages=c.scaling_stages()).fit(blobs).transform(blobs)
    z = scaled.select(vector_to_array("features").alias("z"))
    row = z.agg(
        *[f(F.col("z")[i]) for i in (0, 1) for f in (F.avg, F.stddev_samp)]
    ).first()
    assert list(row) == pytest.approx([0, 1, 0, 1], abs=1e-9)


def test_elbow(blobs):
    costs = {r.k: r.cost for r in c.elbow_sweep(blobs).collect()}
    assert sorted(costs) == list(range(2, 11))
    assert costs[5] == pytest.approx(1.068102, abs=1e-6)
    assert costs[4] > 10 * costs[5]


def test_nearest_centre_prefers_the_lower_id(customers):
    near = c.nearest_centre(["AnnualIncome", "SpendingScore"], [(0, 0), (2, 0), (1, 5)])
    rows = customers((1, 1, 0), (1, 3, 0)).select(near.alias("n")).select("n.*").collect()
    assert [tuple(r) for r in rows] == [(1.0, 0), (1.0, 1)]


def test_profile_counts_ages_apart(customers):
    table = customers((20, 10, 10), (None, 20, 30)).withColumn("group_id", F.lit(0))
    assert tuple(profile.group_profile(table).first()) == (0, 2, 1, 15.0, 20.0)
    assert "n_age" not in profile.group_profile(table.drop("Age")).columns


def test_report_text(customers):
    table = customers((20, 80.04, 70), (30, 90, 80.5)).withColumn("group_id", F.lit(3))
    report = profile.report_text(profile.group_report(table))
    assert tuple(report.first()) == (3, "85.0", "75.3", "vip")


def test_scoring(customers, blobs):
    model = c.fit_groups(blobs, 5)
    table = customers((30, 90, 70), (30, 66, 50), (30, None, 50), (None, 20, 20))
    scored, rejects = scoring.score_customers(
        table, model, {"name": "m", "date": "2026-01-02 03:04:05"}
    )
    rows = scored.orderBy("CustomerID").collect()
    assert [r.CustomerID for r in rejects.collect()] == [2]
    assert [(r.group_id, r.group_strategy, r.customer_strategy) for r in rows] == [
        (4, "vip", "vip"), (2, "standard", "standard"), (0, "saver", "saver")
    ]
    assert rows[0].model_name == "m" and rows[0].model_date == "2026-01-02 03:04:05"
    bare = c.GroupModel(model.pipeline, 5)
    again = scoring.score_customers(table, bare)[0].orderBy("CustomerID").collect()
    assert [r.group_strategy for r in again] == ["vip", "standard", "saver"]


def test_starts_from_rows_do_not_depend_on_partitions(spark, folder):
    table = fixtures.loaded_profile(spark, folder)
    fits = [c.fit_groups(table.repartition(n), 4, start_from_rows=True) for n in (1, 2, 4, 7)]
    for fit in fits[1:]:
        assert [g["n_rows"] for g in fit.groups] == [g["n_rows"] for g in fits[0].groups]
        assert fit.cost == pytest.approx(fits[0].cost)
    # One different row gives one group.
    few = table.limit(1).unionByName(table.limit(1))
    assert len(c.fit_groups(few, 3, start_from_rows=True).groups) == 1


def test_model_from_row_starts_is_saved_and_loaded(spark, folder, tmp_path):
    blobs = fixtures.blobs(spark, folder)
    model = c.fit_groups(blobs, 5, start_from_rows=True)
    assert model.cost == pytest.approx(c.fit_groups(blobs, 5).cost)
    models.save_model(spark, model, "five", "notebook", str(tmp_path))
    loaded = models.load_model(spark, "five", str(tmp_path))
    assert sorted(map(tuple, loaded.centres())) == sorted(map(tuple, model.centres()))
    assert c.assign_groups(blobs, loaded).groupBy("group_id").count().count() == 5
