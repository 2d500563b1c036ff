import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendgroups.operators import distributions as d
from spendgroups.operators import quantiles as q
from spendgroups.operators import selection
from spendgroups.plans import fixtures

NAN = float("nan")


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(7)
    mixed = np.concatenate([rng.lognormal(3, 1, 300), np.full(200, 50.0), rng.uniform(0, 9, 77)])
    return mixed.round(3)


@pytest.fixture(scope="module")
def table(spark, values):
    rows = [(float(v), i % 3, float(i % 11)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "AnnualIncome double, g int, SpendingScore double")


@pytest.fixture(params=["one slice", "cut again", "cut again, many groups"])
def path(request, monkeypatch):
    if "cut" in request.param:
        monkeypatch.setattr(q, "SLICE_VALUES", 9)
        monkeypatch.setattr(q, "PIECES", 5)
    if "many" in request.param:
        monkeypatch.setattr(q, "FEW_GROUPS", 0)
    return request.param


@pytest.mark.parametrize("bins", [1, 7, 20, "auto"])
def test_histogram_equals_numpy(table, values, bins, path):
    rows = d.histogram(table, ["AnnualIncome"], bins).orderBy("bin").collect()
    n, edges = np.histogram(values, bins=bins)
    assert [r.n for r in rows] == n.tolist()
    assert [r.lo for r in rows] == pytest.approx(edges[:-1].tolist())
    assert [r.hi for r in rows] == pytest.approx(edges[1:].tolist())


@pytest.mark.parametrize("kind", ["int", "double"])
def test_histogram_of_whole_numbers(spark, kind):
    rng = np.random.default_rng(3)
    ages = np.minimum(rng.poisson(3, 4000), 9)
    table = spark.createDataFrame([(int(a),) for a in ages], "Age int")
    table = table.withColumn("Age", F.col("Age").cast(kind))
    rows = d.histogram(table, ["Age"], "auto").orderBy("bin").collect()
    assert [r.n for r in rows] == np.histogram(ages, bins="auto")[0].tolist()


def test_histogram_on_edges(spark):
    marks = [i / 10 for i in range(11)] * 3
    table = spark.createDataFrame([(m,) for m in marks], "x double")
    rows = d.histogram(table, ["x"], 10).orderBy("bin").collect()
    assert [r.n for r in rows] == np.histogram(marks, bins=10)[0].tolist()


def test_constant_column_is_one_bin(customers):
    table = customers((30, 5, 5), (30, 9, NAN))
    rows = d.histogram(table, ["Age"]).collect()
    assert [tuple(r) for r in rows] == [("Age", 0, 30.0, 30.0, 2)]
    assert d.histogram(table, ["Age"], "auto").count() == 1
    assert d.density_curve(table, ["Age"]).count() == 0


def test_density_equals_direct_sum(table, values, path):
    rows = d.density_curve(table, ["AnnualIncome"]).orderBy("point").collect()
    x = np.linspace(values.min(), values.max(), 200)
    width = values.std(ddof=1) * len(values) ** -0.2
    u = (x[:, None] - values[None, :]) / width
    density = np.exp(-u * u / 2).sum(axis=1) / (len(values) * width * np.sqrt(2 * np.pi))
    assert [r.x for r in rows] == pytest.approx(x.tolist())
    assert [r.density for r in rows] == pytest.approx(density.tolist(), rel=1e-9, abs=1e-15)
    height = density * len(values) * (values.max() - values.min()) / 20
    assert [r.height for r in rows] == pytest.approx(height.tolist(), rel=1e-9, abs=1e-12)


def test_density_lists_points_no_value_reaches(spark, path):
    rows = [(float(i % 5),) for i in range(3000)] + [(1e6,)]
    curve = d.density_curve(spark.createDataFrame(rows, "x double"), ["x"]).collect()
    assert len(curve) == 200


def test_grain_bounds_the_values(table):
    counts = q.count_values(table, ["AnnualIncome"], grain=10.0)
    assert counts.size < 40
    assert counts.table.agg(F.sum("n")).first()[0] == table.count()


@pytest.mark.parametrize("probs", [[0.25, 0.5, 0.75], [0.0, 1.0], [0.111, 0.9]])
def test_quantiles_equal_numpy(table, values, path, probs):
    counts = q.count_values(table, ["AnnualIncome"])
    row = q.exact_quantiles(counts, {f"p{i}": p for i, p in enumerate(probs)}).first()
    assert list(row)[2:] == pytest.approx(np.quantile(values, probs).tolist())
    assert row.total == len(values)


def test_quantiles_by_group(table, values, path):
    counts = q.count_values(table, ["AnnualIncome"], by="g")
    found = {r.g: r.m for r in q.exact_quantiles(counts, {"m": 0.5}).collect()}
    assert found == {g: pytest.approx(np.median(values[g::3])) for g in range(3)}


def whiskers(values):
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    kept = values[(values >= low) & (values <= high)]
    return q1, median, q3, min(kept.min(), q1), max(kept.max(), q3), len(values) - len(kept)


def test_boxes(table, values, path):
    row = d.box_stats(table, ["AnnualIncome"]).first()
    assert list(row)[1:] == pytest.approx([len(values), *whiskers(values)])
    for row in d.box_stats(table, ["AnnualIncome"], by="g").collect():
        assert list(row)[3:] == pytest.approx(list(whiskers(values[row.g :: 3])))


def test_outliers_are_rows(table, values, path):
    n_out = whiskers(values)[-1]
    found = d.box_outliers(table, ["AnnualIncome"], keep=["SpendingScore"])
    assert found.columns == ["SpendingScore", "column", "value"]
    assert found.count() == n_out
    by_group = d.box_outliers(table, ["AnnualIncome"], by="g")
    assert by_group.count() == sum(whiskers(values[g::3])[-1] for g in range(3))


def test_single_row_and_empty(customers, path):
    one = customers((30, 5, 5))
    assert tuple(d.box_stats(one, ["Age"]).first()) == ("Age", 1, 30.0, 30.0, 30.0, 30.0, 30.0, 0)
    empty = one.where("false")
    assert d.box_stats(empty).count() == 0
    assert d.histogram(empty).count() == 0
    assert d.density_curve(one).count() == 0


def test_counts_and_grid(customers):
    table = customers((30, 5.5, 5), (31, 5.1, 5), (32, NAN, 5), (33, 7, None))
    assert [tuple(r) for r in d.count_by(table, "Gender").collect()] == [("Male", 4)]
    assert [tuple(r) for r in d.point_grid(table).collect()] == [(5, 5, 2)]
    assert d.point_grid(table, by="Gender", width=2.0).first().x_bin == 2


def test_pyramid_levels_equal_grids_of_their_width(table):
    cols = ("AnnualIncome", "AnnualIncome", "g")
    found = d.point_pyramid(table, *cols, width=0.5, factors=(1, 3, 8))
    rows = sorted(map(repr, map(tuple, found.collect())))
    wanted = [(f, *r) for f in (1, 3, 8) for r in d.point_grid(table, *cols, width=0.5 * f).collect()]
    assert rows == sorted(map(repr, wanted))
    fresh = d.point_pyramid(table, *cols)._jdf.queryExecution().executedPlan().toString()
    assert fresh.count("Scan") == 1


def test_density_of_outliers_copies_and_shifted_values(spark, path):
    rng = np.random.default_rng(3)
    sets = {
        "tails": np.r_[rng.normal(size=2000), 400.0, -900.0],
        "far": 1e9 + rng.integers(0, 7, 3000),
        "two": np.r_[np.zeros(900), 1.0],
    }
    for values in sets.values():
        frame = spark.createDataFrame([(float(v),) for v in values], "x double")
        rows = d.density_curve(frame, ["x"]).orderBy("point").collect()
        x = np.linspace(values.min(), values.max(), 200)
        width = values.std(ddof=1) * len(values) ** -0.2
        scale = len(values) * width * np.sqrt(2 * np.pi)
        u = (x[:, None] - values[None, :]) / width
        wanted = np.exp(-u * u / 2).sum(axis=1) / scale
        found = np.array([r.density for r in rows])
        assert np.abs(found - wanted).max() * scale < 1e-9 * len(values)
        assert found.min() > -1e-15 / width


def test_no_cross_join_or_driver_rows(table, path):
    cols = ["AnnualIncome", "SpendingScore"]
    frames = [d.box_stats(table, cols, by="g"), d.density_curve(table, cols)]
    for frame in [*frames, d.histogram(table, cols, "auto")]:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_histogram_shuffles_bins_not_values(table):
    plan = d.histogram(table, ["AnnualIncome"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "value" not in [
        part for line in plan.split("\n") if "hashpartitioning" in line for part in line.split("#")
    ]


def _bits(x):
    bits = struct.unpack("q", struct.pack("d", abs(x)))[0]
    return -bits if x < 0 else bits


def test_ordered_bits(spark):
    rng = random.Random(4)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1e-310]
    values += [1.7976931348623157e308, float("inf"), -float("inf"), 0.1, 3.0]
    values += [2.0**e * m for e in range(-1022, 1024, 7) for m in (1.0, 1 + 2**-52, 1 - 2**-53)]
    values += [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values = [x for x in values if x == x]
    table = spark.createDataFrame([(x,) for x in values], "value double")
    rows = selection.with_ordered_bits(table, "value", "bits").collect()
    assert [r for r in rows if r.bits != _bits(r.value)] == []


@pytest.mark.parametrize("kind", ["whole", "wide", "equal", "signs"])
def test_quantiles_by_digits_equal_exact_ones(spark, kind):
    rng = random.Random(6)
    draw = {
        "whole": lambda: float(rng.randint(-5, 60)),
        "wide": lambda: rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300),
        "equal": lambda: 7.25,
        "signs": lambda: rng.choice([0.0, -0.0, 1e-320, -1e-320, 1e9 + rng.random()]),
    }[kind]
    rows = [(draw(), draw() if i % 5 else None, rng.choice("aab")) for i in range(900)]
    rows += [(1.0, 2.0, None), (None, None, "c"), (3.5, float("nan"), "d")]
    table = spark.createDataFrame(rows, "x double, y double, g string")
    probs = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "high": 1.0}
    for by in (None, "g"):
        one = q.count_values(table, ["x", "y"], by).quantiles(probs)
        two = selection.value_rows(table, ["x", "y"], by).quantiles(probs)
        assert one.columns == two.columns
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    empty = selection.value_rows(table.limit(0), ["x"]).quantiles(probs)
    assert empty.count() == 0


def test_boxes_from_rows_equal_boxes_from_counts(spark, folder):
    dirty = fixtures.profile_dirty(spark, folder)
    one = d.box_stats(dirty).collect()
    two = d.box_stats(dirty, counts=selection.value_rows(dirty)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
