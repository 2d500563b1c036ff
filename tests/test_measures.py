import pytest

from spendgroups.operators import measures, quality
from spendgroups.session import new_folder, remove_tree

NAN = float("nan")
COLS = ["x", "y"]


@pytest.fixture
def places(spark):
    root = new_folder(spark, "measures-test")
    return f"{root}/rows", f"{root}/store"


def add(spark, folder, rows):
    table = spark.createDataFrame(rows, "x double, y int, s string").coalesce(1)
    table.write.mode("append").parquet(folder)


def read(spark, folder):
    return spark.read.schema("x double, y int, s string").parquet(folder)


def check(spark, folder, store):
    df = read(spark, folder)
    kept = measures.kept_overview(df, folder, store, COLS).first()
    full = quality.table_overview(df, COLS).first()
    assert (kept.n_rows, kept.missing) == (full.n_rows, full.missing)
    for ours, theirs in zip(kept.described, full.described, strict=True):
        assert tuple(ours) == pytest.approx(tuple(theirs), abs=1e-12, nan_ok=True)
    ours = {(r.a, r.b): r.r for r in kept.correlations}
    assert ours == pytest.approx({(r.a, r.b): r.r for r in full.correlations}, abs=1e-9)


def test_only_new_files_are_measured(spark, places):
    folder, store = places
    add(spark, folder, [(1e6 + 0.25, 3, "a"), (NAN, 5, None), (1e6 + 4.0, None, "b")])
    assert measures.measure_new_files(read(spark, folder), folder, store, COLS) == 1
    check(spark, folder, store)
    add(spark, folder, [(1e6 - 7.5, 1, "c"), (1e6 + 1.0, 9, "c"), (None, 2, "c")])
    add(spark, folder, [(1e6 + 3.0, 4, None)])
    assert measures.measure_new_files(read(spark, folder), folder, store, COLS) == 2
    assert measures.measure_new_files(read(spark, folder), folder, store, COLS) == 0
    check(spark, folder, store)
    # Other columns are measured on their own.
    assert measures.measure_new_files(read(spark, folder), folder, store, ["x"]) == 3


def test_replaced_and_doubly_measured_files(spark, places):
    folder, store = places
    add(spark, folder, [(1.0, 3, "a"), (2.0, 5, "a")])
    check(spark, folder, store)
    kept = spark.read.parquet(store).collect()
    spark.createDataFrame(kept, measures._STORE).write.mode("append").parquet(store)
    check(spark, folder, store)
    remove_tree(spark, folder)
    add(spark, folder, [(7.0, 1, None)])
    check(spark, folder, store)


def test_constant_empty_and_missing(spark, places):
    folder, store = places
    add(spark, folder, [])
    check(spark, folder, store)
    assert measures.measure_new_files(read(spark, folder), folder, store, COLS) == 0
    add(spark, folder, [(0.1, None, "a")] * 3)
    add(spark, folder, [(0.1, None, "a")] * 7)
    check(spark, folder, store)


def test_other_files_are_not_opened(spark, places):
    folder, store = places
    add(spark, folder, [(1.0, 3, "a")])
    measures.measure_new_files(read(spark, folder), folder, store, COLS)
    known = {row["file"] for row in measures.files_of(spark, folder).collect()}
    add(spark, folder, [(2.0, 4, "b")])
    (new,) = {row["file"] for row in measures.files_of(spark, folder).collect()} - known
    rows = read(spark, folder).where(f"_metadata.file_path = '{new}'")
    plan = rows._jdf.queryExecution()
    assert plan.toRdd().count() == 1
    scan = plan.executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1
