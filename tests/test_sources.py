import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from spendgroups import session
from spendgroups.operators import columns
from spendgroups.operators.cluster import assign_groups, fit_groups
from spendgroups.plans import fixtures
from spendgroups.schema import DEFAULTS, DISPLAY_DEFAULTS, customer_schema
from spendgroups.sources import customers as src
from spendgroups.sources import commits, listed, models

HEADER = "CustomerID,Gender,Age,Annual Income (k$),Spending Score (1-100)\n"


@pytest.fixture
def write(tmp_path):
    def save(text, name="in.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return save


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_csv_types_and_empty_cells(spark, write):
    table = src.read_customers(spark, write(HEADER + "1,Male,19,15,39\n2,,,16.5,\n3,Male,25.0,NaN,6\n"))
    assert table.schema == customer_schema()
    assert rows(table) == [
        (1, "Male", 19, 15.0, 39.0), (2, None, None, 16.5, None), (3, "Male", 25, None, 6.0)
    ]


def test_csv_keeps_nan_when_asked(spark, write):
    table = src.read_customers(spark, write(HEADER + "3,Male,25,NaN,6\n"), keep_nan=True)
    assert table.where(F.isnan("AnnualIncome")).count() == 1


def test_csv_column_order_and_missing_id(spark, write):
    text = "Spending Score (1-100),Age,Annual Income (k$),Note\n39,19,15,x\n"
    table = src.read_customers(spark, write(text))
    assert table.columns == ["SpendingScore", "Age", "AnnualIncome", "Note"]
    assert rows(table) == [(39.0, 19, 15.0, "x")]


def test_csv_text_ids_and_modes(spark, write):
    path = write(HEADER + "A7,Male,19,15,39\n")
    assert rows(src.read_customers(spark, path, text_ids=True))[0][0] == "A7"
    assert rows(src.read_customers(spark, path))[0][0] is None
    assert rows(src.read_customers(spark, path, mode="FAILFAST"))[0][0] is None
    for line in ("1,Male,19\n", "1,Male,19,15,39,7\n"):
        short = write(HEADER + line, f"cells{len(line)}.csv")
        assert src.read_customers(spark, short).count() == 1
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ|malformed"):
            src.read_customers(spark, short, mode="FAILFAST").collect()


def test_csv_words_for_missing_values(spark, write):
    lines = "1,NA,19,15,39\nn/a,Male,NA,null,NaN\n,None,x,1e1, 7\n"
    path = write(HEADER + lines)
    assert rows(src.read_customers(spark, path, text_ids=True)) == [
        ("1", None, 19, 15.0, 39.0), (None, "Male", None, None, None), (None, None, None, 10.0, 7.0)
    ]


def test_rows_from_memory(spark):
    table = src.customers_from_rows(spark, [(1, "Male", 30, 50, 60), (2, None, None, None, None)])
    assert table.schema == customer_schema()
    assert rows(table) == [(1, "Male", 30, 50.0, 60.0), (2, None, None, None, None)]
    assert src.customers_from_rows(spark, [("A1", "x", 1, 1, 1)], text_ids=True).first()[0] == "A1"


def test_saved_list(spark, write, tmp_path):
    root = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        src.current_customer_list(spark, root)
    first = write(HEADER + "1,Male,19,15,39\n", "a.csv")
    assert src.current_customer_list(spark, root, first).count() == 1
    second = write(HEADER + "1,Male,19,15,39\n2,Male,20,16,40\n", "b.csv")
    assert src.current_customer_list(spark, root, second).count() == 2
    with pytest.raises(Exception):
        src.current_customer_list(spark, root, write(HEADER + "1,Male,19,15\n", "c.csv"))
    assert src.current_customer_list(spark, root).count() == 2
    faulty = write(HEADER + "1,Male,old,15,39\n2,Male,20,16,40\n", "e.csv")
    assert sorted(r.Age or 0 for r in src.current_customer_list(spark, root, faulty).collect()) == [
        0, 20
    ]
    text = write(HEADER + "C-7,Male,19,15,39\n", "d.csv")
    named = src.current_customer_list(spark, root, text, text_ids=True)
    assert [r.CustomerID for r in named.collect()] == ["C-7"]


def test_positions_follow_file_order(spark, tmp_path):
    path = str(tmp_path / "many")
    ids = [f"r{i:05d}" for i in range(20_000)]
    table = spark.createDataFrame([(i,) for i in ids], "Gender string").orderBy("Gender")
    table.repartitionByRange(5, "Gender").sortWithinPartitions("Gender").write.option(
        "header", True
    ).csv(path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:  # several blocks per file and several files per task
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        numbered = src.with_position(src.read_customers(spark, path))
        # Other blocks than those counted must not lose rows.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        wanted = [0, 1, 3999, 4000, 12345, 19_999, 50_000]
        positions = spark.createDataFrame([(p,) for p in wanted + wanted], "position long")
        found = columns.lookup_positions(numbered, positions)
        assert sorted((r.position, r.Gender) for r in found.collect()) == [
            (p, ids[p]) for p in wanted if p < 20_000
        ]
        assert numbered.where(F.concat(F.lit("r"), F.lpad("position", 5, "0")) != F.col("Gender")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_lookup_ids(spark, customers):
    table = customers((20, 1, 1), (30, 2, 2)).union(customers((25, 3, 3)))
    ids = spark.createDataFrame([(0,), (0,), (9,)], "CustomerID long")
    assert columns.lookup_ids(table, ids).count() == 2
    first = columns.lookup_ids(table, ids, first_by=["Age"]).collect()
    assert [(r.CustomerID, r.Age) for r in first] == [(0, 20)]


def test_defaults(customers):
    bare = customers((20, 1, None)).select("CustomerID", "SpendingScore")
    filled = columns.fill_missing_columns(bare, DEFAULTS)
    assert filled.first().asDict() == {
        "CustomerID": 0, "SpendingScore": None, "Gender": "Male", "Age": 39, "AnnualIncome": 60.0
    }
    assert columns.fill_missing_columns(bare, DISPLAY_DEFAULTS).first().Gender == "Unknown"
    flagged = customers((20, 1, None)).withColumn("own", F.lit(False))
    assert columns.apply_opt_out(flagged, {"SpendingScore": "own"}).first().SpendingScore == 50.0


def test_casts(spark):
    raw = spark.createDataFrame(
        [("1", "M", "25.7", "60", "1e1"), ("x", "M", "", "NaN", "5"), ("3", None, "40", "7", None)],
        "CustomerID string, Gender string, Age string, AnnualIncome string, SpendingScore string",
    )
    ok, rejects = columns.cast_customers(raw)
    assert ok.schema == customer_schema()
    assert rows(ok) == [(1, "M", 25, 60.0, 10.0)]
    assert [(r.CustomerID, r.faults) for r in rejects.collect()] == [
        ("x", ["Age", "AnnualIncome", "CustomerID"]), ("3", ["SpendingScore"])
    ]
    assert columns.cast_customers(raw, text_ids=True)[0].first().CustomerID == "1"


@pytest.fixture(scope="module")
def fitted(spark, folder):
    blobs = fixtures.blobs(spark, folder)
    return blobs, fit_groups(blobs, 5)


def test_model_round_trip(spark, fitted, tmp_path):
    blobs, model = fitted
    root = str(tmp_path / "models")
    assert models.list_models(spark, root).count() == 0
    old = models.save_model(spark, model, "five", "notebook", root)
    new = models.save_model(spark, fit_groups(blobs, 3), "five", "ui", root)
    assert old != new
    record = models.model_record(spark, "five", root)
    assert (record["k"], record["source"], record["paths"]) == (3, "ui", {"hdfs": None, "local": new})
    loaded = models.load_model(spark, "five", root)
    assert loaded.k == 3 and len(loaded.groups) == 3
    assert loaded.domain[0]["column"] == "Age"
    assert assign_groups(blobs, loaded).select("group_id").distinct().count() == 3


def test_foreign_and_broken_records(spark, fitted, tmp_path):
    _, model = fitted
    root = tmp_path / "models"
    path = models.save_model(spark, model, "own", "ui", str(root))
    plain = {"name": "plain", "k": 5, "date": "2025-01-01 00:00:00", "source": "notebook",
             "paths": {"hdfs": path, "local": str(root / "gone")}}
    (root / "plain_meta.json").write_text(json.dumps(plain, indent=4))
    (root / "bad_meta.json").write_text('{"name": "bad", ')
    listed = {r.name: r for r in models.list_models(spark, str(root)).collect()}
    assert sorted(listed) == ["own", "plain"]
    stages, used = models.load_stages(listed["plain"].asDict(recursive=True))
    assert used == path
    restored = models.load_model(spark, "plain", str(root))
    assert restored.group_ids() == model.group_ids() and restored.groups == []


def test_stale_path_falls_back_to_the_name(spark, fitted, tmp_path):
    _, model = fitted
    model.pipeline.write().save(str(tmp_path / "moved"))
    stale = {"name": "moved", "k": 5, "date": "2025-01-01 00:00:00", "source": "ui",
             "paths": {"hdfs": None, "local": str(tmp_path / "gone")}}
    (tmp_path / "moved_meta.json").write_text(json.dumps(stale))
    assert models.load_model(spark, "moved", str(tmp_path)).group_ids() == model.group_ids()


def test_models_that_cannot_be_had(spark, fitted, tmp_path):
    with pytest.raises(LookupError):
        models.load_model(spark, "none", str(tmp_path))
    with pytest.raises(LookupError):
        models.load_stages({"name": "x", "paths": {"local": str(tmp_path / "no"), "hdfs": None}})
    with pytest.raises(ValueError):
        models.save_model(spark, fitted[1], "../x", "ui", str(tmp_path))


def test_shared_root(spark):
    root = session.shared_root(spark)
    assert root and spark.sparkContext.getCheckpointDir()
    assert session.new_folder(spark, "a") != session.new_folder(spark, "a")
    assert session.new_folder(spark, "a").startswith(root)


def scans(df):
    """Metrics of the file scans of a plan that has been run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    leaves, found = plan.collectLeaves(), []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while "QueryStage" in leaf.getClass().getSimpleName():
            inner = leaf.plan().collectLeaves()
            leaf = inner.apply(0)
        found.append(leaf)
    return found


def test_lookups_read_a_part_of_the_list(spark, write, tmp_path):
    lines = [f"{i // 2},Male,{i % 90},{i},{i}" for i in range(1000)]
    path = write(HEADER + "\n".join(lines) + "\n", "many.csv")
    table = src.read_customers(spark, path)
    root = str(tmp_path / "store")
    listed.write_list(src.with_position(table, listed.POSITION), root, block_rows=100)
    assert src.load_customer_list(spark, root).count() == 1000
    asked = spark.createDataFrame([(15,), (207,), (15,), (5000,), (-1,), (None,)], "position long")
    found = listed.lookup_listed_positions(spark, root, asked)
    assert sorted((r.position, r.AnnualIncome) for r in found.collect()) == [(15, 15.0), (207, 207.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "GreaterThanOrEqual(_position,15)" in plan
    rows = [s for s in scans(found) if "_position" in s.toString() and s.metrics().contains("numFiles")]
    # Blocks 0 and 2 of 10, whose files are no more than the two parts of the CSV each.
    assert max(s.metrics().apply("numFiles").value() for s in rows) <= 4
    none = spark.createDataFrame([(7777,)], "position long")
    assert listed.lookup_listed_positions(spark, root, none).count() == 0
    ids = spark.createDataFrame([(3,), (3,), (250,), (None,), (9999,)], "CustomerID long")
    first = listed.lookup_listed_ids(spark, root, ids).collect()
    assert sorted((r.CustomerID, r.AnnualIncome) for r in first) == [(3, 6.0), (250, 500.0)]


def test_empty_and_nameless_lists(spark, write, tmp_path):
    root = str(tmp_path / "store")
    assert src.current_customer_list(spark, root, write(HEADER, "none.csv")).count() == 0
    assert listed.lookup_listed_positions(spark, root, spark.range(3).toDF("position")).count() == 0
    assert listed.lookup_listed_ids(spark, root, spark.range(3).toDF("CustomerID")).count() == 0
    nameless = write(HEADER.replace("CustomerID,", "") + "Male,19,15,39\n", "nameless.csv")
    src.save_customer_list(spark, nameless, root)
    with pytest.raises(ValueError):
        listed.lookup_listed_ids(spark, root, spark.range(3).toDF("CustomerID"))
    assert listed.lookup_listed_positions(spark, root, spark.range(3).toDF("position")).count() == 1
    assert [r.type for r in listed.list_schema(spark, root).collect()] == ["string", "int", "double", "double"]


def test_old_lists_go(spark, write, tmp_path):
    root = str(tmp_path / "store")
    paths = [
        src.save_customer_list(spark, write(HEADER + f"{i},Male,19,15,39\n", f"{i}.csv"), root)
        for i in range(4)
    ]
    assert listed.drop_old_lists(spark, root, keep=2) == 2
    assert [os.path.exists(p) for p in paths] == [False, False, True, True]
    assert src.load_customer_list(spark, root).first().CustomerID == 3
    assert listed.drop_old_lists(spark, root, keep=2) == 0
    with pytest.raises(ValueError):
        listed.drop_old_lists(spark, root, keep=0)


def test_writers_at_the_same_time_get_different_numbers(spark, tmp_path):
    folder = str(tmp_path / "index")
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: commits.publish(spark, folder, {"i": i}), range(24)))
    assert sorted(numbers) == list(range(24))
    assert commits.current(spark, folder) == {"i": numbers.index(23)}
    # A writer that was lost after its claim, and one that was lost while it wrote.
    lost = commits.claim(spark, folder)
    (tmp_path / "index" / f"{lost + 1:012d}.writing").write_text('{"i"')
    assert commits.current(spark, folder) == {"i": numbers.index(23)}
    assert commits.publish(spark, folder, {"i": 99}) == lost + 1
    assert commits.current(spark, folder) == {"i": 99}


def test_a_clock_that_was_set_back(spark, write, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    src.save_customer_list(spark, write(HEADER + "1,Male,19,15,39\n", "a.csv"), root)
    monkeypatch.setattr(time, "time_ns", lambda: 5)
    monkeypatch.setattr(time, "time", lambda: 5.0)
    src.save_customer_list(spark, write(HEADER + "2,Male,19,15,39\n", "b.csv"), root)
    assert src.load_customer_list(spark, root).first().CustomerID == 2
