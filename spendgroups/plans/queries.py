"""One query per operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgroups.functions.numbers import number, two_decimals
from spendgroups.functions.strategy import strategy
from spendgroups.operators import columns, distributions, measures, profile, quality, scoring
from spendgroups.operators.cluster import (
    Training,
    assign_groups,
    elbow_sweep,
    fit_groups,
    nearest_centre,
    scaling_stages,
    squared_distance,
)
from spendgroups.operators.selection import value_rows
from spendgroups.plans import fixtures, flows
from spendgroups.schema import (
    AGE,
    CUSTOMER_ID,
    DISPLAY_DEFAULTS,
    ENTRY_LIMITS,
    FEATURES,
    GENDER,
    HEADER_MAP,
    INCOME,
    K_DEFAULT,
    K_MAX,
    K_MIN,
    SCORE,
    STRICT_LIMITS,
)
from spendgroups.session import new_folder
from spendgroups.sources import customers, listed, models

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, names: Sequence[str], places: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in names})


def _blobs_model(spark: SparkSession, folder: str):
    blobs = fixtures.blobs(spark, folder)
    return blobs, fit_groups(blobs, 5)


def _grouped_blobs(spark: SparkSession, folder: str) -> DataFrame:
    return assign_groups(*_blobs_model(spark, folder))


def _as_csv(df: DataFrame, folder: str) -> str:
    headers = {name: header for header, name in HEADER_MAP.items()}
    df.withColumnsRenamed(headers).write.option("header", True).csv(folder)
    return folder


# Sources and sinks


@query
def csv_scan(spark, folder):
    path = _as_csv(fixtures.profile(spark, folder), new_folder(spark, "csv"))
    return customers.read_customers(spark, path)


@query
def saved_list_round_trip(spark, folder):
    root = new_folder(spark, "list")
    path = _as_csv(fixtures.profile(spark, folder), f"{root}/upload")
    customers.current_customer_list(spark, root, path)
    return customers.current_customer_list(spark, root)


def _named_list(spark: SparkSession, folder: str, *dropped: str) -> tuple[str, str]:
    """Root and CSV of a customer list with text ids and some cells that are no value."""
    key = F.col(CUSTOMER_ID)

    def cells(name: str, n: int, word: str):
        return F.when(key % n == 0, word).otherwise(F.col(name).cast("string"))

    listed = fixtures.profile(spark, folder).withColumns(
        {
            CUSTOMER_ID: F.concat(F.lit("C-"), key.cast("string")),
            GENDER: cells(GENDER, 11, "NA"),
            INCOME: cells(INCOME, 23, "n/a"),
            SCORE: cells(SCORE, 37, "unknown"),
        }
    )
    root = new_folder(spark, "named-list")
    return root, _as_csv(listed.drop(*dropped), f"{root}/upload")


@query
def saved_text_list(spark, folder):
    root, path = _named_list(spark, folder)
    customers.save_customer_list(spark, path, root, text_ids=True)
    return customers.load_customer_list(spark, root)


@query
def preview(spark, folder):
    return customers.preview(fixtures.profile(spark, folder))


@query
def model_round_trip(spark, folder):
    blobs, model = _blobs_model(spark, folder)
    root = new_folder(spark, "models")
    models.save_model(spark, model, "five", "notebook", root)
    loaded = models.load_model(spark, "five", root)
    before = assign_groups(blobs, model).select(
        *FEATURES, F.col("prediction").alias("before"), F.col("group_id").alias("group_before")
    )
    same = (F.col("before") == F.col("prediction")) & (
        F.col("group_before") == F.col("group_id")
    )
    return assign_groups(before, loaded).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("n_different")
    )


@query
def model_registry(spark, folder):
    _, model = _blobs_model(spark, folder)
    root = new_folder(spark, "registry")
    models.save_model(spark, model, "first", "notebook", root)
    models.save_model(spark, model, "second", "notebook", root)
    models.save_model(spark, model, "first", "ui", root)
    broken = spark.range(1).select(F.lit('{"name": ').alias("value"))
    broken.write.text(f"{root}/broken_meta.json")
    ranges = F.map_from_entries(
        F.transform("domain", lambda d: F.struct(d["column"], F.struct(d["lo"], d["hi"])))
    )
    return models.list_models(spark, root).select(
        "name",
        "k",
        "source",
        F.col("date").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$").alias("dated"),
        "n_rows",
        ranges[INCOME]["lo"].alias("income_lo"),
        ranges[INCOME]["hi"].alias("income_hi"),
        ranges[SCORE]["lo"].alias("score_lo"),
        ranges[SCORE]["hi"].alias("score_hi"),
    )


# Rows: defaults, casts, checks, lookups


@query
def id_list(spark, folder):
    return fixtures.profile(spark, folder).select(CUSTOMER_ID)


@query
def lookup_by_id(spark, folder):
    urgent = fixtures.table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    ids = urgent.select(F.col("o_custkey").alias(CUSTOMER_ID))
    key = F.col(CUSTOMER_ID)
    rows = fixtures.profile_dirty(spark, folder).distinct()
    rows = rows.withColumns({INCOME: number(INCOME), "position": 2 * key + 1})
    earlier = rows.where(key % 50 == 0).withColumns(
        {AGE: F.lit(76), SCORE: F.lit(100.0), "position": 2 * key}
    )
    return columns.lookup_ids(rows.unionByName(earlier), ids, first_by=["position"])


@query
def lookup_by_position(spark, folder):
    listed = fixtures.profile(spark, folder).orderBy(CUSTOMER_ID).drop(CUSTOMER_ID)
    path = _as_csv(listed, new_folder(spark, "positions"))
    numbered = customers.with_position(customers.read_customers(spark, path))
    urgent = fixtures.table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    positions = urgent.select(F.col("o_custkey").alias("position"))
    return columns.lookup_positions(numbered, positions)


@query
def default_values(spark, folder):
    table = (
        fixtures.loaded_profile(spark, folder)
        .drop(AGE)
        .withColumns(
            {
                "use_income": F.col(CUSTOMER_ID) % 3 != 0,
                "use_score": F.col(CUSTOMER_ID) % 4 != 0,
            }
        )
    )
    flags = {INCOME: "use_income", SCORE: "use_score"}
    table = columns.apply_opt_out(columns.fill_missing_columns(table), flags)
    table = columns.with_range_warnings(table, {INCOME: (70, 100), SCORE: (10, 40)}, flags)
    return table.select(
        CUSTOMER_ID, GENDER, AGE, INCOME, SCORE, F.array_join("warnings", "; ").alias("warnings")
    )


@query
def display_defaults(spark, folder):
    table = fixtures.loaded_profile(spark, folder).drop(GENDER, AGE)
    filled = columns.fill_missing_columns(table, DISPLAY_DEFAULTS)
    return filled.select(CUSTOMER_ID, GENDER, AGE, INCOME, SCORE)


@query
def range_warnings(spark, folder):
    table = columns.with_range_warnings(fixtures.profile_dirty(spark, folder))
    return table.select(
        CUSTOMER_ID,
        F.size("warnings").alias("n_warnings"),
        F.array_join("warnings", "; ").alias("warnings"),
    )


def _raw_text(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col(CUSTOMER_ID)
    text = {name: F.col(name).cast("string") for name in (AGE, INCOME, SCORE)}
    return fixtures.profile_dirty(spark, folder).withColumns(
        {
            CUSTOMER_ID: F.when(key % 13 == 0, F.concat(F.lit("C"), key)).otherwise(
                key.cast("string")
            ),
            AGE: F.when(key % 7 == 0, F.concat(text[AGE], F.lit(".5"))).otherwise(text[AGE]),
            INCOME: text[INCOME],
            SCORE: F.when(key % 19 == 0, "n/a").otherwise(text[SCORE]),
        }
    )


@query
def cast_ok(spark, folder):
    return columns.cast_customers(_raw_text(spark, folder))[0]


@query
def cast_rejects(spark, folder):
    rejects = columns.cast_customers(_raw_text(spark, folder))[1]
    return rejects.select(CUSTOMER_ID, F.array_join("faults", ",").alias("faults"))


@query
def customer_strategy(spark, folder):
    table = fixtures.profile_dirty(spark, folder)
    return table.select(CUSTOMER_ID, strategy(INCOME, SCORE).alias("_plan")).select(
        CUSTOMER_ID, "_plan.code", "_plan.description", "_plan.action"
    )


# Whole-table quality


@query
def null_nan_counts(spark, folder):
    return quality.missing_counts(fixtures.profile_dirty(spark, folder))


@query
def row_and_duplicate_count(spark, folder):
    return quality.duplicate_count(fixtures.profile_dirty(spark, folder))


@query
def describe_numeric(spark, folder):
    described = quality.describe_numeric(fixtures.profile_dirty(spark, folder))
    return rounded(described, ["mean", "sd"])


@query
def training_domain(spark, folder):
    return quality.training_domain(fixtures.profile(spark, folder))


@query
def correlation_matrix(spark, folder):
    return rounded(quality.correlation(fixtures.profile_dirty(spark, folder)), ["r"])


@query
def correlation_labels(spark, folder):
    matrix = quality.correlation(fixtures.profile_dirty(spark, folder))
    return matrix.select("a", "b", two_decimals("r").alias("label"))


def _overview_rows(overview: DataFrame) -> DataFrame:
    described = F.inline("described").alias("column", "n", "mean", "sd", "min", "max")
    table = overview.select(
        "n_rows",
        F.aggregate(
            "missing", F.lit(0).cast("bigint"), lambda total, m: total + m["n_missing"]
        ).alias("n_missing"),
        F.filter("correlations", lambda c: (c["a"] == AGE) & (c["b"] == INCOME))[0]["r"].alias(
            "r_age_income"
        ),
        described,
    )
    return rounded(table, ["r_age_income", "mean", "sd"])


@query
def table_overview(spark, folder):
    return _overview_rows(quality.table_overview(fixtures.profile_dirty(spark, folder)))


@query
def overview_after_append(spark, folder):
    """Measures kept of two files' worth of customers, after the second was added."""
    root = new_folder(spark, "kept")
    dirty = fixtures.profile_dirty(spark, folder)
    third = F.col(CUSTOMER_ID) % 3 == 0
    dirty.where(~third).write.parquet(f"{root}/rows")
    measures.kept_overview(spark.read.parquet(f"{root}/rows"), f"{root}/rows", f"{root}/store")
    dirty.where(third).write.mode("append").parquet(f"{root}/rows")
    table = spark.read.parquet(f"{root}/rows")
    return _overview_rows(measures.kept_overview(table, f"{root}/rows", f"{root}/store"))


# Distributions


@query
def hist20(spark, folder):
    table = distributions.histogram(fixtures.profile(spark, folder))
    return rounded(table, ["lo", "hi"])


@query
def hist_auto(spark, folder):
    table = distributions.histogram(fixtures.loaded_profile(spark, folder), bins="auto")
    return rounded(table, ["lo", "hi"])


@query
def density_curve(spark, folder):
    table = distributions.density_curve(fixtures.profile(spark, folder))
    return rounded(rounded(table, ["x", "height"], 5), ["density"], 8)


@query
def hist_prices(spark, folder):
    orders = fixtures.table(spark, folder, "orders")
    return rounded(distributions.histogram(orders, ["o_totalprice"]), ["lo", "hi"])


@query
def density_prices(spark, folder):
    orders = fixtures.table(spark, folder, "orders")
    table = distributions.density_curve(orders, ["o_totalprice"])
    return rounded(rounded(table, ["x", "height"], 5), ["density"], 12)


@query
def box_prices(spark, folder):
    lines = fixtures.table(spark, folder, "lineitem")
    cols, by = ["l_extendedprice"], "l_returnflag"
    table = distributions.box_stats(lines, cols, by, counts=value_rows(lines, cols, by))
    return rounded(table, ["q1", "median", "q3", "lo", "hi"])


@query
def box_stats(spark, folder):
    table = distributions.box_stats(fixtures.profile_dirty(spark, folder))
    return rounded(table, ["q1", "median", "q3", "lo", "hi"])


@query
def box_outliers(spark, folder):
    dirty = fixtures.profile_dirty(spark, folder)
    return distributions.box_outliers(dirty, keep=[CUSTOMER_ID])


@query
def box_by_group(spark, folder):
    grouped = _grouped_blobs(spark, folder)
    table = distributions.box_stats(grouped, FEATURES, by="group_id")
    return rounded(table, ["q1", "median", "q3", "lo", "hi"])


@query
def box_outliers_by_group(spark, folder):
    dirty = fixtures.profile_dirty(spark, folder)
    return distributions.box_outliers(dirty, by=GENDER, keep=[CUSTOMER_ID])


@query
def count_by_gender(spark, folder):
    return distributions.count_by(fixtures.profile_dirty(spark, folder), GENDER)


@query
def count_by_group(spark, folder):
    return distributions.count_by(_grouped_blobs(spark, folder), "group_id")


@query
def points_by_gender(spark, folder):
    return distributions.point_grid(fixtures.profile_dirty(spark, folder), by=GENDER)


@query
def points_all(spark, folder):
    return distributions.point_grid(fixtures.profile(spark, folder), width=5.0)


@query
def points_by_group(spark, folder):
    return distributions.point_grid(_grouped_blobs(spark, folder), by="group_id")


@query
def points_pyramid(spark, folder):
    orders = fixtures.table(spark, folder, "orders")
    return distributions.point_pyramid(
        orders, "o_totalprice", "o_custkey", "o_orderstatus", 100.0, (1, 10, 100, 1000)
    )


# Scaling and K-means


@query
def standardize(spark, folder):
    table = fixtures.profile(spark, folder)
    scaled = Pipeline(stages=scaling_stages()).fit(table).transform(table)
    scaled = scaled.withColumn("z", vector_to_array("features"))
    return scaled.select(
        CUSTOMER_ID,
        F.round(F.col("z")[0], 6).alias("z_income"),
        F.round(F.col("z")[1], 6).alias("z_score"),
    )


@query
def assign_to_given_centres(spark, folder):
    centres = [(88, 82), (88, 17), (25, 80), (25, 20), (55, 50)]
    table = fixtures.profile(spark, folder)
    nearest = nearest_centre(FEATURES, centres)
    return table.select(CUSTOMER_ID, nearest.alias("_near")).select(
        CUSTOMER_ID, F.col("_near.id").alias("centre"), F.col("_near.distance").alias("distance")
    )


@query
def nearest_violations(spark, folder):
    table = fixtures.loaded_profile(spark, folder)
    model = fit_groups(table, 5)
    centres = [tuple(c) for c in model.pipeline.stages[-1].clusterCenters()]
    z = [F.col("z")[0], F.col("z")[1]]
    assigned = F.array(*[squared_distance(z, c) for c in centres])[F.col("prediction")]
    return (
        assign_groups(table, model)
        .withColumn("z", vector_to_array("features"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(assigned > nearest_centre(z, centres)["distance"] + 1e-9).alias(
                "n_violations"
            ),
        )
    )


@query
def elbow_k5_cost(spark, folder):
    costs = elbow_sweep(fixtures.blobs(spark, folder), [5])
    return rounded(costs, ["cost"], 5)


@query
def elbow_sweep_all(spark, folder):
    """For each K: is there a cost, and is it what the rows and their centres give?

    What K-means finds depends on its start, but for the five known groups.
    """
    training = Training(fixtures.blobs(spark, folder))
    try:
        fits = training.sweep(range(K_MIN, K_MAX + 1))
        # The two numbers are taken out of the vector once, not for every distance.
        z = training.rows.select(vector_to_array("features").alias("z"))
        z = z.select(F.col("z")[0].alias("x"), F.col("z")[1].alias("y"))
        again = z.agg(
            *[
                F.sum(nearest_centre(["x", "y"], fit.clusterCenters())["distance"]).alias(str(k))
                for k, fit in fits.items()
            ]
        ).first()
    finally:
        training.release()
    rows = [(k, float(fit.summary.trainingCost), again[str(k)]) for k, fit in fits.items()]
    costs = spark.createDataFrame(rows, "k int, cost double, again double")
    return costs.select(
        "k",
        (F.col("cost") > 0).alias("has_cost"),
        (F.abs(F.col("cost") - F.col("again")) <= 1e-6 * F.col("again")).alias("same_cost"),
        F.when(F.col("k") == K_DEFAULT, F.round("cost", 5)).alias("known_cost"),
    )


@query
def fit_from_rows(spark, folder):
    """Fits with starts from the rows, from 1 and 7 partitions: do they agree, and do their
    groups hold all rows?"""
    table = fixtures.loaded_profile(spark, folder)
    first, other = (fit_groups(table.repartition(n), 5, start_from_rows=True) for n in (1, 7))

    def centres(model):
        return sorted([round(x, 6) for x in centre] for centre in model.centres())

    agree = centres(first) == centres(other) and abs(first.cost - other.cost) < 1e-6 * first.cost
    grouped = assign_groups(table, first).groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    return grouped.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_groups")).withColumn(
        "agree", F.lit(agree)
    )


@query
def group_report(spark, folder):
    report = profile.group_report(_grouped_blobs(spark, folder))
    return rounded(report, ["mean_income", "mean_score"])


@query
def group_report_text(spark, folder):
    return profile.report_text(profile.group_report(_grouped_blobs(spark, folder)))


@query
def group_report_from_fit(spark, folder):
    """The group facts kept with a model, measured during the fit."""
    model = fit_groups(fixtures.blobs(spark, folder), 5)
    kept = spark.createDataFrame(
        [(g["group_id"], g["n_rows"], g["mean_income"], g["mean_score"]) for g in model.groups],
        "group_id int, n_rows bigint, mean_income double, mean_score double",
    )
    return rounded(kept, ["mean_income", "mean_score"])


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of customers without known groups."""
    table = fixtures.loaded_profile(spark, folder)
    report = profile.group_report(assign_groups(table, fit_groups(table, 5)))
    return report.orderBy("group_id")


@query
def profile_report(spark, folder):
    """The flagship's report, held against the rows it is about: counts of violations.

    What K-means finds depends on its start; what must hold of any result does not.
    """
    table = fixtures.loaded_profile(spark, folder)
    model = fit_groups(table, 5)
    centres = [tuple(c) for c in model.pipeline.stages[-1].clusterCenters()]
    z = vector_to_array("features")
    assigned = F.array(*[squared_distance([z[0], z[1]], c) for c in centres])[F.col("prediction")]
    nearest = nearest_centre([z[0], z[1]], centres)["distance"]
    grouped = assign_groups(table, model)
    again = grouped.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(INCOME).alias("income"),
        F.sum(SCORE).alias("score"),
        F.count_if(assigned > nearest + 1e-9).alias("far"),
    )
    income, score = F.col("income") / F.col("rows"), F.col("score") / F.col("rows")
    rich, poor = income > 70, income < 40
    much, little = score > 60, score < 40
    code = (
        F.when(rich & much, "vip")
        .when(rich & little, "potential")
        .when(poor & much, "risk")
        .when(poor & little, "saver")
        .otherwise("standard")
    )
    off = (F.abs(F.col("mean_income") - income) > 1e-9) | (F.abs(F.col("mean_score") - score) > 1e-9)
    return (
        profile.group_report(grouped)
        .join(again, "group_id", "full")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.count(F.lit(1)).alias("n_groups"),
            F.count_if(~F.equal_null("n_rows", "rows")).alias("n_wrong_sizes"),
            F.sum("far").alias("n_not_nearest"),
            F.count_if(F.coalesce(off, F.lit(True))).alias("n_wrong_means"),
            F.count_if(~F.equal_null(F.col("strategy"), code)).alias("n_wrong_strategies"),
        )
    )


# Whole flows and forms


@query
def flow_train(spark, folder):
    """Train as a user does, on customers of whom some lack an income, and read the report."""
    blobs = fixtures.blobs(spark, folder)
    poor = blobs.where(F.col(CUSTOMER_ID) % 7 == 0).withColumn(INCOME, F.lit(None).cast("double"))
    result = flows.train(blobs.unionByName(poor), "five", new_folder(spark, "models"))
    sizes = result.sizes().select(F.col("value").alias("group_id"), F.col("n").alias("n_assigned"))
    report = rounded(result.report, ["mean_income", "mean_score"]).join(F.broadcast(sizes), "group_id")
    rejects = result.rejects.agg(F.count(F.lit(1)).alias("n_rejects")).first()["n_rejects"]
    return report.drop("description", "action").withColumn("n_rejects", F.lit(rejects))


@query
def flow_explore(spark, folder):
    """What the tables of an exploration add up to, by table and column."""
    found = flows.explore(fixtures.profile_dirty(spark, folder))

    def totals(table: DataFrame, name: str, column: Column, n: Column) -> DataFrame:
        rows = table.select(column.cast("string").alias("of"), n.cast("bigint").alias("n"))
        return rows.groupBy("of").agg(F.sum("n").alias("n")).withColumn("name", F.lit(name))

    parts = [
        totals(found["duplicates"], "duplicates", F.lit("rows"), F.col("n_duplicates")),
        totals(found["histogram"], "histogram", F.col("column"), F.col("n")),
        totals(found["boxes"], "boxes", F.col("column"), F.col("n")),
        totals(found["outliers"], "outliers", F.col("column"), F.lit(1)),
        totals(found["genders"], "genders", F.col("value"), F.col("n")),
        totals(found["points"], "points", F.lit("rows"), F.col("n")),
        totals(found["points_by_gender"], "points_by_gender", F.col(GENDER), F.col("n")),
    ]
    return reduce(DataFrame.unionByName, parts).select("name", "of", "n")


@query
def form_limits(spark, folder):
    """Warnings by the limits of either form."""
    dirty = fixtures.profile_dirty(spark, folder)
    limits = {"entry": ENTRY_LIMITS, "strict": STRICT_LIMITS}
    forms = [
        columns.with_range_warnings(dirty, domain).select(
            CUSTOMER_ID, F.lit(form).alias("form"), F.array_join("warnings", "; ").alias("warnings")
        )
        for form, domain in limits.items()
    ]
    return reduce(DataFrame.unionByName, forms)


# Scoring


@query
def score_batch(spark, folder):
    blobs, model = _blobs_model(spark, folder)
    root = new_folder(spark, "models")
    models.save_model(spark, model, "five", "notebook", root)
    record = models.model_record(spark, "five", root)
    loaded = models.load_model(spark, "five", root, record)
    scored, _ = scoring.score_customers(blobs, loaded, record)
    return scored.drop(GENDER, AGE, "model_date")


@query
def score_rejects(spark, folder):
    model = fit_groups(fixtures.blobs(spark, folder), 5)
    dirty = fixtures.profile_dirty(spark, folder)
    _, rejects = scoring.score_customers(dirty, model)
    return rejects.select(CUSTOMER_ID, GENDER, AGE)


@query
def score_with_warnings(spark, folder):
    model = fit_groups(fixtures.blobs(spark, folder), 5)
    dirty = fixtures.profile_dirty(spark, folder)
    scored, _ = scoring.score_customers(dirty, model, check_range=True)
    return scored.select(
        CUSTOMER_ID, "customer_strategy", F.array_join("warnings", "; ").alias("warnings")
    )


@query
def score_with_defaults(spark, folder):
    """Cells as text, no score column, and every fourth customer keeps the income back."""
    _, model = _blobs_model(spark, folder)
    root = new_folder(spark, "models")
    models.save_model(spark, model, "five", "notebook", root)
    key = F.regexp_extract(CUSTOMER_ID, r"\d+", 0).cast("bigint")
    raw = _raw_text(spark, folder).drop(SCORE).withColumn("use_income", key % 4 != 0)
    scored, _ = flows.score(spark, raw, "five", root, flags={INCOME: "use_income"}, raw=True)
    return scored.select(
        CUSTOMER_ID,
        AGE,
        INCOME,
        SCORE,
        "group_id",
        "customer_strategy",
        F.array_join("warnings", "; ").alias("warnings"),
    )


@query
def score_rows_in_memory(spark, folder):
    """One customer for each of the five known groups, entered by hand."""
    blobs, model = _blobs_model(spark, folder)
    entered = blobs.groupBy(F.col(CUSTOMER_ID) % 5).agg(
        F.min(CUSTOMER_ID), F.min(GENDER), F.min(AGE), F.max(INCOME), F.max(SCORE)
    )
    rows = customers.customers_from_rows(spark, [tuple(row)[1:] for row in entered.collect()])
    scored, _ = scoring.score_customers(rows, model)
    return scored.drop("description", "action")


@query
def score_listed(spark, folder):
    """Customers picked by id from the saved list, which has no ages, and scored."""
    _, model = _blobs_model(spark, folder)
    models_root = new_folder(spark, "models")
    models.save_model(spark, model, "five", "notebook", models_root)
    root, path = _named_list(spark, folder, AGE)
    current = customers.current_customer_list(spark, root, path, text_ids=True)
    urgent = fixtures.table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    ids = urgent.select(F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias(CUSTOMER_ID))
    scored, _ = flows.score(spark, columns.lookup_ids(current, ids), "five", models_root)
    return scored.select(
        CUSTOMER_ID, GENDER, AGE, INCOME, SCORE, "group_id", "customer_strategy", "model_name"
    )


@query
def score_listed_position(spark, folder):
    """Customers picked by position from the saved list, which has no ids, and scored."""
    _, model = _blobs_model(spark, folder)
    models_root, root = new_folder(spark, "models"), new_folder(spark, "list")
    models.save_model(spark, model, "five", "notebook", models_root)
    rows = fixtures.profile(spark, folder).orderBy(CUSTOMER_ID).drop(CUSTOMER_ID)
    customers.save_customer_list(spark, _as_csv(rows, f"{root}/upload"), root)
    urgent = fixtures.table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    positions = urgent.select(F.col("o_custkey").alias("position"))
    found = listed.lookup_listed_positions(spark, root, positions)
    scored, _ = flows.score(spark, found, "five", models_root)
    return scored.select(
        "position", GENDER, AGE, INCOME, SCORE, "group_id", "customer_strategy", "model_name"
    )


@query
def lookup_listed_id(spark, folder):
    """The first row of each listed id in the saved list, where every fifth id stands twice."""
    root = new_folder(spark, "list")
    table = fixtures.profile(spark, folder)
    again = table.where(F.col(CUSTOMER_ID) % 5 == 0).withColumn(AGE, F.lit(99))
    rows = table.withColumn("nth", F.lit(0)).unionByName(again.withColumn("nth", F.lit(1)))
    rows = rows.orderBy("nth", CUSTOMER_ID).drop("nth")
    customers.save_customer_list(spark, _as_csv(rows, f"{root}/upload"), root)
    urgent = fixtures.table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    ids = urgent.select(F.col("o_custkey").alias(CUSTOMER_ID))
    return listed.lookup_listed_ids(spark, root, ids)


@query
def saved_list_schema(spark, folder):
    root, path = _named_list(spark, folder)
    customers.save_customer_list(spark, path, root, text_ids=True)
    count = listed.current_list(spark, root)["n_rows"]
    return listed.list_schema(spark, root).withColumn("n_rows", F.lit(count).cast("bigint"))
