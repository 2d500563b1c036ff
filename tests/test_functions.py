import itertools
import math
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spendgroups.functions.numbers import is_number, number, one_decimal, time_text, two_decimals
from spendgroups.functions.ranges import warning_list
from spendgroups.functions.strategy import ACTIONS, DESCRIPTIONS, strategy
from spendgroups.schema import ENTRY_LIMITS, STRICT_LIMITS


def expected_code(income, score):
    for value in (income, score):
        if value is None or math.isnan(value):
            return "standard"
    table = {(1, 1): "vip", (1, -1): "potential", (-1, 1): "risk", (-1, -1): "saver"}
    side_i = 1 if income > 70 else -1 if income < 40 else 0
    side_s = 1 if score > 60 else -1 if score < 40 else 0
    return table.get((side_i, side_s), "standard")


def test_strategy_at_every_limit(spark):
    edge = [39.0, 40.0, 41.0, 60.0, 61.0, 70.0, 71.0, None, float("nan")]
    pairs = list(itertools.product(edge, edge))
    table = spark.createDataFrame(pairs, "i double, s double")
    rows = table.select("i", "s", strategy("i", "s").alias("p")).select("i", "s", "p.*").collect()
    assert len(rows) == len(pairs)
    for row in rows:
        code = expected_code(row.i, row.s)
        assert row.code == code
        assert row.description == DESCRIPTIONS[code]
        assert row.action == ACTIONS[code]


def test_numbers(spark):
    table = spark.createDataFrame([(1.5,), (None,), (float("nan"),)], "x double")
    rows = table.select(number("x").alias("n"), is_number("x").alias("ok")).collect()
    assert [tuple(r) for r in rows] == [(1.5, True), (None, False), (None, False)]


def test_texts(spark):
    row = spark.range(1).select(
        one_decimal(F.lit(88.04)), two_decimals(F.lit(1234.567)), two_decimals(F.lit(-0.001)),
        time_text(),
    ).first()
    assert tuple(row)[:3] == ("88.0", "1234.57", "-0.00")
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", row[3])


def warnings(table, *args):
    return [row[0] for row in table.select(warning_list(*args)).collect()]


def test_range_bounds_are_inclusive(customers):
    table = customers((18, 15, 1), (70, 137, 99), (17, 14.5, 100), (None, None, float("nan")))
    assert warnings(table) == [
        [],
        [],
        [
            "Age 17 is outside 18-70",
            "AnnualIncome 14.5 is outside 15-137",
            "SpendingScore 100.0 is outside 1-99",
        ],
        [],
    ]


def test_values_not_given_are_not_checked(customers):
    table = customers((80, 400, 50)).withColumn("own_age", F.lit(False))
    assert warnings(table, {"Age": (18, 70)}, {"Age": "own_age"}) == [[]]
    assert warnings(table.withColumn("own_age", F.lit(None).cast("boolean")),
                    {"Age": (18, 70)}, {"Age": "own_age"}) == [["Age 80 is outside 18-70"]]


def test_other_limits(customers):
    table = customers((110, 300, 150))
    assert warnings(table, ENTRY_LIMITS) == [[]]
    assert len(warnings(table, STRICT_LIMITS)[0]) == 3


def test_nan_test_on_text_raises(spark):
    with pytest.raises(PySparkException):
        spark.createDataFrame([("abc",)], "x string").select(number("x")).collect()
