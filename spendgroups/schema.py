"""Names, types and fixed values of the customer table."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER_ID = "CustomerID"
GENDER = "Gender"
AGE = "Age"
INCOME = "AnnualIncome"
SCORE = "SpendingScore"

NUMERIC = (AGE, INCOME, SCORE)
FEATURES = (INCOME, SCORE)

# Fixed values. Results depend on them, so they are kept together.
HEADER_MAP = {"Annual Income (k$)": INCOME, "Spending Score (1-100)": SCORE}
DEFAULTS = {GENDER: "Male", AGE: 39, INCOME: 60, SCORE: 50}
DISPLAY_DEFAULTS = {GENDER: "Unknown", AGE: 0, INCOME: 0, SCORE: 0}
TRAIN_DOMAIN = {AGE: (18, 70), INCOME: (15, 137), SCORE: (1, 99)}
ENTRY_LIMITS = {AGE: (0, 120), INCOME: (0, 500), SCORE: (0, 200)}
STRICT_LIMITS = {AGE: (18, 100), INCOME: (10, 200), SCORE: (1, 100)}
K_MIN, K_MAX, K_DEFAULT = 2, 10, 5
SEED = 42
# Cells that stand for a missing value, as the pandas CSV reader takes them.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Columns of a pipeline; models saved elsewhere use the same names.
ASSEMBLED, SCALED, CLUSTER = "features_raw", "features", "prediction"

COLUMN_TYPES = {
    CUSTOMER_ID: T.LongType(),
    GENDER: T.StringType(),
    AGE: T.IntegerType(),
    INCOME: T.DoubleType(),
    SCORE: T.DoubleType(),
}


def customer_schema(text_ids: bool = False) -> T.StructType:
    """The customer table. ``text_ids`` keeps the id as text."""
    types = dict(COLUMN_TYPES)
    if text_ids:
        types[CUSTOMER_ID] = T.StringType()
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])
