"""Marketing strategy for an income and a spending score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendgroups.functions.numbers import number

# Limits of the rule. Values equal to a limit are in neither part.
HIGH_INCOME, LOW_INCOME = 70, 40
HIGH_SCORE, LOW_SCORE = 60, 40

# Our own wording.
DESCRIPTIONS = {
    "vip": "High income, high spending",
    "potential": "High income, low spending",
    "risk": "Low income, high spending",
    "saver": "Low income, low spending",
    "standard": "Average customer",
}
ACTIONS = {
    "vip": "Give personal care and offer premium goods",
    "potential": "Suggest goods of quality to raise demand",
    "risk": "Offer instalments and discounts",
    "saver": "Send vouchers for everyday goods",
    "standard": "Keep in regular contact",
}


def _text_of(code: Column, texts: dict[str, str]) -> Column:
    pairs = [F.lit(part) for item in texts.items() for part in item]
    return F.create_map(*pairs)[code]


def strategy_code(income: Column | str, score: Column | str) -> Column:
    """One of the five codes; a missing value leads to ``standard``."""
    income, score = number(income), number(score)
    rich, poor = income > HIGH_INCOME, income < LOW_INCOME
    spends, saves = score > HIGH_SCORE, score < LOW_SCORE
    return (
        F.when(rich & spends, "vip")
        .when(rich & saves, "potential")
        .when(poor & spends, "risk")
        .when(poor & saves, "saver")
        .otherwise("standard")
    )


def strategy(income: Column | str, score: Column | str) -> Column:
    """Struct of code, description and action."""
    code = strategy_code(income, score)
    return F.struct(
        code.alias("code"),
        _text_of(code, DESCRIPTIONS).alias("description"),
        _text_of(code, ACTIONS).alias("action"),
    )
