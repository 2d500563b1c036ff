"""Check of values against the range a model was trained on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendgroups.functions.numbers import number
from spendgroups.schema import TRAIN_DOMAIN


def warning_list(
    domain: Mapping[str, tuple] = TRAIN_DOMAIN,
    flags: Mapping[str, str] | None = None,
) -> Column:
    """Array of one text per value outside its inclusive range.

    ``flags`` names, per column, a boolean column that is false where the value
    was not given by the customer; such a value is not checked.
    """
    flags = flags or {}
    found = []
    for name, (low, high) in domain.items():
        outside = ~number(name).between(low, high)
        if name in flags:
            outside = outside & F.coalesce(F.col(flags[name]), F.lit(True))
        text = F.concat(
            F.lit(f"{name} "), F.col(name).cast("string"), F.lit(f" is outside {low}-{high}")
        )
        found.append(F.when(outside, text))
    return F.filter(F.array(*found), lambda text: text.isNotNull())
