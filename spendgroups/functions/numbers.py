"""Small numeric and text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(value: Column | str) -> Column:
    """``value`` as a double, with NaN turned into NULL.

    Spark orders NaN above every number and lets it spoil an average, so no
    rule or aggregate should see it.
    """
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(~F.isnan(value), value)


def is_number(value: Column | str) -> Column:
    """True if ``value`` is neither NULL nor NaN; never NULL itself."""
    return number(value).isNotNull()


def one_decimal(value: Column | str) -> Column:
    """Text for reading. Halves are rounded up, so keep numbers to compute with."""
    return F.format_string("%.1f", value)


def two_decimals(value: Column | str) -> Column:
    return F.format_string("%.2f", value)


def time_text(value: Column | None = None) -> Column:
    """Time as ``yyyy-MM-dd HH:mm:ss``; now if no time is given."""
    value = F.current_timestamp() if value is None else value
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
