"""Places of regular expression matches, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTEXT = 48
SPAN = "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"


def located(matches: Column, gaps: Column, context: int = CONTEXT) -> Column:
    """Matches with start and end in code points and the text around them.

    ``matches`` are the matches in order and ``gaps`` the pieces between them, one
    more than there are matches.
    """
    empty = F.array().cast(SPAN)
    first = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("found"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["gap"])
        end = start + F.char_length(part["value"])
        span = F.struct(
            start.cast("bigint").alias("start"),
            end.cast("bigint").alias("end"),
            part["value"].alias("value"),
            F.right(part["gap"], F.lit(context)).alias("before"),
            F.left(part["next"], F.lit(context)).alias("after"),
        )
        return F.struct(
            end.cast("bigint").alias("at"),
            F.concat(state["found"], F.array(span)).alias("found"),
        )

    parts = F.transform(
        matches,
        lambda value, i: F.struct(
            value.alias("value"),
            F.get(gaps, i).alias("gap"),
            F.get(gaps, i + 1).alias("next"),
        ),
    )
    return F.aggregate(parts, first, step, lambda state: state["found"])


def spans_where(text: Column, likely: Column, pattern: str) -> tuple[Column, Column]:
    """Matches of ``pattern`` and the gaps between them; NULL where not ``likely``."""
    regex = F.lit(pattern)
    return (
        F.when(likely, F.regexp_extract_all(text, regex, F.lit(0))),
        F.when(likely, F.split(text, pattern, -1)),
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined in the given order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
