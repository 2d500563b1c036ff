"""Personal data: patterns propose, checksums confirm, context adjusts the score."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgroups.llm.spans import joined, located, spans_where
from spendgroups.llm.tables import free_names

# The patterns find what the plain ones in the comments find. Loops are possessive and
# a match starts only where a run of its first characters starts (or where the match
# before ended), so that time is linear and the stack flat on any text.
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+
#   phone \+[0-9][\x20().0-9-]+[0-9]
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# How long the account numbers of a country are.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
IBAN_BY_LENGTH = "|".join(
    rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}"
    for n, codes in IBAN_LENGTHS.items()
)
IBAN = rf"(?<![A-Za-z0-9])(?:{IBAN_BY_LENGTH})(?![A-Za-z0-9])"
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
IP_PARTS = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"

# Words that make a kind likelier when they stand near a span.
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write to"),
    "ip": ("address", "host", "server"),
    "card": ("card", "visa", "payment"),
    "phone": ("phone", "telephone", "call", "mobile", "tel"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "national_id": ("ssn", "social security", "national id", "tax id"),
}
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id")


def luhn_ok(digits: Column) -> Column:
    """Whether a text of decimal digits passes the Luhn checksum."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, x: total + x) % 10 == 0


def mod97_ok(code: Column) -> Column:
    """Whether letters and digits pass the mod-97 checksum of account numbers."""
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))
    values = F.transform(
        F.split(turned, ""),
        lambda c: F.when(c.between("A", "Z"), F.ascii(c) - 55).otherwise(F.ascii(c) - 48),
    )
    rest = F.aggregate(
        values, F.lit(0), lambda r, v: (r * F.when(v > 9, 100).otherwise(10) + v) % 97
    )
    return rest == 1


@dataclass(frozen=True)
class Rule:
    """How one kind is found. ``certainty`` is the score of a confirmed span without
    context; ``likely`` is a cheap test that no text with a match fails."""

    kind: str
    pattern: str
    likely: Callable[[Column], Column]
    confirmed: Callable[[Column], Column]
    certainty: float


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _card_ok(value: Column) -> Column:
    digits = _digits(value)
    return F.char_length(digits).between(16, 19) & luhn_ok(digits)


RULES = (
    Rule("email", EMAIL, lambda t: F.contains(t, F.lit("@")), lambda v: F.lit(True), 0.9),
    Rule("ip", IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda v: v.rlike(IP_PARTS), 0.7),
    Rule("card", CARD, lambda t: t.rlike(r"[0-9](?:[\x20-]?+[0-9]){15}"), _card_ok, 0.8),
    Rule(
        "phone",
        PHONE,
        lambda t: F.contains(t, F.lit("+")),
        lambda v: F.char_length(_digits(v)).between(8, 15),
        0.7,
    ),
    Rule(
        "iban",
        IBAN,
        lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"),
        lambda v: mod97_ok(F.replace(v, F.lit(" "), F.lit(""))),
        0.8,
    ),
    Rule(
        "national_id",
        NATIONAL_ID,
        lambda t: t.rlike("[0-9]-[0-9]{2}-[0-9]"),
        lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$"),
        0.3,
    ),
)


def _test(rule: Rule) -> Callable[[Column], Column]:
    return lambda s: F.coalesce(rule.confirmed(s["value"]), F.lit(False))


def context_pattern(words: Iterable[str]) -> str:
    """Matches lower-case text that has one of ``words`` as a whole word."""
    return rf"(?:^|[^a-z0-9])(?:{'|'.join(re.escape(w) for w in words)})(?:[^a-z0-9]|$)"


def _score(rule: Rule, words: tuple[str, ...]) -> Callable[[Column], Column]:
    def scored(s: Column) -> Column:
        score = F.lit(rule.certainty)
        if words:
            around = F.lower(F.concat(s["before"], F.lit(" "), s["after"]))
            score = score + F.when(around.rlike(context_pattern(words)), 0.3).otherwise(0.0)
        return F.struct(
            F.lit(rule.kind).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            F.round(F.least(score, F.lit(1.0)), 3).alias("score"),
        )

    return scored


def find_pii(
    docs: DataFrame,
    text: str = "text",
    out: str = "pii",
    threshold: float = 0.5,
    context_words: Mapping[str, tuple[str, ...]] = CONTEXT_WORDS,
) -> DataFrame:
    """Add ``out``: an array of (kind, start, end, value, score), by kind, then start.

    Places are code points, the end exclusive. A span that its checksum or range test
    confirms gets the certainty of its kind; a context word, as a whole word within 48
    characters, adds 0.3, up to 1. Account numbers are as long as their country makes them,
    so words after one are no part of it; other countries have none. Spans below ``threshold`` go; those of the four base kinds are certain enough
    without context. Matches of different kinds may overlap; one kind's do not.

    A text that is NULL or empty has no spans. Each row is judged by itself: row
    count, ties, repeated rows and other columns stay as they are. A column that is
    already called ``out`` is replaced.
    """
    columns = [c for c in docs.columns if c.lower() != out.lower()]
    names = free_names(docs, *[f"_{r.kind}_{x}" for r in RULES for x in ("found", "gaps")])
    body = F.col(f"`{text}`")
    steps, parts = {}, []
    for n, rule in enumerate(RULES):
        found, gaps = names[2 * n], names[2 * n + 1]
        steps[found], steps[gaps] = spans_where(body, rule.likely(body), rule.pattern)
        spans = F.filter(located(F.col(found), F.col(gaps)), _test(rule))
        scored = _score(rule, context_words.get(rule.kind, ()))
        spans = F.filter(F.transform(spans, scored), lambda s: s["score"] >= threshold)
        none = F.array().cast(
            "array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>"
        )
        parts.append(F.when(F.size(found) > 0, spans).otherwise(none))
    return docs.withColumns(steps).select(
        *[F.col(f"`{c}`") for c in columns], F.concat(*parts).alias(out)
    )


def redact(docs: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """Replace every span by its kind in brackets. Spans that overlap are cut out together
    and get the kind of the earliest, then the longest. A NULL text stays NULL; the span
    column goes."""
    body, found = F.col(f"`{text}`"), F.col(f"`{spans}`")
    ordered = F.array_sort(
        F.transform(
            found,
            lambda s: F.struct(
                s["start"].alias("start"), (-s["end"]).alias("minus"), s["kind"].alias("kind")
            ),
        )
    )
    begun = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(body, state["at"] + 1, s["start"] - state["at"])
        moved = F.struct(
            (-s["minus"]).alias("at"),
            F.concat(
                state["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")
            ).alias("out"),
        )
        longer = F.struct(
            F.greatest(state["at"], -s["minus"]).alias("at"), state["out"].alias("out")
        )
        return F.when(s["start"] >= state["at"], moved).otherwise(longer)

    cut = F.aggregate(
        ordered,
        begun,
        step,
        lambda state: F.concat(state["out"], F.substr(body, state["at"] + 1)),
    )
    changed = docs.withColumn(text, F.when(F.size(found) > 0, cut).otherwise(body))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns if c != spans])


def pii_digest(docs: DataFrame) -> DataFrame:
    """Per document the counts of the base kinds, digests of all places and, in the same
    order, the scores in thousandths."""
    found = find_pii(docs.select("doc_id", "text"))

    def of(kind: str) -> Column:
        return F.filter("pii", lambda s: s["kind"] == kind)

    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
        F.array_join(
            F.transform("pii", lambda s: F.round(s["score"] * 1000).cast("int").cast("string")), ","
        ).alias("scores"),
    )
