"""Secrets, found with a ledger of the text versions that were scanned before."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgroups.llm.spans import joined, located, spans_where
from spendgroups.llm.tables import stored
from spendgroups.session import broadcast_if_few, new_folder

# In either case, for ASCII letters only.
_KEYWORD = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
)
_HEAD = rf"{_KEYWORD}[\x22']?\x20*+[:=]\x20*+[\x22']?"
ASSIGN = rf"{_HEAD}[A-Za-z0-9+/_.=-]++"
LONG_ENOUGH = rf"^{_HEAD}[A-Za-z0-9+/_.=-]{{6,}}$"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A change of its pattern or test needs a new ``version``.

    ``likely`` is a cheap test that no text with a match fails, ``confirmed`` the test
    that a match has to pass.
    """

    kind: str
    version: int
    pattern: str
    likely: Callable[[Column], Column]
    confirmed: Callable[[Column], Column]

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, then what is added. Runs of hex digits and of key characters are
# taken whole, so asking for the least length in the pattern finds the same matches.
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule("assign", 1, ASSIGN, lambda t: t.rlike(ASSIGN), lambda v: v.rlike(LONG_ENOUGH)),
    Rule(
        "access",
        1,
        "AKIA[A-Z0-9]{16,}+",
        lambda t: F.contains(t, F.lit("AKIA")),
        lambda v: F.lit(True),
    ),
    Rule("hex", 1, "[0-9a-f]{24,}+", lambda t: t.rlike("[0-9a-f]{24}"), lambda v: F.lit(True)),
    Rule(
        "private_key",
        1,
        "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----",
        lambda t: F.contains(t, F.lit("-----BEGIN ")),
        lambda v: F.lit(True),
    ),
    Rule(
        "signed_token",
        1,
        r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
        lambda t: F.contains(t, F.lit("eyJ")),
        lambda v: F.lit(True),
    ),
)
FINDING = "struct<start:bigint,rank:int,end:bigint,rule:string,kind:string>"
LEDGER = f"blob string, rules array<string>, findings array<{FINDING}>"


def blob_name(text: Column) -> Column:
    """Address of a text version by its content; NULL counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty if nothing was scanned yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LEDGER)
        raise


def unseen(docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob, text, todo``: each version once, with the rules not yet run on it.

    Addresses are compared with the ledger first, so that texts it knows are not shuffled.
    Copies of one text are reduced to one row in each task before they are.
    """
    wanted = F.array(*[F.lit(rule.name) for rule in rules])
    named = docs.select(blob_name(F.col("text")).alias("blob"), "text")
    text = F.first("text", ignorenulls=True).alias("text")
    if ledger.isEmpty():
        return named.groupBy("blob").agg(text).withColumn("todo", wanted)
    done = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(
        F.collect_set("rule").alias("done")
    )
    rest = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    due = (
        named.select("blob")
        .distinct()
        .join(done, "blob", "left")
        .select("blob", rest.alias("todo"))
        .where(F.size("todo") > 0)
    )
    due = broadcast_if_few(stored(due, "due"))
    return named.join(due, "blob").groupBy("blob").agg(text, F.first("todo").alias("todo"))


def _test(rule: Rule) -> Callable[[Column], Column]:
    return lambda s: rule.confirmed(s["value"])


def _finding(rule: Rule, rank: int) -> Callable[[Column], Column]:
    return lambda s: F.struct(
        s["start"].alias("start"),
        F.lit(rank).alias("rank"),
        s["end"].alias("end"),
        F.lit(rule.name).alias("rule"),
        F.lit(rule.kind).alias("kind"),
    )


def scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows for ``blob, text, todo``: which rules ran and what they found."""
    text = F.coalesce(F.col("text"), F.lit(""))
    steps, parts = {}, []
    for n, rule in enumerate(rules):
        due = F.array_contains("todo", rule.name) & rule.likely(text)
        steps[f"_found{n}"], steps[f"_gaps{n}"] = spans_where(text, due, rule.pattern)
        hits = F.filter(located(F.col(f"_found{n}"), F.col(f"_gaps{n}")), _test(rule))
        hits = F.transform(hits, _finding(rule, n))
        none = F.array().cast(f"array<{FINDING}>")
        parts.append(F.when(F.size(f"_found{n}") > 0, hits).otherwise(none))
    return blobs.withColumns(steps).select(
        "blob", F.col("todo").alias("rules"), F.array_sort(F.concat(*parts)).alias("findings")
    )


def scan_secrets(
    docs: DataFrame, ledger_path: str | None = None, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``doc_id, blob, findings`` for every row of ``docs`` (``doc_id, text``).

    Every version of a text is named by the hash of its content. Only pairs of a
    version and a rule version that the ledger at ``ledger_path`` does not hold are
    scanned, and their results are appended to it; then findings are joined back to all
    rows with that version. Without a path a new ledger is begun in the shared folder.

    ``findings`` are (start, rank, end, rule, kind) in order of start, then of the
    rules; places are code points, the end exclusive. A text that is NULL or empty has
    none. Repeated rows and rows without an id each get a result of their own; an
    empty table gives an empty result and no ledger rows. Columns besides ``doc_id``
    and ``text`` are passed over.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    path = ledger_path or new_folder(spark, "ledger")
    fresh = scan(unseen(docs, read_ledger(spark, path), rules), rules)
    fresh.write.mode("append").parquet(path)
    ledger = read_ledger(spark, path)
    names = [rule.name for rule in rules]
    current = ledger.select("blob", F.inline("findings")).where(F.col("rule").isin(names))
    # Written out so that the join below has a plain shuffle on both sides; the side of
    # a version with very many rows can then be split.
    hits = stored(
        # A set, as runs at the same time may both have recorded a version.
        current.groupBy("blob").agg(
            F.array_sort(F.collect_set(F.struct("start", "rank", "end", "rule", "kind"))).alias("hits")
        ),
        "hits",
    )
    paths = docs.select("doc_id", blob_name(F.col("text")).alias("blob"))
    none = F.array().cast(f"array<{FINDING}>")
    return paths.join(hits, "blob", "left").select(
        "doc_id", "blob", F.coalesce("hits", none).alias("findings")
    )


def secrets_digest(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """Per document the counts of the base kinds and digests of all places."""
    found = scan_secrets(docs, ledger_path)

    def of(*kinds: str) -> Column:
        return F.filter("findings", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(of(*BASE_KINDS)), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )
