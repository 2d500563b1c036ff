"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgroups.llm.tables import free_names, stored
from spendgroups.session import broadcast_if_few

# Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
# Documents that one array of a rounding step holds on average.
GROUP = 128
# Equal rows that one task numbers at a time.
CHUNK = 65_536
BLANKS = "\x20\t\n\x0b\x0c\r"
# A character of a word; a text without it has no words.
WORD = r"[^\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for NULL.

    Every word is cut down to one letter and what is left without blanks is
    measured, so that no array of words is built.
    """
    short = F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "w")
    return F.coalesce(F.length(F.translate(short, BLANKS, "")), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """``source, source_size, target``: one row per source, NULL counted as a source.

    Targets are proportional to the weights, but at most ``most`` times the size of
    the source; what is cut off is shared out among the others by weight until none
    is above. That is ``least(cap, weight * level)`` for one level, found from the
    running sums over the sources in order of ``cap / weight``. The table has a row
    per source, so the unpartitioned windows see no more than that.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.select(
        "*",
        F.get(listed, place % len(weights)).alias("weight"),
        (most * F.col("source_size")).alias("cap"),
    )
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    goal = share * F.sum("source_size").over(everything)
    ranked = ranked.select(
        "*",
        (goal - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
        (
            F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
        ).alias("heft"),
    )
    # The level if this source and all after it stay below their caps.
    level = F.col("left") / F.col("heft")
    fits = level * F.col("weight") <= F.col("cap")
    ranked = ranked.select("*", F.when(fits, level).alias("level"))
    # The first that fits has the level of all after it; those before it are at their caps.
    first = F.first("level", ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, 0)
    )
    return ranked.select(
        "source",
        "source_size",
        "n_docs",
        F.coalesce(F.least(F.col("cap"), F.col("weight") * first), F.col("cap")).alias("target"),
    )


def numbered(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``rows`` with ``nth``: equal rows are numbered from 1.

    Equal rows are counted, which combines them before the shuffle, and made again from
    their number. A number above ``chunk`` is dealt out in chunks first, so that no task
    makes a large group on its own.
    """
    (n,) = free_names(rows, "_n")
    counted = stored(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(n)), "equal-rows")

    def several(table: DataFrame, first: Column, last: Column) -> DataFrame:
        return table.select(*rows.columns, F.explode(F.sequence(first, last)).alias("nth"))

    few = several(counted.where(F.col(n) <= chunk), F.lit(1).cast("bigint"), F.col(n))
    many = counted.where(F.col(n) > chunk)
    begins = F.sequence(F.lit(1).cast("bigint"), F.col(n), F.lit(chunk).cast("bigint"))
    many = many.withColumn("nth", F.explode(begins)).repartition(*rows.columns, "nth")
    last = F.least(F.col(n), F.col("nth") + F.lit(chunk - 1))
    return few.unionByName(several(many, F.col("nth"), last))


def _uniform(*parts: Column) -> Column:
    """A number from 0 to 1 that is the same in every run."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / float(1 << 53)


def _settled(x: Column, mass: Column) -> Column:
    return F.struct(
        x["doc_id"].alias("doc_id"),
        x["size"].alias("size"),
        (mass * 2 > x["size"]).cast("int").alias("more"),
    )


def _settle(rows: Column, level: int) -> Column:
    """One pass of pivotal rounding over an array: the settled and the rest.

    Every element has a size and a mass between 0 and its size, which stands for the
    probability of a further copy times the size. Two elements meet at a time: mass
    moves at random, without changing its expectation, until one has none or all of
    its size. That one is settled and the other meets the next element. Sums of masses
    do not change. Large documents go first, so that what is left over is small.
    """
    ordered = F.array_sort(rows)
    head = F.get(ordered, F.lit(0))
    nothing = F.filter(F.array(_settled(head, head["mass"])), lambda x: F.lit(False))
    begun = F.struct(head.alias("rest"), nothing.alias("done"))

    def step(state: Column, b: Column) -> Column:
        a = state["rest"]
        total = a["mass"] + b["mass"]
        low = F.greatest(F.lit(0.0), total - b["size"])
        high = F.least(a["size"].cast("double"), total)
        draw = _uniform(a["mix"], b["mix"], F.lit(level))
        mine = F.when(draw * (high - low) < a["mass"] - low, high).otherwise(low)
        theirs = total - mine
        # One of the two is at an end but for rounding errors: the nearer one.
        a_done = F.least(mine, a["size"] - mine) <= F.least(theirs, b["size"] - theirs)

        def rest(x: Column, mass: Column) -> Column:
            inside = F.greatest(F.lit(0.0), F.least(mass, x["size"].cast("double")))
            return x.withField("mass", inside)

        return F.struct(
            F.when(a_done, rest(b, theirs)).otherwise(rest(a, mine)).alias("rest"),
            F.concat(
                state["done"],
                F.array(F.when(a_done, _settled(a, mine)).otherwise(_settled(b, theirs))),
            ).alias("done"),
        )

    others = F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0)))
    return F.aggregate(others, begun, step)


def pivotal_copies(rows: DataFrame, group: int = GROUP) -> DataFrame:
    """``source, doc_id, size, more``: 0 or 1 further copy of every row of ``rows``.

    ``rows`` has ``source, doc_id, nth, size, mass, n_docs``; ``nth`` numbers equal rows
    and ``n_docs`` counts the rows of a source. Rows are dealt by a hash to arrays of
    about ``group``. Each array settles all its rows but one, and those rests go on to
    the next level of the tree until one row of a source is left, which takes the
    nearer of 0 and 1. An array is bounded whatever the size of a source. A source's
    words then differ from the sum of its masses by half a document at most.
    """
    current = rows.select(
        "source",
        F.col("n_docs").alias("n"),
        F.struct(
            (-F.col("size")).alias("order"),
            F.xxhash64("doc_id", "size", "nth").alias("mix"),
            "doc_id",
            "size",
            "mass",
        ).alias("row"),
    )
    most = rows.agg(F.max("n_docs")).first()[0] or 0
    outcome, level = None, 0
    while True:
        deals = F.ceil(F.col("n") / group).cast("bigint")
        met = (
            current.withColumn("n", deals)
            .groupBy("source", "n", F.pmod(F.xxhash64("row.mix", F.lit(level)), "n").alias("deal"))
            .agg(F.collect_list("row").alias("rows"))
            .select("source", "n", _settle(F.col("rows"), level).alias("s"))
        )
        met = stored(met.select("source", "n", "s.rest", "s.done"), f"rounding-{level}")
        done = met.select("source", F.inline("done"))
        outcome = done if outcome is None else outcome.unionByName(done)
        if most <= group:
            last = met.select("source", _settled(F.col("rest"), F.col("rest.mass")).alias("s"))
            return outcome.unionByName(last.select("source", "s.*"))
        current = met.select("source", "n", F.col("rest").alias("row"))
        most, level = -(-most // group), level + 1


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    group: int = GROUP,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` per row of ``docs``.

    A document is taken whole, ``copies`` times (0, 1 or 2 with the default of at most
    twice its size); ``taken`` counts its words with repeats. Sources are in code point
    order, NULL last. A text that is NULL or empty has size 0 and is never taken. An
    empty table gives an empty result. Repeated rows are mixed as rows of their own; a
    NULL ``doc_id`` is kept. Reruns agree: chance comes from hashes of ids and sizes.
    Further columns are passed over.
    """
    sizes = stored(
        docs.select(
            F.col("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
        ),
        "sizes",
    )
    targets = stored(source_targets(sizes, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    known = broadcast_if_few(
        targets.select(
            F.col("source").alias("_of"), "source_size", "target", "n_docs", rate.alias("rate")
        )
    )

    def with_targets(rows: DataFrame) -> DataFrame:
        return rows.join(known, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")

    mass = (F.col("rate") - F.floor("rate")) * F.col("size")
    rows = stored(with_targets(numbered(sizes)).withColumn("mass", mass), "masses")
    plain = rows.where("mass = 0").select("source", "doc_id", "size", F.lit(0).alias("more"))
    rounded = pivotal_copies(rows.where("mass > 0"), group)
    copies = F.when(F.col("size") > 0, F.floor("rate") + F.col("more")).otherwise(0).cast("int")
    return (
        with_targets(rounded.unionByName(plain))
        .withColumn("copies", copies)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
        )
    )
