"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgroups.llm.tables import released, stored


def _folded(links: DataFrame) -> DataFrame:
    """Each link once, the smaller end first, without links from an id to itself."""
    return (
        links.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """``id, label``: every id that is linked with another (``a, b``), with the smallest id it
    can reach.

    In each round a node takes the smallest id among itself and its neighbours, and then
    what that one took; links are drawn anew between the ids taken, and those within one id
    go. Rounds end when no link is left. Ids in no particular order, such as hashes, make
    links shrink by a constant part a round. Links and labels stay in tables, which are
    stored before each join, so that a node with very many links is a side that can be
    split; nothing but the end of the rounds is known to the driver. Repeated links, links
    from an id to itself, links with a NULL end and an empty table are fine.
    """
    links = stored(_folded(links.select("a", "b")), "links")
    labels = None
    while True:
        both = links.union(links.select("b", "a"))
        taken = stored(
            both.groupBy(F.col("a").alias("id"))
            .agg(F.min("b").alias("label"))
            .select("id", F.least("id", "label").alias("label")),
            "taken",
        )
        ahead = taken.select(F.col("id").alias("label"), F.col("label").alias("next"))
        before, taken = taken, stored(
            taken.join(ahead, "label").select("id", F.col("next").alias("label")), "taken"
        )
        released(before)
        if labels is None:
            labels = taken
        else:
            step = taken.select(F.col("id").alias("label"), F.col("label").alias("next"))
            before, labels = labels, stored(
                labels.join(step, "label", "left").select(
                    "id", F.coalesce("next", "label").alias("label")
                ),
                "labels",
            )
            released(before)
        one, two = (
            taken.select(F.col("id").alias(end), F.col("label").alias(f"_{end}"))
            for end in ("a", "b")
        )
        before, links = links, stored(
            _folded(
                links.join(one, "a").join(two, "b").select(
                    F.col("_a").alias("a"), F.col("_b").alias("b")
                )
            ),
            "links",
        )
        released(before)
        if taken is not labels:
            released(taken)
        if links.isEmpty():
            return labels
