"""Nearest neighbours through learned partitions.

The neighbour graph of a sample is cut into balanced parts so that neighbours tend to stay
together. A small classifier learns which part a vector belongs to; it puts every row into
a part and sends every query to the parts that are most probable for it. There, all rows
are compared with the query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgroups.llm.blocks import groups
from spendgroups.llm.tables import stored
from spendgroups.llm.vectors import commonest_length, dots, matrix, usable

# The index is learned from at most this many rows, in the order of a hash.
SAMPLE = 8192
PARTS = 32
# A small sample is cut into fewer parts, of no fewer rows than this.
PART_ROWS = 24
GRAPH_DEGREE = 10
HIDDEN = 96
# The share of true neighbours that the parts visited have to hold, as measured on rows of
# the sample that the classifier has not seen.
RECALL = 0.95
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024


def sample_graph(x: np.ndarray, degree: int = GRAPH_DEGREE) -> np.ndarray:
    """For each row the places of the rows with the largest inner products."""
    out = np.empty((len(x), degree), np.int64)
    for i in range(0, len(x), 512):
        scores = x[i : i + 512] @ x.T
        scores[np.arange(len(scores)), i + np.arange(len(scores))] = -np.inf
        out[i : i + 512] = np.argpartition(-scores, degree, axis=1)[:, :degree]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part for each node of a graph, all of about the same size, with few edges between.

    It begins with halves along the directions of most spread. Then, in rounds, the nodes
    with most to gain move to the part that most of their neighbours are in, as long as
    no part grows or shrinks by more than a tenth.
    """
    part = np.zeros(len(x), np.int64)
    stack = [(np.arange(len(x)), 0, parts)]
    while stack:
        nodes, first, n = stack.pop()
        if n == 1:
            part[nodes] = first
            continue
        y = x[nodes] - x[nodes].mean(axis=0)
        direction = np.linalg.svd(y[:2048], full_matrices=False)[2][0]
        order = np.argsort(y @ direction, kind="stable")
        left = n // 2
        cut = len(nodes) * left // n
        stack += [(nodes[order[:cut]], first, left), (nodes[order[cut:]], first + left, n - left)]
    sizes = np.bincount(part, minlength=parts)
    most, fewest = len(x) / parts * 1.1 + 1, len(x) / parts * 0.9 - 1
    sources = np.repeat(np.arange(len(x)), graph.shape[1])
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (sources, part[graph.ravel()]), 1.0)
        np.add.at(votes, (graph.ravel(), part[sources]), 1.0)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] + 1 <= most and sizes[part[i]] - 1 >= fewest:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A classifier with one hidden layer, and how many parts a query is sent to."""

    centre: np.ndarray
    scale: float
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    visited: int

    def chances(self, x: np.ndarray) -> np.ndarray:
        """Scores of all parts for each vector; higher is likelier."""
        h = np.maximum((x - self.centre) / self.scale @ self.hidden + self.hidden_bias, 0.0)
        return h @ self.out + self.out_bias

    def part_of(self, x: np.ndarray) -> np.ndarray:
        return self.chances(x).argmax(axis=1)


def _train(x: np.ndarray, goal: np.ndarray, epochs: int = 25) -> Router:
    """Fit to the shares of the parts among the neighbours of each row, by Adam steps."""
    rng = np.random.default_rng(7)
    d, parts = x.shape[1], goal.shape[1]
    centre = x.mean(axis=0)
    scale = float(np.sqrt(((x - centre) ** 2).mean())) or 1.0
    weights = [
        rng.normal(size=(d, HIDDEN)) * np.sqrt(2 / d),
        np.zeros(HIDDEN),
        rng.normal(size=(HIDDEN, parts)) * np.sqrt(1 / HIDDEN),
        np.zeros(parts),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    z, step = (x - centre) / scale, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 128):
            rows = order[i : i + 128]
            a = z[rows] @ weights[0] + weights[1]
            h = np.maximum(a, 0.0)
            s = h @ weights[2] + weights[3]
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            e = (p - goal[rows]) / len(rows)
            back = (e @ weights[2].T) * (a > 0)
            slopes = [z[rows].T @ back, back.sum(axis=0), h.T @ e, e.sum(axis=0)]
            step += 1
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = 2e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return Router(centre, scale, *weights, visited=parts)


def learn_router(x: np.ndarray, parts: int, nearest: int, recall: float = RECALL) -> Router:
    """The classifier for a sample, and the number of parts that gives the recall."""
    if parts == 1:
        zero = np.zeros
        return Router(zero(x.shape[1]), 1.0, zero((x.shape[1], 1)), zero(1), zero((1, 1)), zero(1), 1)
    graph = sample_graph(x)
    part = balanced_parts(x, graph, parts)
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1.0)
    goal[np.arange(len(x)), part] += graph.shape[1] / 2
    goal /= goal.sum(axis=1, keepdims=True)
    seen = np.arange(len(x)) % 8 != 0
    router = _train(x[seen], goal[seen])
    # Of the unseen rows: in which place of their ranking is the part of each neighbour?
    test = np.flatnonzero(~seen)
    routed = router.part_of(x)
    rank = np.empty((len(test), parts), np.int64)
    order = np.argsort(-router.chances(x[test]), axis=1, kind="stable")
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(parts), order.shape), axis=1)
    scores = x[test] @ x.T
    scores[np.arange(len(test)), test] = -np.inf
    true = np.argpartition(-scores, nearest, axis=1)[:, :nearest]
    places = np.sort(np.take_along_axis(rank, routed[true], axis=1).ravel())
    router.visited = int(places[min(len(places) - 1, int(np.ceil(recall * len(places))))]) + 1
    return router


def _search(batches: Iterator[pa.RecordBatch], d: int, nearest: int) -> Iterator[pa.RecordBatch]:
    for group in groups(batches, ["part", "candidate_block", "query_block"]):
        ids, asks = group["vec_id"].to_numpy(), group["asks"].to_numpy() == 1
        x = matrix(group["embedding"], d)
        q, c = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(q) or not len(c):
            continue
        rows, columns = [], []
        for i in range(0, len(q), 256):
            mine = q[i : i + 256]
            scores = x[mine] @ x[c].T
            scores[ids[mine][:, None] == ids[c][None, :]] = -np.inf
            n = min(nearest, len(c))
            last = np.partition(scores, len(c) - n, axis=1)[:, len(c) - n]
            # What may differ in the last digits is kept, and ordered by the exact sums.
            slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(last), last, 0.0)))
            close = scores >= (last - slack)[:, None]
            a, b = np.nonzero(close & np.isfinite(scores))
            rows.append(mine[a])
            columns.append(c[b])
        a, b = np.concatenate(rows), np.concatenate(columns)
        exact = dots(x[a], x[b])
        order = np.lexsort((ids[b], -exact, ids[a]))
        a, b, exact = a[order], b[order], exact[order]
        start = np.r_[True, ids[a][1:] != ids[a][:-1]] if len(a) else np.empty(0, bool)
        first = np.maximum.accumulate(np.where(start, np.arange(len(a)), 0))
        top = np.arange(len(a)) - first < nearest
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[a][top]), pa.array(ids[b][top]), pa.array(exact[top])],
            ["query_id", "vec_id", "score"],
        )


def _routed(rows: DataFrame, router: Router, d: int, most: int, enough: int) -> DataFrame:
    """Rows with ``parts``: the parts in order of their chances, ``most`` of them."""
    sent = rows.sparkSession.sparkContext.broadcast(router)

    @F.arrow_udf("array<int>")
    def ranked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            order = np.argsort(-sent.value.chances(matrix(batch, d)), axis=1, kind="stable")
            order = order[:, :most].astype(np.int32)
            ends = np.arange(0, order.size + 1, order.shape[1], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(order.ravel()))

    return rows.withColumn("parts", ranked("embedding"))


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    nearest: int = 20,
    parts: int = PARTS,
    sample: int = SAMPLE,
    recall: float = RECALL,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` where ``queries`` holds.

    The nearest by inner product, in double precision on the vectors as they are, nearest
    first; of equal ones the smaller id. A row is never its own neighbour. All rows are
    indexed; the classifier is fitted on at most ``sample`` of them, cut into ``parts`` parts
    or into one for each 24 rows, if that is less. A query visits as many
    parts as the wanted ``recall`` takes, and more if those hold too few rows; if
    there are fewer than ``nearest`` other rows, it gets all of them.

    Vectors that are NULL, zero or have a NULL or non-finite component take no part, nor do rows
    without an id or with another number of components than most. A row that is repeated
    counts once. An empty table gives an empty result; other columns are passed over.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable() & F.col("vec_id").isNotNull()).select("vec_id", "embedding")
    d = commonest_length(rows)
    rows = stored(rows.where(F.size("embedding") == d).distinct(), "vectors")
    # Of equal vectors only so many can be in a result: the smallest ids, and the query.
    same = Window.partitionBy("embedding").orderBy("vec_id")
    kept = rows.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= nearest + 1)
    order = F.xxhash64("embedding", "vec_id")
    learned = kept.orderBy(order).limit(sample).select("embedding").toArrow()
    x = matrix(learned["embedding"], d) if d and len(learned) else np.zeros((0, max(d, 1)))
    parts = max(1, min(parts, len(x) // PART_ROWS))
    router = learn_router(x, parts, nearest, recall)
    placed = stored(
        _routed(kept.select("vec_id", "embedding"), router, d, 1, 0).select(
            "vec_id", "embedding", F.get("parts", F.lit(0)).alias("part")
        ),
        "placed",
    )
    # One row for each part.
    sizes = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    counts = F.array(*[F.lit(sizes.get(p, 0)) for p in range(parts)])
    asked = stored(
        _routed(rows.where(queries), router, d, parts, nearest + 1), "asked"
    )
    # The parts with the best chances, and further ones until there are rows enough.
    held = F.transform(F.col("parts"), lambda p: F.get(counts, p))
    before = F.transform(
        F.sequence(F.lit(0), F.size("parts") - 1),
        lambda i: F.aggregate(F.slice(held, 1, i), F.lit(0).cast("bigint"), lambda t, n: t + n),
    )
    visited = F.filter(
        F.arrays_zip(F.col("parts").alias("part"), before.alias("before")),
        lambda s: s["before"] <= nearest,
    )
    chosen = F.array_union(
        F.slice("parts", 1, router.visited), F.transform(visited, lambda s: s["part"])
    )
    asked = asked.select("vec_id", "embedding", F.explode(chosen).alias("part"))
    asked = stored(asked.withColumn("n", F.get(counts, F.col("part"))), "visits")
    load = {r["part"]: r["count"] for r in asked.groupBy("part").count().collect()}
    loads = F.array(*[F.lit(load.get(p, 0)) for p in range(parts)])
    mix = F.xxhash64("vec_id", F.lit(3))
    candidate_blocks = F.ceil(F.greatest(F.get(counts, F.col("part")), F.lit(1)) / CANDIDATE_BLOCK)
    query_blocks = F.ceil(F.greatest(F.get(loads, F.col("part")), F.lit(1)) / QUERY_BLOCK)

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n.cast("int") - 1))

    left = placed.select(
        "part",
        F.pmod(mix, candidate_blocks).cast("int").alias("candidate_block"),
        every(query_blocks).alias("query_block"),
        "vec_id",
        "embedding",
        F.lit(0).alias("asks"),
    )
    right = asked.select(
        "part",
        every(candidate_blocks).alias("candidate_block"),
        F.pmod(mix, query_blocks).cast("int").alias("query_block"),
        "vec_id",
        "embedding",
        F.lit(1).alias("asks"),
    )
    where = ["part", "candidate_block", "query_block"]
    found = (
        left.unionByName(right)
        .repartition(*where)
        .sortWithinPartitions(*where)
        .mapInArrow(
            partial(_search, d=max(d, 1), nearest=nearest),
            "query_id bigint, vec_id bigint, score double",
        )
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(by_score))
    return ranked.where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
