"""Exact search for the highest inner products, pruned by statistics of segments.

A vector is cut into equal segments, and of each the mean and the deviation are kept. For a
segment of length L the squared distance of two vectors is at least
``L ((m1 - m2)^2 + (s1 - s2)^2)``, so their inner product is at most ``L (m1 m2 + s1 s2)``. More
segments give a tighter bound. Rows whose bound, coarse to fine, stays below a score that
the result is known to reach are given up; what is left is scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgroups.llm.blocks import groups
from spendgroups.llm.tables import stored
from spendgroups.llm.vectors import commonest_length, matrix

# Rows of a block, the unit that a query is sent to, and queries scored together.
BLOCK, QUERIES = 4096, 256
# Rows against which every query is scored beforehand, for a first bound from below.
SEEDS = 1024
# Neighbouring blocks are judged together if there are more of them than this.
MOST_JUDGED = 4096
# Segments of the statistics that blocks are judged by.
SEGMENTS = 8
# Share of the pairs that may be left for the next bound to be taken pair by pair.
SPARSE = 0.1
# What rounding may take from a bound, as a share of the product of the two lengths.
ROUNDING = 1e-9
_LIMIT = (1 << 63) - 1


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each row's segments, times the root of the segment's length.

    The inner product of two such rows bounds the inner product of the vectors.
    """
    cuts = np.linspace(0, x.shape[1], segments + 1).astype(np.int64)
    out = np.empty((len(x), 2 * segments))
    for i, (a, z) in enumerate(zip(cuts, cuts[1:])):
        part = x[:, a:z].astype(np.float64)
        mean = part.mean(axis=1)
        out[:, i] = mean * np.sqrt(z - a)
        out[:, segments + i] = np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))
    return out


def _levels(d: int) -> list[int]:
    """Numbers of segments from coarse to fine; the finest have two components or so."""
    return [s for s in (1 << i for i in range(d.bit_length())) if s <= max(1, d // 2)]


def _integers(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of every row of ``a`` with every row of ``b``.

    Doubles hold them exactly while they stay below 2^53. Products that 64 bits cannot
    hold become the nearest number that they can.
    """
    most = _largest(a) * _largest(b) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most <= _LIMIT:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -_LIMIT - 1, _LIMIT).astype(np.int64)


def pair_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products row by row."""
    if _largest(a) * _largest(b) * max(1, a.shape[1]) <= _LIMIT:
        return np.einsum("ij,ij->i", a, b)
    whole = (a.astype(object) * b.astype(object)).sum(axis=1)
    return np.clip(whole, -_LIMIT - 1, _LIMIT).astype(np.int64)


class Block:
    """Candidates with their statistics at all resolutions."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        self.levels = [(s, segment_statistics(x, s)) for s in _levels(x.shape[1])]

    def _bounded(self, alive, q, norms, floor) -> np.ndarray:
        """``alive`` without the pairs whose bound is below the query's ``floor``."""
        for segments, mine in self.levels:
            asked = segment_statistics(q, segments)
            rows = np.flatnonzero(alive.any(axis=0))
            if not len(rows):
                break
            if alive.sum() > SPARSE * alive.size:
                bound = asked @ mine[rows].T + ROUNDING * norms[:, None] * self.norms[rows]
                alive[:, rows] &= bound >= floor[:, None]
            else:
                a, b = np.nonzero(alive)
                bound = np.einsum("ij,ij->i", asked[a], mine[b])
                bound += ROUNDING * norms[a] * self.norms[b]
                alive[a, b] = bound >= floor[a]
        return alive

    def best(
        self, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries and candidates with their scores: for each query what can be
        among its ``k`` best, given that they reach ``floor``."""
        norms = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        alive = ids[:, None] != self.ids[None, :]
        # The candidates with the highest bounds raise the floor before others are judged.
        segments, mine = self.levels[len(self.levels) // 2]
        bound = np.where(alive, segment_statistics(q, segments) @ mine.T, -np.inf)
        n = min(k, len(self.ids))
        likely = np.argpartition(-bound, n - 1, axis=1)[:, :n]
        likely_scores = np.stack([pair_scores(q, self.x[likely[:, j]]) for j in range(n)], axis=1)
        full = (np.take_along_axis(alive, likely, axis=1).sum(axis=1) >= k) & (n == k)
        floor = np.where(full, np.maximum(floor, likely_scores.min(axis=1).astype(np.float64)), floor)
        alive = self._bounded(alive, q, norms, floor)
        if alive.sum() > SPARSE * alive.size:
            exact = scores(q, self.x)
            a, b = np.nonzero(alive)
            found = exact[a, b]
        else:
            a, b = np.nonzero(alive)
            parts = [slice(i, i + 65536) for i in range(0, len(a), 65536)]
            found = [pair_scores(q[a[p]], self.x[b[p]]) for p in parts]
            found = np.concatenate(found) if found else np.empty(0, np.int64)
        # The complement falls as the score rises, and exists for every number.
        order = np.lexsort((self.ids[b], ~found, a))
        a, b, found = a[order], b[order], found[order]
        new = np.r_[True, a[1:] != a[:-1]] if len(a) else np.empty(0, bool)
        first = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
        top = np.arange(len(a)) - first < k
        return a[top], b[top], found[top]


def _statistics(batches: Iterator[pa.Array], d: int) -> Iterator[pa.Array]:
    for batch in batches:
        found = segment_statistics(_integers(batch, d), min(SEGMENTS, max(1, d)))
        ends = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))


def _judged(batches: Iterator[pa.RecordBatch], d: int, k: int, sent) -> Iterator[pa.RecordBatch]:
    """Queries with their floor and the groups of blocks that may hold one of their best."""
    seed_ids, seeds, lo, hi = sent.value
    half = lo.shape[1] // 2
    for batch in batches:
        for i in range(0, batch.num_rows, QUERIES):
            rows = batch.slice(i, QUERIES)
            ids, q = rows["vec_id"].to_numpy(), _integers(rows["x"], d)
            floor = np.full(len(ids), -np.inf)
            known = scores(q, seeds).astype(np.float64)
            known[ids[:, None] == seed_ids[None, :]] = -np.inf
            if len(seed_ids) >= k:
                floor = np.partition(known, len(seed_ids) - k, axis=1)[:, len(seed_ids) - k]
            asked = segment_statistics(q, half)
            mean, spread = asked[:, None, :half], asked[:, half:]
            # A group's mean times the query's is greatest at one end of its range.
            bound = np.maximum(mean * lo[None, :, :half], mean * hi[None, :, :half]).sum(axis=2)
            bound += spread @ hi[:, half:].T
            furthest = np.sqrt(np.maximum(lo**2, hi**2).sum(axis=1))
            slack = ROUNDING * np.sqrt((asked**2).sum(axis=1))[:, None] * furthest
            # Doubles round floors above 2^53.
            floor -= np.abs(np.where(np.isfinite(floor), floor, 0.0)) * 1e-12
            near = bound + slack >= floor[:, None]
            cells = np.nonzero(near)[1].astype(np.int32)
            ends = np.r_[0, np.cumsum(near.sum(axis=1))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    rows["vec_id"],
                    rows["x"],
                    pa.array(floor),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(cells)),
                ],
                ["vec_id", "x", "floor", "cells"],
            )


def _search(batches: Iterator[pa.RecordBatch], d: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best of each block for the queries sent to it; candidates come before queries."""
    at, held = None, None
    for group in groups(batches, ["block", "asks", "part"]):
        block = group["block"][0].as_py()
        ids, x = group["vec_id"].to_numpy(), _integers(group["x"], d)
        if group["asks"][0].as_py() == 0:
            at, held = block, Block(ids, x)
            continue
        if at != block:
            continue
        floor, version = group["floor"].to_numpy(), group["version"].to_numpy()
        for i in range(0, len(ids), QUERIES):
            mine = slice(i, i + QUERIES)
            a, b, found = held.best(ids[mine], x[mine], floor[mine], k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[mine][a]),
                    pa.array(version[mine][a]),
                    pa.array(held.ids[b]),
                    pa.array(found),
                ],
                ["query_id", "version", "vec_id", "score"],
            )


def top_products(
    vectors: DataFrame, queries: Column, nearest: int = 5, scale: int = 256, block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` (``vec_id, embedding``)
    where ``queries`` holds: the ``nearest`` highest inner products.

    Components x count as ``floor(scale * x)``, so scores are whole numbers and exact; one
    that 64 bits cannot hold is given as the nearest number that they can. Highest
    first; of equal ones the smaller id. A row is never found by a row with its id. If there
    are fewer than ``nearest`` other rows, a query gets all of them.

    Vectors that are NULL or have a NULL or non-finite component take no part, nor do rows
    without an id or with another number of components than most. Zero vectors do. A row
    that is repeated counts once; an id that stands on several vectors is as many
    candidates and as many queries, ranked apart. An empty table gives an empty result;
    other columns are passed over.

    Rows are laid out in blocks of about ``block`` rows that are alike in the means of their
    segments. Every query is scored against a fixed number of rows first. It is then sent to
    the blocks whose bounds reach the score it is sure of; the bounds known to all tasks
    are those of at most 4,096 groups of blocks. There, rows are given up by bounds that
    become finer, and what is left is scored.
    """
    spark = vectors.sparkSession
    finite = F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )
    rows = vectors.where(F.coalesce(finite, F.lit(False)) & F.col("vec_id").isNotNull())
    asks = F.coalesce(queries, F.lit(False)).alias("asked")
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale)).alias("x")
    rows = rows.select(F.col("vec_id").cast("bigint"), "embedding", whole, asks)
    d = commonest_length(rows)
    rows = rows.where(F.size("x") == d).groupBy("vec_id", "x").agg(F.max("asked").alias("asked"))
    rows = stored(rows, "vectors")
    size = max(d, 1)

    @F.arrow_udf("array<double>")
    def statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _statistics(batches, size)

    order = F.xxhash64("x", "vec_id")
    seeds = rows.orderBy(order, "vec_id").limit(SEEDS).select("vec_id", "x").toArrow()
    if not len(seeds) or not d:
        # Vectors without components have the product 0; ids alone decide.
        rows = rows.withColumn("x", F.array(F.lit(0).cast("bigint")))
        seeds = rows.orderBy("vec_id").limit(SEEDS).select("vec_id", "x").toArrow()
    x = _integers(seeds["x"], size)
    # Blocks of rows that lie on the same side of the seeds' median in most segments.
    middle = np.median(segment_statistics(x, min(SEGMENTS, size)), axis=0) if len(x) else []
    half = len(middle) // 2

    def stat(i: int) -> Column:
        return F.get("stats", F.lit(i))

    sides = [F.when(stat(i) > float(middle[i]), "1").otherwise("0") for i in range(half)]
    measured = rows.withColumn("stats", statistics("x"))
    measured = measured.withColumn("side", F.concat(F.lit(""), *sides))
    count = max(1, -(-rows.count() // block))
    placed = stored(
        measured.repartitionByRange(count, "side", order, "vec_id").select(
            F.spark_partition_id().alias("block"), "vec_id", "x", "stats"
        ),
        "placed",
    )
    blocks = placed.agg(F.max("block")).first()[0]
    width = 1 if blocks is None else -(-(blocks + 1) // MOST_JUDGED)
    spans = F.array(*[F.struct(F.min(stat(i)), F.max(stat(i))) for i in range(2 * half)])
    ranges = placed.groupBy(F.floor(F.col("block") / width).alias("cell")).agg(spans.alias("spans"))
    # At most MOST_JUDGED rows.
    listed = sorted((r["cell"], r["spans"]) for r in ranges.collect())
    cells = F.array(*[F.lit(int(cell)) for cell, _ in listed]).cast("array<int>")
    edges = np.array([[list(s) for s in spans] for _, spans in listed], np.float64)
    edges = edges.reshape(len(listed), 2 * half, 2)
    sent = spark.sparkContext.broadcast(
        (seeds["vec_id"].to_numpy(), x, edges[:, :, 0], edges[:, :, 1])
    )
    judged = rows.where("asked").select("vec_id", "x").mapInArrow(
        partial(_judged, d=size, k=nearest, sent=sent),
        "vec_id bigint, x array<bigint>, floor double, cells array<int>",
    )
    judged = judged.withColumn("cell", F.explode("cells"))
    first = F.get(cells, F.col("cell")) * width
    wanted = judged.withColumn("block", F.explode(F.sequence(first, first + width - 1)))
    parts = max(1, -(-rows.where("asked").count() // (4 * QUERIES)))
    asked = wanted.select(
        F.col("block").cast("int"),
        F.lit(1).alias("asks"),
        F.pmod(order, F.lit(parts)).cast("int").alias("part"),
        "vec_id",
        "x",
        F.xxhash64("x").alias("version"),
        "floor",
    )
    held = placed.select(
        "block",
        F.lit(0).alias("asks"),
        F.lit(0).alias("part"),
        "vec_id",
        "x",
        F.lit(0).cast("bigint").alias("version"),
        F.lit(0.0).alias("floor"),
    )
    found = (
        held.unionByName(asked)
        .repartition("block")
        .sortWithinPartitions("block", "asks", "part")
        .mapInArrow(
            partial(_search, d=size, k=nearest),
            "query_id bigint, version bigint, vec_id bigint, score bigint",
        )
    )
    best = Window.partitionBy("query_id", "version").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
