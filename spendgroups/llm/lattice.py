"""Near-duplicate vectors by hashing to the cells of the E8 lattice.

A table projects every vector at random to two times eight dimensions and takes the
nearest point of the lattice E8 in each. Vectors meet where one's own cell is the cell or
a near neighbouring cell of the other, in any of the tables; what meets is verified by
cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgroups.llm.blocks import in_block_pairs, whole_groups
from spendgroups.llm.components import connected_components
from spendgroups.llm.hashing import mixed
from spendgroups.llm.tables import stored
from spendgroups.llm.vectors import dots, usable

LEAST = 0.9
TABLES = 12
HALVES = 2
# Neighbouring cells that are looked at besides the own one, in each half.
PROBES = 2
# Spread of the projections of unit vectors, in units of the lattice.
SPREAD = 0.5625
BLOCK = 1024
# Groups of up to so many vectors are verified many at a time, in gathered pairs of about so
# many components.
SMALL = 24
GATHERED = 1 << 18


def _even_points(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates and an even sum."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_points(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: whole coordinates with an even sum, or those moved by halves."""
    whole, half = _even_points(x), _even_points(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


@lru_cache(maxsize=1)
def shortest_steps() -> np.ndarray:
    """The 240 shortest steps from one lattice point to another."""
    steps = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            step = np.zeros(8)
            step[i], step[j] = a, b
            steps.append(step)
    signs = (s for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0)
    return np.array([*steps, *map(np.array, signs)])


@lru_cache(maxsize=8)
def _projections(d: int) -> np.ndarray:
    return np.random.default_rng(8).normal(size=(TABLES, HALVES, d, 8)) * SPREAD


def cells(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the cells to look at, per vector, and which of them is the own one of a
    table. Every choice of the own or a neighbouring point in each half is a cell."""
    n, d = unit.shape
    names = []
    for table in range(TABLES):
        total = np.full((n, 1), table + (d << 8), np.uint64)
        for half in range(HALVES):
            y = unit @ _projections(d)[table, half]
            home = nearest_points(y)
            steps = shortest_steps()
            # The closest neighbours are those along which the rest of y points most.
            gain = (y - home) @ steps.T - (steps**2).sum(axis=1) / 2
            best = np.argpartition(-gain, PROBES, axis=1)[:, :PROBES]
            points = np.concatenate([home[:, None], home[:, None] + steps[best]], axis=1)
            digits = (points * 2).astype(np.int64).astype(np.uint64)
            code = np.zeros(digits.shape[:2], np.uint64)
            for k in range(8):
                code = mixed(code ^ (digits[:, :, k] + np.uint64(k << 32)))
            total = mixed(total[:, :, None] * np.uint64(3) + code[:, None, :]).reshape(n, -1)
        names.append(total)
    own = np.zeros((TABLES, names[0].shape[1]), bool)
    own[:, 0] = True
    return np.concatenate(names, axis=1), own.ravel()


def _units(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors by length, as places and a matrix of unit vectors."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        x = flat.astype(np.float64).reshape(-1, d)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        yield at, x / np.sqrt(dots(x, x))[:, None]


def _cell_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            keys = part.column("key").to_numpy()
            for at, unit in _units(part.column("embedding")):
                names, own = cells(unit)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names.ravel().astype(np.int64)),
                        pa.array(np.repeat(keys[at], names.shape[1])),
                        pa.array(np.tile(own, len(at)).astype(np.int8)),
                    ],
                    ["cell", "key", "own"],
                )


def _pairs_in(
    begins: np.ndarray, sizes: np.ndarray, at_once: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs within groups, given where they begin; about ``at_once`` at a time."""
    ends = np.repeat(begins + sizes, sizes)
    rows = np.repeat(begins - np.r_[0, np.cumsum(sizes)][:-1], sizes) + np.arange(sizes.sum())
    after = ends - rows - 1
    total = np.cumsum(after)
    i, done = 0, 0
    while i < len(rows):
        j = max(i + 1, int(np.searchsorted(total, done + at_once, "right")))
        first = np.repeat(rows[i:j], after[i:j])
        second = first + 1 + np.arange(len(first))
        second -= np.repeat(total[i:j] - after[i:j] - done, after[i:j])
        if len(first):
            yield first, second
        i, done = j, total[j - 1]


def _close(
    unit: np.ndarray, own: np.ndarray, side: np.ndarray, begins: np.ndarray, least: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in the same group, one of them in its own cell, whose cosine may be
    ``least``. Groups lie one behind the other; in a group of two blocks, a pair has one of
    each, which ``side`` tells (-1 in a group of one block)."""
    sizes = np.diff(np.r_[begins, len(unit)])
    small = sizes <= SMALL
    at_once = max(1, GATHERED // unit.shape[1])
    for i, j in _pairs_in(begins[small], sizes[small], at_once):
        meet = (own[i] | own[j]) & ((side[i] < 0) | (side[i] != side[j]))
        i, j = i[meet], j[meet]
        near = np.einsum("ij,ij->i", unit[i], unit[j]) >= least - 1e-9
        yield i[near], j[near]
    for start, size in zip(begins[~small], sizes[~small]):
        rows = np.arange(start, start + size)
        one_block = side[start] < 0
        left = rows if one_block else rows[side[rows] == 0]
        right = rows if one_block else rows[side[rows] == 1]
        if not len(right):
            continue
        strip = -(-at_once // len(right))
        for k in range(0, len(left), strip):
            # In one block, each pair once: of a row and those behind it.
            across = right[k:] if one_block else right
            some = left[k : k + strip]
            near = unit[some] @ unit[across].T >= least - 1e-9
            near &= own[some][:, None] | own[across][None, :]
            i, j = np.nonzero(near)
            i, j = some[i], across[j]
            yield (i[i < j], j[i < j]) if one_block else (i, j)


def _verify(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for rows in whole_groups(batches, ["cell", "block_i", "block_j"]):
        names = [rows[c].to_numpy() for c in ("cell", "block_i", "block_j")]
        keys, own = rows["key"].to_numpy(), rows["own"].to_numpy() == 1
        side = np.where(names[1] == names[2], -1, rows["side"].to_numpy())
        for at, unit in _units(rows["embedding"].combine_chunks()):
            changed = np.zeros(len(at) - 1, bool)
            for name in names:
                changed |= name[at][1:] != name[at][:-1]
            begins = np.r_[0, np.flatnonzero(changed) + 1]
            found = [np.zeros((0, 2), np.int64)]
            for a, b in _close(unit, own[at], side[at], begins, least):
                x, y = keys[at[a]], keys[at[b]]
                good = (dots(unit[a], unit[b]) >= least) & (x != y)
                found.append(np.c_[np.minimum(x, y)[good], np.maximum(x, y)[good]])
            pairs = np.concatenate(found)
            pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
            pairs = pairs[np.r_[True, (pairs[1:] != pairs[:-1]).any(axis=1)][: len(pairs)]]
            if len(pairs):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"]
                )


def near_links(classes: DataFrame, least: float = LEAST) -> DataFrame:
    """``a, b``: pairs of different vectors (``key, embedding``) with a cosine of ``least``
    or more that share a cell.

    First only names of cells are counted. Cells that nobody shares are dropped before
    vectors move; a cell that very many share is dealt out in pairs of blocks.
    """
    rows = stored(classes.mapInArrow(_cell_rows, "cell bigint, key bigint, own byte"), "cells")
    shared = stored(
        rows.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("size"), F.sum("own").alias("owners"))
        .where("size > 1 AND owners > 0"),
        "shared-cells",
    )
    met = stored(rows.join(shared.select("cell", "size"), "cell"), "met")
    met = in_block_pairs(met.join(classes, "key"), "cell", "size", "key", BLOCK)
    where = ["cell", "block_i", "block_j"]
    found = (
        met.select(*where, "side", "key", "own", "embedding")
        .repartition(*where)
        .sortWithinPartitions(*where)
        .mapInArrow(partial(_verify, least=least), "a bigint, b bigint")
    )
    return found.distinct()


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors link when their cosine, in double precision, is ``least`` or more and a table
    brings them together; none below it link. Equal vectors are one class, whose links
    count for every copy. ``n_links`` counts other rows. A vector that is NULL, zero or has a
    NULL or non-finite component links with nothing; vectors of different lengths do not
    link. ``component_id`` is the smallest id that links reach; ``kept`` marks the row with
    that id. A NULL id is never the smallest and not kept; repeated rows count as vectors
    of their own. An empty table gives an empty result; other columns are passed over.
    """
    rows = vectors.select("vec_id", "embedding", usable().alias("usable"))
    rows = rows.select(
        "vec_id", F.when(F.col("usable"), F.col("embedding")).alias("embedding")
    ).withColumn("key", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding")))
    classes = stored(
        rows.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.first("embedding").alias("embedding"),
            F.min("vec_id").alias("first_id"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "vector-classes",
    )
    links = stored(near_links(classes.select("key", "embedding"), least), "near-links")
    both = links.union(links.select("b", "a"))
    copies = classes.select(F.col("key").alias("b"), "copies")
    linked = both.join(copies, "b").groupBy(F.col("a").alias("key")).agg(F.sum("copies").alias("n"))
    parts = connected_components(links).withColumnRenamed("id", "key")
    known = classes.join(linked, "key", "left").join(parts, "key", "left")
    known = stored(
        known.select(
            "key",
            "first_id",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("label", "key").alias("label"),
        ),
        "linked",
    )
    least_id = known.groupBy("label").agg(F.min("first_id").alias("component_id"))
    ends = stored(known.join(least_id, "label").select("key", "n_links", "component_id"), "ends")
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "key").join(ends, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
