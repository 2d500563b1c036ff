"""Which rows of a large table have their key in another table, without shuffling the rows.

A table of bits, sent to every task, tells most of them; the few keys that it lets through
though they are not listed are found on the keys alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgroups import session
from spendgroups.llm.tables import free_names, stored
from spendgroups.session import broadcast_if_few

# At least so many bits for a key, and at most so many set by each. Beyond the most bits more
# keys are let through, and none is lost.
BITS_EACH, SET_EACH = 16, 6
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27


def bits_for(count: int) -> tuple[int, int]:
    """How many bits a table of ``count`` keys gets, and how many of them each key sets."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << int(count * BITS_EACH).bit_length()))
    return size, max(1, min(SET_EACH, round(0.7 * size / max(1, count))))


def places(hashes: np.ndarray, size: int, each: int) -> Iterator[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(each):
        yield (hashes + np.uint64(i) * step) & np.uint64(size - 1)


def all_set(bits: np.ndarray, hashes: np.ndarray, each: int) -> np.ndarray:
    """Whether all bits of a hash are set; ``bits`` has eight of them in each number."""
    found = np.ones(len(hashes), bool)
    for place in places(hashes, 8 * len(bits), each):
        found &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def may_have(hashes: DataFrame, count: int) -> Callable[[Column], Column]:
    """Tells of a hash whether it may be among ``hashes`` (one column, no NULLs); never false for
    one that is. ``count`` is how many there are."""
    size, each = bits_for(count)

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_numpy().astype(np.uint64)
            for place in places(found, size, each):
                word = (place >> np.uint64(6)).astype(np.int64)
                bit = (place & np.uint64(63)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit)], ["word", "bit"])

    words = hashes.mapInArrow(set_bits, "word bigint, bit int").groupBy("word")
    words = words.agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    sent = hashes.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    @F.arrow_udf("boolean")
    def known(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            asked = batch.to_numpy(zero_copy_only=False).astype(np.uint64)
            yield pa.array(all_set(sent.value, asked, each))

    return known


def may_be_in(rows: DataFrame, key: str, table: DataFrame, other: str) -> DataFrame:
    """Rows whose ``key`` may be a value of ``other`` in a stored ``table`` (a NULL as well), for
    a join with it; all rows if the table is small enough to be sent to every task."""
    count = table.count()
    if count <= session.FEW_LISTED:
        return rows
    hashed = table.select(F.xxhash64(other).alias("hash"))
    return rows.where(may_have(hashed, count)(F.xxhash64(key)))


def with_listed(
    rows: DataFrame, keys: list[str], listed: DataFrame, everything: DataFrame, out: str
) -> DataFrame:
    """``rows`` with ``out``: whether their ``keys`` are in ``listed``, a stored table.

    The tables have the first key, never NULL, and others that may be, as columns in the same
    order; each row of ``listed`` is there once. ``everything`` has the keys of all rows.
    """
    ours = free_names(rows, *(f"_key{i}" for i in range(len(keys))), "_found")
    found = ours.pop()

    def joined(table: DataFrame) -> DataFrame:
        table = broadcast_if_few(table.toDF(*ours).withColumn(found, F.lit(True)))
        same = F.col(keys[0]) == F.col(ours[0])
        for key, our in zip(keys[1:], ours[1:]):
            same = same & F.col(key).eqNullSafe(F.col(our))
        return rows.join(table, same, "left")

    count = listed.count()
    if count <= session.FEW_LISTED:
        there = F.coalesce(F.col(found), F.lit(False))
        return joined(listed).withColumn(out, there).drop(*ours, found)
    named = everything.toDF(*ours).distinct()
    hashed = F.xxhash64(*ours)
    listed = listed.toDF(*ours)
    may = may_have(listed.select(hashed.alias("hash")), count)
    same = [named[our].eqNullSafe(listed[our]) for our in ours]
    wrong = stored(named.where(may(hashed)).join(listed, same, "left_anti"), "let-through")
    there = may(F.xxhash64(*keys)) & F.col(keys[0]).isNotNull() & F.col(found).isNull()
    return joined(wrong).withColumn(out, there).drop(*ours, found)
