"""Runs of words that repeat with a period, found by minimizers of several scales.

Where words repeat with period q, so do all hashes of word sequences and the least hash of
every window. At a scale, sequences are as long as the longest period looked for, so inside
a run equal ones stand whole periods apart; the two nearest of them give the period. Such a
pair seeds a run, which is extended word by word. Short periods are found by comparing
every word with the one a fixed number of words on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgroups.llm.hashing import mixed
from spendgroups.llm.tables import doc_key, free_names

# A run has at least this many words, and this many times its period.
LEAST_WORDS, REPEATS = 6, 4
# Periods up to this are found by direct comparison; a power of two.
SHORT = 8
# Words of the texts that are searched together; a longer text is searched alone.
TOGETHER = 1 << 19
RUN = "struct<start:bigint,length:bigint,period:bigint>"
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def _stretches(ids: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of words that are equal to the word ``lag`` on."""
    n = max(0, len(ids) - lag)
    same = np.zeros(n + 2, np.int8)
    same[1:-1] = ids[lag:] == ids[:n]
    edges = np.flatnonzero(np.diff(same))
    return edges[::2], edges[1::2]


def _slid(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of every ``width`` values in a row; a power of two."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def _seeds(grams: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of nearest equal minimizers that are more than half a scale and
    at most a whole scale apart."""
    width = scale // 2
    if len(grams) <= width:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    least = _slid(grams, width, np.minimum)
    # A value is the least of some window if the greatest of those windows' least is it.
    pad = np.zeros(width - 1, np.uint64)
    chosen = np.flatnonzero(_slid(np.concatenate([pad, least, pad]), width, np.maximum) == grams)
    chosen = chosen[np.argsort(grams[chosen], kind="stable")]
    value = grams[chosen]
    apart = chosen[1:] - chosen[:-1]
    near = (value[1:] == value[:-1]) & (apart > width) & (apart <= scale)
    return chosen[:-1][near], apart[near]


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many values the two begin with that are equal."""
    at, step, n = 0, 64, min(len(a), len(b))
    while at < n:
        differ = a[at : min(n, at + step)] != b[at : min(n, at + step)]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at += len(differ)
        step *= 2
    return n


def _extended(ids: np.ndarray, places: np.ndarray, lags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Stretches of equal words around the seeds, as begin, end and lag; each one once."""
    order = np.lexsort((places, lags))
    lag, end = 0, 0
    for place, next_lag in zip(places[order].tolist(), lags[order].tolist()):
        if next_lag != lag:
            lag, end = next_lag, 0
        if place < end:
            continue
        ahead = _reach(ids[place:], ids[place + lag :])
        behind = _reach(ids[:place][::-1], ids[: place + lag][::-1])
        end = place + ahead
        if ahead:
            yield place - behind, end, lag


def runs_of(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs in texts that stand one after the other, as rows ``start, length, period``.

    ``ids`` has a number for each word, equal for equal words, and after each text a number
    of its own, so that no run goes beyond a text. ``sizes`` are the numbers of words, in
    falling order: a scale looks only at the texts that are long enough for it.
    """
    found = []
    for lag in range(1, SHORT + 1):
        begins, ends = _stretches(ids, lag)
        found.append(np.column_stack([begins, ends - begins + lag, np.full(len(begins), lag)]))
    ends = np.cumsum(sizes + 1)
    scale, grams = 1, mixed(ids.astype(np.uint64) + np.uint64(1))
    while True:
        # The shortest run at the next scale has REPEATS periods of half a scale and a word.
        longer = int((sizes >= REPEATS * (scale + 1)).sum()) if scale >= SHORT else len(sizes)
        if not longer:
            break
        ids = ids[: ends[longer - 1]]
        grams = grams[: len(ids)]
        if len(grams) <= scale:
            break
        grams = mixed(grams[:-scale] * _FOLD + grams[scale:])
        scale *= 2
        if scale > SHORT:
            places, lags = _seeds(grams, scale)
            rows = [(a, z - a + q, q) for a, z, q in _extended(ids, places, lags)]
            found.append(np.array(rows, np.int64).reshape(-1, 3))
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] >= np.maximum(LEAST_WORDS, REPEATS * runs[:, 2])]
    # A stretch that repeats with a multiple of its period is found once for each.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _searched(texts: list[list[bytes]]) -> list[tuple[np.ndarray, bytes]]:
    """Runs and collapsed text of each text, given as words."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    begins = np.r_[0, np.cumsum(sizes + 1)]
    every = pa.array([w for i in order for w in texts[i]], pa.large_binary()).dictionary_encode()
    inside = np.ones(begins[-1], bool)
    inside[begins[1:] - 1] = False
    ids = np.empty(begins[-1], np.int64)
    ids[inside] = every.indices.to_numpy()
    ids[~inside] = len(every.dictionary) + np.arange(len(texts))
    runs = runs_of(ids, sizes)
    depth = np.zeros(begins[-1] + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    repeated = np.cumsum(depth) > 0
    cuts = np.searchsorted(runs[:, 0], begins)
    out: list = [None] * len(texts)
    for at, i in enumerate(order):
        mine = runs[cuts[at] : cuts[at + 1]] - [begins[at], 0, 0]
        kept = texts[i]
        if len(mine):
            gone = repeated[begins[at] : begins[at] + sizes[at]]
            kept = [w for w, g in zip(kept, gone.tolist()) if not g]
        out[i] = (mine, b" ".join(kept))
    return out


def _slices(words: Iterator[list[bytes]]) -> Iterator[list[list[bytes]]]:
    held, n = [], 0
    for text in words:
        if held and n + len(text) > TOGETHER:
            yield held
            held, n = [], 0
        held.append(text)
        n += len(text)
    if held:
        yield held


def _found(batch: pa.Array) -> pa.Array:
    # bytes.split() cuts at exactly the space and the bytes from 9 to 13.
    words = (t.as_buffer().to_pybytes().split() if t.is_valid else [] for t in batch)
    pairs = [pair for part in _slices(words) for pair in _searched(part)]
    table = np.concatenate([runs for runs, _ in pairs] or [np.empty((0, 3), np.int64)])
    ends = np.cumsum([0, *(len(runs) for runs, _ in pairs)], dtype=np.int32)
    fields = [pa.array(table[:, k].astype(np.int64)) for k in range(3)]
    runs = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
    texts = pa.array([text for _, text in pairs], pa.binary()).cast(pa.string())
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(pa.array(ends), runs), texts], ["runs", "collapsed"]
    )


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``runs`` and ``collapsed``: the periodic runs of every whole text, and the text
    without the words that only repeat what a run began with.

    Words are what stands between spaces and the characters 9 to 13. A run is a stretch of
    words with smallest period q, of at least 6 words and 4 periods, that no further word
    extends; runs are given by ``start`` (from 0), ``length`` and ``period`` in words, in order of
    start and period. ``collapsed`` has the words that are in no run after its first q
    words, joined by one space.

    A text that is NULL, empty or has no word has no run and an empty ``collapsed``. Rows are
    searched one by one, so repeated rows, ties and empty tables need no rule. Words are
    compared themselves; only the seeds of periods above 8 are hashes (of 64 bits). Other
    columns are kept; ones that are called ``runs`` or ``collapsed`` are replaced. The memory
    of a task grows with the longest text, not with the table.
    """

    @F.arrow_udf(f"runs array<{RUN}>, collapsed string")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _found(batch)

    (name,) = free_names(docs, "_periodic")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    found = docs.withColumn(name, search(F.col(f"`{text}`").cast("string")))
    return found.select(
        *kept, F.col(name)["runs"].alias("runs"), F.col(name)["collapsed"].alias("collapsed")
    )


def repeated_text(doc_id: Column, text: Column) -> Column:
    """The text, and for one id in ten its words from some place on replaced by repetitions
    of the first of them, so that a corpus has runs of all periods to be found."""
    h = doc_key(doc_id)
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = (F.lit(1) + F.floor((n - a) / (3 + g % 8))).cast("int")
        unit = F.slice(words, (a + 1).cast("int"), p)
        tail = F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int")))
        whole = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int")))
        return F.when(n > 0, F.array_join(whole, " "))

    # An array of one, so that the words are taken from the text only once.
    words = F.array(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return F.when(h % 10 == 0, F.get(F.transform(words, planted), F.lit(0))).otherwise(text)


def runs_digest(docs: DataFrame) -> DataFrame:
    """Per document the number of its runs, the longest one, and digests of all runs and of
    the collapsed text; texts are those that ``repeated_text`` makes."""
    texts = docs.select("doc_id", repeated_text(F.col("doc_id"), F.col("text")).alias("text"))
    # The greatest length, then the smallest start, then the smallest period.
    first = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")
            ),
        )
    )
    listed = F.transform(
        "runs",
        lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")),
    )
    length, period = first["length"], -first["p"]
    return with_runs(texts).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-first["s"]).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
