"""Language identification by prediction by partial matching over bytes.

Every language has a tree of byte contexts of length 0 to 3 with counts of the bytes
that followed them in its texts. The code length of a text under a language is the sum
over its bytes of -log2 of the probability at the longest known context, with an escape
to the next shorter one where a byte was not seen. The shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgroups.llm.tables import doc_key, stored

ORDER = 3
# A context with its next byte is kept if it makes up this share of a language's bytes,
# so that a language has at most 1 / SHARE entries of each order. The counts cover all
# bytes; what is cut off is reached by escapes.
SHARE = 4e-6
# Code lengths are whole numbers of this part of a bit, so that sums are exact.
UNIT = 1 << 16
WINDOW = 1 << 20
UNKNOWN = "und"


def _laid_out(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, each after three zero bytes, with start and end places."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, places, data = texts.buffers()
    ends = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)
    ends = ends - ends[0]
    n = len(texts)
    starts = ends[:-1] + ORDER * np.arange(1, n + 1)
    stops = ends[1:] + ORDER * np.arange(1, n + 1)
    laid = np.zeros(len(raw) + ORDER * n, np.uint8)
    inside = np.ones(len(laid), bool)
    for back in range(1, ORDER + 1):
        inside[starts - back] = False
    laid[inside] = raw
    return laid, starts, stops


def _codes(laid: np.ndarray, first: int, last: int) -> np.ndarray:
    """For the places from ``first`` to ``last`` the three bytes before and the byte there."""
    b = laid[first - ORDER : last].astype(np.uint32)
    return (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else []
    return codes[first], np.add.reduceat(counts, first) if len(codes) else counts


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n) of a partition; texts with three bytes of context."""
    kept: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        langs, texts = batch.column("lang"), batch.column("text")
        for lang in pc.unique(langs).to_pylist():
            laid, starts, stops = _laid_out(texts.filter(pc.equal(langs, lang)))
            inside = np.zeros(len(laid) + 1, np.int8)
            np.add.at(inside, starts, 1)
            np.add.at(inside, stops, -1)
            inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
            parts = kept.setdefault(lang, [])
            for a in range(ORDER, len(laid), WINDOW):
                z = min(a + WINDOW, len(laid))
                parts.append(np.unique(_codes(laid, a, z)[inside[a:z]], return_counts=True))
            if len(parts) > 16:
                parts[:] = [_summed(*map(np.concatenate, zip(*parts)))]
    for lang, parts in kept.items():
        if parts:
            codes, counts = _summed(*map(np.concatenate, zip(*parts)))
            for i in range(0, len(codes), WINDOW):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(codes[i : i + WINDOW]), pa.string()),
                        pa.array(codes[i : i + WINDOW].astype(np.int64)),
                        pa.array(counts[i : i + WINDOW].astype(np.int64)),
                    ],
                    ["lang", "code", "n"],
                )


def context_counts(docs: DataFrame) -> DataFrame:
    """``lang, code, n``: how often each run of four bytes occurs in a language's texts."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counted = labelled.mapInArrow(_count_batches, "lang string, code bigint, n bigint")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def context_trees(counts: DataFrame, share: float = SHARE) -> DataFrame:
    """``depth, lang, code, n, total, kinds``: the kept entries of every order.

    ``total`` and ``kinds`` are the count and the number of different bytes that
    followed the entry's context, before anything was cut off.
    """
    size = counts.groupBy("lang").agg(F.sum("n").alias("size"))
    trees = None
    for depth in range(ORDER + 1):
        cut = F.col("code").bitwiseAND(F.lit((1 << (8 * (depth + 1))) - 1))
        entries = counts.groupBy("lang", cut.alias("code")).agg(F.sum("n").alias("n"))
        same = Window.partitionBy("lang", F.shiftright("code", 8))
        entries = entries.select(
            F.lit(depth).alias("depth"),
            "lang",
            "code",
            "n",
            F.sum("n").over(same).alias("total"),
            F.count(F.lit(1)).over(same).alias("kinds"),
        )
        trees = entries if trees is None else trees.unionByName(entries)
    # One row per language: as many as there are languages.
    enough = F.col("n") >= share * F.col("size")
    return trees.join(size, "lang").where((F.col("depth") == 0) | enough).drop("size")


class _Tree:
    """Probabilities of one language, as sorted arrays by order."""

    def __init__(self, rows: dict[str, np.ndarray]):
        self.orders = []
        for depth in range(ORDER + 1):
            mine = rows["depth"] == depth
            order = np.argsort(rows["code"][mine])
            code, n, total, kinds = (rows[c][mine][order] for c in ("code", "n", "total", "kinds"))
            context, first = np.unique(code >> 8, return_index=True)
            known = np.add.reduceat(n, first) if len(n) else n
            total1, kinds1 = total[first], kinds[first]
            self.orders.append(
                (
                    code,
                    -np.log2(n / (total + kinds)) if len(n) else n.astype(float),
                    context,
                    -np.log2((total1 - known + kinds1) / (total1 + kinds1)),
                )
            )

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each code after the bytes before it."""
        cost = np.full(len(codes), 8.0)
        for depth, (code, bits, context, escape) in enumerate(self.orders):
            if not len(code):
                continue
            wanted = codes & ((1 << (8 * (depth + 1))) - 1)
            at = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
            above = np.minimum(np.searchsorted(context, wanted >> 8), len(context) - 1)
            left = np.where(context[above] == wanted >> 8, escape[above], 0.0)
            cost = np.where(code[at] == wanted, bits[at], cost + left)
        return np.rint(cost * UNIT).astype(np.int64)


@dataclass
class LanguageModel:
    """Frozen statistics: the languages and, for each, the cost of every kept entry."""

    langs: list[str]
    trees: list[_Tree]
    codes: np.ndarray
    costs: np.ndarray
    keys: np.ndarray
    slots: np.ndarray
    shift: int

    @classmethod
    def from_trees(cls, trees: DataFrame) -> LanguageModel:
        """Collects the kept entries: at most 4 / SHARE for a language."""
        table = trees.toArrow()
        rows = {c: table[c].to_numpy() for c in ("depth", "code", "n", "total", "kinds")}
        lang = np.array(table["lang"].to_pylist(), dtype=object)
        langs = sorted(set(lang))
        built = [_Tree({c: x[lang == name] for c, x in rows.items()}) for name in langs]
        long = rows["depth"] == ORDER
        codes, where = np.unique(rows["code"][long], return_inverse=True)
        seen = np.zeros(len(codes), np.int64)
        np.add.at(seen, where, rows["n"][long])
        costs = np.array([t.bits(codes) for t in built]).reshape(len(langs), len(codes))
        width = max(8, int(np.ceil(np.log2(max(len(codes), 1) * 8))))
        shift = 32 - min(width, 24)
        keys = np.zeros(1 << (32 - shift), np.uint32)
        slots = np.full(len(keys), -1, np.int32)
        rare_first = np.argsort(seen, kind="stable")
        place = _slot(codes[rare_first].astype(np.uint32), shift)
        keys[place], slots[place] = codes[rare_first], rare_first  # the most frequent stays
        return cls(langs, built, codes, costs.astype(np.int32), keys, slots, shift)

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Code length of every text under every language, in units."""
        laid, starts, stops = _laid_out(texts)
        totals = np.zeros((len(self.langs), len(texts)), np.int64)
        for a in range(ORDER, len(laid), WINDOW):
            z = min(a + WINDOW, len(laid))
            codes = _codes(laid, a, z)
            place = _slot(codes, self.shift)
            entry = self.slots[place]
            missed = np.flatnonzero((self.keys[place] != codes) | (entry < 0))
            entry[missed] = 0
            rare, back = np.unique(codes[missed], return_inverse=True)
            i, j = np.searchsorted(stops, a, "right"), np.searchsorted(starts, z, "left")
            begin, end = np.clip(starts[i:j], a, z) - a, np.clip(stops[i:j], a, z) - a
            sums = np.zeros(z - a + 1, np.int64)
            for k, tree in enumerate(self.trees):
                cost = self.costs[k][entry] if len(self.codes) else np.zeros(z - a, np.int64)
                cost[missed] = tree.bits(rare.astype(np.int64))[back]
                np.cumsum(cost, out=sums[1:])
                totals[k, i:j] += sums[end] - sums[begin]
        return totals


def _slot(codes: np.ndarray, shift: int) -> np.ndarray:
    return (codes * np.uint32(2654435761)) >> np.uint32(shift)


def learn_languages(docs: DataFrame, share: float = SHARE) -> LanguageModel:
    """Statistics of all texts of ``docs`` (``lang, text``); rows with a NULL in either
    are left out, empty texts add nothing."""
    counts = stored(context_counts(docs), "contexts")
    return LanguageModel.from_trees(context_trees(counts, share))


RESULT = "lang string, score double, bits double"


def with_language(
    docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "language"
) -> DataFrame:
    """Add ``out``: a struct of the language, its share of the probability (0 to 1) and the
    bits per byte of its code.

    The whole text is coded. A text that is NULL, empty or has no letter is ``und`` with
    score 0 and no bits; so is every text if no language was learned. Of languages with
    equal lengths the first by code point wins. Rows are judged one by one; other columns
    are kept, one that is called ``out`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        for batch in batches:
            texts = batch.fill_null("")
            size = np.maximum(pc.binary_length(texts).to_numpy(zero_copy_only=False), 1)
            if not model.langs:
                n = len(texts)
                yield pa.StructArray.from_arrays(
                    [pa.nulls(n, pa.string()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64())],
                    ["lang", "score", "bits"],
                )
                continue
            lengths = model.lengths(texts)
            best = np.argmin(lengths, axis=0)
            least = lengths[best, np.arange(len(texts))]
            behind = np.minimum((lengths - least) / UNIT, 1000.0)
            score = 1.0 / np.exp2(-behind).sum(axis=0)
            names = pa.array(model.langs, pa.string()).take(pa.array(best))
            yield pa.StructArray.from_arrays(
                [names, pa.array(score), pa.array(least / UNIT / size)], ["lang", "score", "bits"]
            )

    # Else a filter on the result is pushed below it, and every text is coded twice.
    judge = judge.asNondeterministic()
    body = F.col(f"`{text}`")
    judged = F.when(body.rlike(r"\p{L}"), F.col(f"`{out}`"))
    judged = F.when(judged["lang"].isNotNull(), judged)
    nothing = F.struct(
        F.lit(UNKNOWN).alias("lang"),
        F.lit(0.0).alias("score"),
        F.lit(None).cast("double").alias("bits"),
    )
    return docs.withColumn(out, judge(body)).withColumn(out, F.coalesce(judged, nothing))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a document is kept out of learning: a quarter of them, by id."""
    return doc_key(doc_id) % 4 == 2


def language_ids(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    docs = docs.select("doc_id", "text", "lang")
    model = learn_languages(docs.where(~held_out()))
    return with_language(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )
