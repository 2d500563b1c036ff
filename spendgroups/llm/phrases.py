"""Phrases whose words stand together more often than chance, counted in stripes.

A stripe belongs to a prefix of zero to four words and counts the words that come next. The
stripes of a phrase length are merged word by word over the corpus. Each answers three
questions: which phrases go on from its prefix and how often (its entries), how often the
prefix occurs (its total), and, by the greatest entry, whether a longer phrase is as
frequent as a shorter one.

Lengths are counted one after the other. A phrase is only counted if its words without the
last, and without the first, are frequent, as a table of bits of fixed size tells; the
table may let rare phrases through, which costs work but no exactness.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgroups.llm.hashing import mixed, word_hashes
from spendgroups.llm.tables import stored
from spendgroups.session import broadcast_if_few

LONGEST, LEAST, BEST = 5, 100, 2000
# Bits of the table that says which phrases are frequent.
BITS = 1 << 25
# The stripe of the empty prefix, and of a prefix that makes up this share of all words, is
# cut by its words into so many cells, so that no task holds all that follows it. There
# are at most 1 / HOT such prefixes of a length.
CELLS, HOT = 64, 1 / 4096
# Stripes are dealt into so many packs for a language. A window has one row for a pack, and
# a task that merges holds one pack at a time.
PACKS = 2048
# Bytes of texts that a task counts together.
WINDOW = 12 << 20
SALTS = 16
_FOLD = np.uint64(0x9E3779B97F4A7C15)
_BREAK = b"."
# Ends of pieces, all written as one of them; letters A-Z as a-z.
_PLAIN = bytes.maketrans(
    b",;:!?\n\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b".........abcdefghijklmnopqrstuvwxyz"
)
# Stripes of a pack: prefixes and stripes are joined by line ends, the words of a stripe by
# spaces, which no word has. ``n`` has the counts of all words, ``total`` one for each stripe.
_PACK = "lang string, pack int, prefix string, next string, n array<bigint>, total array<bigint>"
PACK = pa.schema(
    [
        ("lang", pa.string()),
        ("pack", pa.int32()),
        ("prefix", pa.string()),
        ("next", pa.string()),
        ("n", pa.list_(pa.int64())),
        ("total", pa.list_(pa.int64())),
    ]
)
_STRIPE = "lang string, prefix string, total bigint, next string, n array<bigint>"
_ANY_BYTE = np.ones(256, bool)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - (BITS.bit_length() - 1))


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash for every word; none is empty."""
    return word_hashes(words.cast(pa.large_string()), _ANY_BYTE)[0]


def _seed(lang: str) -> np.uint64:
    return _hashes(pa.array([f"lang {lang}"]))[0]


def _lists(values: pa.Array | np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _joined(words: pa.Array, ends: np.ndarray, by: str) -> pa.Array:
    """One string for each stretch of words."""
    return pc.binary_join(_lists(words, ends), by)


def _split(joined: pa.Array, by: str) -> tuple[np.ndarray, pa.Array]:
    """The parts of all strings, and for each the place of its string."""
    lists = pc.split_pattern(joined, by)
    return pc.list_parent_indices(lists).to_numpy(), lists.flatten()


def _words(joined: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """As ``_split``, by spaces; an empty string has no word."""
    parent, words = _split(joined, " ")
    there = pc.not_equal(words, "")
    return parent[there.to_numpy(zero_copy_only=False)], words.filter(there)


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a piece does."""
    while len(text) > WINDOW:
        cut = text.rfind(_BREAK, 0, WINDOW)
        cut = text.find(_BREAK, WINDOW) if cut < 0 else cut
        if cut < 0:
            break
        yield text[:cut]
        text = text[cut + 1 :]
    yield text


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, of bounded size together unless a single piece is longer."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            if not text.is_valid:
                continue
            for part in _parts(text.as_buffer().to_pybytes().translate(_PLAIN)):
                if size + len(part) > WINDOW:
                    yield from held.items()
                    held, size = {}, 0
                held.setdefault(lang.as_py(), []).append(part)
                size += len(part)
    yield from held.items()


class _Text:
    """Words of a window as numbers."""

    def __init__(self, lang: str, parts: list[bytes]):
        marked = b" . "
        words = marked.join(parts).replace(_BREAK, marked).split()
        # Breaks at the end let a phrase be looked up from any place.
        words += [_BREAK] * 2
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.words = coded.dictionary.cast(pa.string())
        self.hashes = _hashes(self.words)
        self.seed = _seed(lang)
        places = np.arange(len(self.ids))
        ends = np.where(self.ids == self.ids[-1], places, len(places))
        # Words from each place to the end of its piece.
        self.left = np.minimum.accumulate(ends[::-1])[::-1] - places

    def frequent(self, length: int, bits: np.ndarray) -> np.ndarray:
        """Whether the phrase of that length at each place may be frequent."""
        out = np.zeros(len(self.ids), bool)
        at = np.flatnonzero(self.left >= length)
        slot = _slot(self.phrase_hashes(at, length))
        out[at] = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out

    def phrase_hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the phrases of that length at some places."""
        h = np.full(len(at), self.seed)
        for j in range(length):
            h = mixed(h * _FOLD + self.hashes[self.ids[at + j]])
        return h


def _numbered(columns: list[np.ndarray], size: int) -> np.ndarray:
    """One number per row, equal for rows that are equal in all columns of numbers below
    ``size``."""
    key, span = np.zeros(len(columns[0]), np.int64), 1
    for column in columns:
        if span > (1 << 62) // size:
            values, key = np.unique(key, return_inverse=True)
            span = len(values)
        key = key * size + column
        span *= size
    return key


def _counted(batches: Iterator[pa.RecordBatch], length: int, known) -> Iterator[pa.RecordBatch]:
    """Stripes of the prefixes of ``length`` words, one set for each window.

    ``known`` has the bits of the frequent phrases of that length and the hashes of the
    prefixes whose stripes have cells.
    """
    bits, hot = known.value
    for lang, parts in _windows(batches):
        text = _Text(lang, parts)
        ids, size = text.ids, len(text.words) + 1
        if length:
            may = text.frequent(length, bits)
            at = np.flatnonzero(may)
            goes_on = (text.left[at] > length) & may[at + 1]
            first = _numbered([ids[at + j] for j in range(length)], size)
        else:
            at = np.flatnonzero(text.left > 0)
            goes_on, first = np.ones(len(at), bool), np.zeros(len(at), np.int64)
        if not len(at):
            continue
        _, example, prefix = np.unique(first, return_index=True, return_inverse=True)
        # 0 is whatever comes next but is in no frequent phrase.
        following = np.where(goes_on, ids[at + length] + 1, 0)
        pairs, n = np.unique(prefix * size + following, return_counts=True)
        prefix, following = pairs // size, pairs % size
        hashes = text.phrase_hashes(at[example], length)
        cut = np.isin(hashes, hot) if length else np.ones(1, bool)
        cell = text.hashes[following - 1] % np.uint64(CELLS)
        cell[(following == 0) | ~cut[prefix]] = 0
        pack = ((hashes[prefix] + cell) % np.uint64(PACKS)).astype(np.int64)
        order = np.lexsort((following, cell, prefix, pack))
        prefix, following, cell, n, pack = (c[order] for c in (prefix, following, cell, n, pack))
        # Where stripes begin among the words, and packs among the stripes.
        begins = np.flatnonzero(_changes(prefix, cell, pack))
        packs = np.flatnonzero(_changes(pack[begins]))
        entry = following > 0
        ends = np.r_[0, np.cumsum(entry)][np.r_[begins, len(entry)]]
        pack_ends = np.r_[packs, len(begins)]
        if length:
            names = [text.words.take(pa.array(ids[at[example] + j])) for j in range(length)]
            names = pc.binary_join_element_wise(*names, " ")
        else:
            names = pa.array([""])
        stripes = _joined(text.words.take(pa.array(following[entry] - 1)), ends, " ")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(packs), pa.string()),
                pa.array(pack[begins][packs].astype(np.int32)),
                _joined(names.take(pa.array(prefix[begins])), pack_ends, "\n"),
                _joined(stripes, pack_ends, "\n"),
                _lists(n[entry], ends[pack_ends]),
                _lists(np.add.reduceat(n, begins), pack_ends),
            ],
            schema=PACK,
        )


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


class _Merged:
    """Stripes merged word by word."""

    def __init__(self) -> None:
        self.totals = pa.table({"stripe": pa.array([], pa.string()), "total": pa.array([], pa.int64())})
        self.entries = pa.table(
            {"stripe": pa.array([], pa.string()), "next": pa.array([], pa.string()), "n": pa.array([], pa.int64())}
        )

    def add(self, rows: pa.Table) -> None:
        rows = rows.combine_chunks()
        if not len(rows):
            return
        row, prefixes = _split(rows["prefix"].combine_chunks(), "\n")
        langs = rows["lang"].combine_chunks().take(pa.array(row))
        stripe = pc.binary_join_element_wise(langs, prefixes, "\n")
        parent, words = _words(_split(rows["next"].combine_chunks(), "\n")[1])
        totals = pa.table({"stripe": stripe, "total": rows["total"].combine_chunks().flatten()})
        entries = pa.table(
            {
                "stripe": stripe.take(pa.array(parent)),
                "next": words,
                "n": rows["n"].combine_chunks().flatten(),
            }
        )
        self.totals = _summed(pa.concat_tables([self.totals, totals]), "total")
        self.entries = _summed(pa.concat_tables([self.entries, entries]), "n")

    def stripes(self, least: int) -> Iterator[pa.RecordBatch]:
        """The stripes, with the words that follow at least that often."""
        often = self.entries.filter(pc.greater_equal(self.entries["n"], least))
        stripe = self.totals["stripe"].combine_chunks()
        place = pc.index_in(often["stripe"], value_set=stripe).to_numpy()
        order = np.argsort(place, kind="stable")
        ends = np.searchsorted(place[order], np.arange(len(stripe) + 1))
        words = often["next"].combine_chunks().take(pa.array(order))
        parts = pc.split_pattern(stripe, "\n", max_splits=1, reverse=True)
        yield from pa.table(
            {
                "lang": pc.list_element(parts, 0),
                "prefix": pc.list_element(parts, 1),
                "total": self.totals["total"],
                "next": _joined(words, ends, " "),
                "n": _lists(often["n"].to_numpy()[order], ends),
            }
        ).to_batches()


def _summed(rows: pa.Table, value: str) -> pa.Table:
    keys = [name for name in rows.column_names if name != value]
    summed = rows.group_by(keys, use_threads=False).aggregate([(value, "sum")])
    return summed.rename_columns([*keys, value])


def _merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Stripes of a sorted partition, merged; of the words the frequent ones stay."""
    held, last = _Merged(), None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        lang, pack = rows["lang"].combine_chunks(), rows["pack"].to_numpy()
        same = pc.equal(lang, lang[len(lang) - 1]).to_numpy(zero_copy_only=False) & (pack == pack[-1])
        # The last pack may go on in the next batch.
        cut = len(rows) - int(same.sum())
        if cut:
            held.add(rows.slice(0, cut))
        key = (lang[len(lang) - 1].as_py(), pack[-1])
        if cut or key != last:
            yield from held.stripes(least)
            held, last = _Merged(), key
        held.add(rows.slice(cut))
    yield from held.stripes(least)


def _phrase_hashes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch["lang"].dictionary_encode()
        seeds = np.array([_seed(lang) for lang in langs.dictionary.to_pylist()], np.uint64)
        h = seeds[langs.indices.to_numpy()]
        words = _hashes(_words(batch["phrase"])[1]).reshape(-1, length)
        for j in range(length):
            h = mixed(h * _FOLD + words[:, j])
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.astype(np.int64)), pa.array(_slot(h).astype(np.int64)), batch["f"]],
            ["hash", "slot", "f"],
        )


def _table_of_bits(slots: DataFrame) -> np.ndarray:
    """A bit for every ``slot``; at most ``BITS / 64`` rows are fetched."""
    words = slots.groupBy(F.shiftrightunsigned("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")
    )
    found = words.toArrow()
    table = np.zeros(BITS // 64, np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    return table.view(np.uint8)


def _entries(stripes: DataFrame) -> DataFrame:
    """``lang, words, prefix, phrase, f`` of every frequent phrase."""
    pairs = F.arrays_zip(F.split("next", " ").alias("next"), "n")
    cells = stripes.where("next <> ''").select("lang", "words", "prefix", F.explode(pairs).alias("e"))
    phrase = F.concat_ws(" ", F.nullif("prefix", F.lit("")), F.col("e")["next"])
    return cells.select(
        "lang",
        (F.col("words") + 1).alias("words"),
        "prefix",
        phrase.alias("phrase"),
        F.col("e")["n"].alias("f"),
    )


def phrase_stripes(texts: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang, words, prefix, total, next, n``: the merged stripes of all prefixes of
    up to ``longest - 1`` words that may occur ``least`` times.

    ``words`` is the length of the prefix; ``total`` counts its occurrences, whatever follows; a
    stripe that has cells is several rows, whose totals add up. ``next`` (joined by spaces) and ``n`` hold the words that make a
    frequent phrase.
    """
    context = texts.sparkSession.sparkContext
    levels: list[DataFrame] = []
    known = context.broadcast((None, None))
    for length in range(longest):
        if levels:
            hashed = _entries(levels[-1]).select("lang", "phrase", "f").mapInArrow(
                partial(_phrase_hashes, length=length), "hash bigint, slot bigint, f bigint"
            )
            hashed = stored(hashed, f"hashes-{length}")
            if hashed.isEmpty():
                break
            size = levels[0].agg(F.sum("total")).first()[0]
            hot = hashed.where(F.col("f") >= size * HOT).select("hash").toArrow()["hash"]
            known = context.broadcast((_table_of_bits(hashed), hot.to_numpy().astype(np.uint64)))
        keys = ["lang", "pack"]
        merged = (
            texts.mapInArrow(partial(_counted, length=length, known=known), _PACK)
            .repartition(*keys)
            .sortWithinPartitions(*keys)
            .mapInArrow(partial(_merge, least=least), _STRIPE)
            .withColumn("words", F.lit(length))
        )
        levels.append(stored(merged, f"stripes-{length}"))
    return reduce(DataFrame.unionByName, levels)


def _looked_up(cuts: DataFrame, counts: DataFrame, part: str) -> DataFrame:
    """``cuts`` with the count of their ``part``; a part that very many phrases have in common
    is dealt over several tasks.

    Neither side is broadcast: Spark would size them as before the copies of each row are made.
    """
    salted = cuts.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    counts = counts.withColumn("salt", every).hint("merge")
    return salted.join(counts, ["lang", part, "salt"]).drop("salt")


def _score(n: str = "n") -> Column:
    whole = "cast({} as decimal(19,0))".format
    above = f"cast(1000 as decimal(4,0)) * ({whole('a')} * {whole(n)})"
    return F.expr(f"({above}) div ({whole('l')} * {whole('r')})")


def phrase_collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, best: int = BEST
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``best`` phrases.

    Texts are lower-cased (A-Z) and cut into pieces at ``. , ; : ! ?`` and the characters 10 to
    13, pieces into words at spaces and tabs. A phrase of 2 to ``longest`` words is a candidate
    if it occurs ``a >= least`` times in the pieces of a language of ``n`` words. Of its cuts
    into a first part that occurs ``l`` times and a rest that occurs ``r`` times, the one with
    the lowest ``floor(1000 a n / (l r))`` gives the score; of equal ones the first. Candidates
    inside a longer candidate that is as frequent are dropped. Ranks go by score, then
    ``a``, both falling, then by the phrase in the order of its bytes.

    A NULL ``lang`` is ``und``; texts that are NULL, empty or without words count nothing; repeated
    rows count each; an empty table gives an empty result. Other columns are passed over.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.where("text IS NOT NULL").select(lang.alias("lang"), "text")
    stripes = phrase_stripes(texts, longest, least)
    entries = stored(_entries(stripes), "entries")
    totals = stripes.groupBy("lang", "prefix").agg(F.sum("total").alias("l"))
    totals = stored(totals, "totals")
    candidates = entries.where("words >= 2").select("lang", "phrase", "f", F.lit(None).cast("bigint").alias("longer"))
    # The most frequent phrase with a word more: behind, from the phrase's own stripe; in
    # front, from the stripes of all prefixes that end like it. Longer ones are no more frequent.
    none = F.lit(None).cast("bigint").alias("f")
    behind = stripes.where("words >= 2").select(
        "lang", F.col("prefix").alias("phrase"), none, F.array_max("n").alias("longer")
    )
    tail = F.expr("substring(phrase, locate(' ', phrase) + 1)")
    before = entries.where("words >= 3").select(
        "lang", tail.alias("phrase"), none, F.col("f").alias("longer")
    )
    kept = (
        candidates.unionByName(behind)
        .unionByName(before)
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("a"), F.coalesce(F.max("longer"), F.lit(0)).alias("longer"))
        .where("a > longer")
        .drop("longer")
    )
    words = F.size(F.split("phrase", " "))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), words - 1)))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("rest", F.expr("substring(phrase, char_length(head) + 2)"))
    cuts = _looked_up(cuts, totals.withColumnRenamed("prefix", "head"), "head")
    counts = entries.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = _looked_up(cuts, counts, "rest")
    sizes = totals.where("prefix = ''").select("lang", F.col("l").alias("n"))
    scored = cuts.join(broadcast_if_few(sizes), "lang").withColumn("score", _score())
    lowest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # The best of each salt first, so that the task of a language gets few rows.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    salted = lowest.select("lang", "phrase", "cut.*").withColumn("salt", salt)
    among = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    salted = salted.withColumn("rank", among).where(F.col("rank") <= best)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = salted.withColumn("rank", rank.cast("bigint"))
    return ranked.where(F.col("rank") <= best).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
