"""Byte-level BPE with the tiktoken library: text to ids and ids to bytes."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgroups.llm.tables import free_names

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# Longer texts are cut where the split pattern is sure to begin a new piece.
CHUNK = 1 << 16
# Rows that are held as Python objects, and sent back, at a time.
SLICE = 256
# A single space between two letters or digits: no piece goes over it, and the pattern
# looks at nothing before its piece, so both sides encode as they do in the whole text.
_SAFE = re.compile(r"[^\W_](?= [^\W_])")
_BLANK = "[\t-\r \x85\xa0  -     　]"
# The pattern matcher recurses over blanks; very long runs go round it.
_BLANKS = re.compile(f"{_BLANK}{{50000,}}")


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """Encoding from a rank file on this machine, without special tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "local", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """``text`` cut at safe places, into pieces of about ``size`` if it has such places."""
    start = 0
    while len(text) - start > size:
        place = _SAFE.search(text, start + size)
        if place is None:
            break
        yield text[start : place.end()]
        start = place.end()
    yield text[start:]


def _encode_chunk(coder: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) < 50_000:
        return coder.encode_ordinary(text)
    ids, start = [], 0
    for run in _BLANKS.finditer(text):
        # The last blank before other text may belong to the next piece.
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += coder.encode_ordinary(text[start : run.start()])
        ids += coder._encode_single_piece(text[run.start() : end].encode())
        start = end
    return ids + coder.encode_ordinary(text[start:])


def encode_text(text: str, path: str = RANKS) -> list[int]:
    """Ids of one text, as ``encode_ordinary`` gives them for the whole of it."""
    coder = encoding(path)
    if len(text) <= CHUNK:
        return _encode_chunk(coder, text)
    return [i for chunk in chunks(text) for i in _encode_chunk(coder, chunk)]


def decode_ids(ids: list[int], path: str = RANKS) -> bytes:
    """The bytes of some ids; they need not be whole characters."""
    return encoding(path).decode_bytes(ids)


def with_token_ids(
    docs: DataFrame, text: str = "text", out: str = "ids", path: str = RANKS
) -> DataFrame:
    """Add ``out``: the ids of every whole text, as ``array<int>``.

    A text that is NULL or empty has no ids (an empty array). Long texts are cut only
    where a piece of the split pattern is sure to end. Rows are encoded one by one, so
    repeated rows, ties and empty tables need no rule; other columns are kept, one that
    is called ``out`` is replaced.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for i in range(0, max(1, len(batch)), SLICE):
                texts = batch.slice(i, SLICE).to_pylist()
                yield pa.array([encode_text(t or "", path) for t in texts], pa.list_(pa.int32()))

    return docs.withColumn(out, encode(F.col(f"`{text}`")))


def with_decoded(
    docs: DataFrame, ids: str = "ids", out: str = "decoded", path: str = RANKS
) -> DataFrame:
    """Add ``out``: the bytes that the ids stand for. NULL ids count as none; an id that
    the rank file lacks is an error. Other columns are kept."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for i in range(0, max(1, len(batch)), SLICE):
                lists = batch.slice(i, SLICE).to_pylist()
                yield pa.array([decode_ids(x or [], path) for x in lists], pa.binary())

    return docs.withColumn(out, decode(F.col(f"`{ids}`")))


def with_round_trip(docs: DataFrame, text: str = "text", path: str = RANKS) -> DataFrame:
    """Add ``ids`` and ``decoded``, as the two functions above do one after the other, in
    one pass: the text goes to Python once, and a task needs one Python worker, not two."""

    @F.arrow_udf("ids array<int>, decoded binary")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for i in range(0, max(1, len(batch)), SLICE):
                ids = [encode_text(t or "", path) for t in batch.slice(i, SLICE).to_pylist()]
                decoded = pa.array([decode_ids(x, path) for x in ids], pa.binary())
                yield pa.StructArray.from_arrays(
                    [pa.array(ids, pa.list_(pa.int32())), decoded], ["ids", "decoded"]
                )

    (name,) = free_names(docs, "_coded")
    coded = docs.withColumn(name, both(F.col(f"`{text}`")))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("ids", "decoded")]
    return coded.select(*kept, F.col(name)["ids"].alias("ids"), F.col(name)["decoded"].alias("decoded"))


def bpe_digest(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """Per document the number of ids, and digests of the ids and the decoded bytes."""
    coded = with_round_trip(docs.select("doc_id", "text"), path=path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
