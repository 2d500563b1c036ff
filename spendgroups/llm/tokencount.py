"""Token counts with a shortcut for words that are one token."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

MODEL = public_tokenizers.path("word_bpe_49k.json")
LIMIT = 2048
SLICE = 256
# Words whose counts a Python worker remembers at most; then it starts anew.
REMEMBERED = 1_000_000
# Below this code point no character changes under NFC or depends on the Unicode version.
_PLAIN_END = 0x300


def _classes(kinds: str) -> str:
    """Characters of a Unicode category below the limit, as the inside of a class."""
    return "".join(
        re.escape(chr(c)) for c in range(_PLAIN_END) if unicodedata.category(chr(c))[0] == kinds
    )


_LETTER, _NUMBER = _classes("L"), _classes("N")
_BLANK = r"\t-\r \x85\xa0"
# The split pattern of the vocabulary file, for plain characters in lower case.
_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+"
)
_OTHER = re.compile("[^\\x00-\\u02ff]")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that the library encodes, each alone, as one token.

    An entry that ends a word is turned back into text and encoded; it counts if one
    token comes out. At most as many as the vocabulary has entries.
    """
    model = tokenizer(path)
    with open(path, encoding="utf-8") as file:
        suffix = json.load(file)["model"]["end_of_word_suffix"]
    table = {c: b for b, c in _byte_letters().items()}
    words = []
    for entry in model.get_vocab(with_added_tokens=False):
        if entry.endswith(suffix) and all(c in table for c in entry.removesuffix(suffix)):
            raw = bytes(table[c] for c in entry.removesuffix(suffix))
            try:
                words.append(raw.decode())
            except UnicodeDecodeError:
                continue
    coded = model.encode_batch(words, add_special_tokens=False)
    return frozenset(w for w, c in zip(words, coded) if len(c.ids) == 1)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand
    for themselves, the others for the letters from 256 on, in order."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + n) for n, b in enumerate(others)}


class Counter(dict):
    """Tokens of a word: 1 for the whole tokens, by merging for the rest."""

    def __init__(self, path: str, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.model, self.whole = tokenizer(path), whole
        special = [re.escape(t.content) for t in self.model.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special)) if special else None

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED + len(self.whole):
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = len(self.model.encode(word, add_special_tokens=False).ids)
        if len(word) < 100:
            self[word] = n
        return n

    def pieces(self, text: str) -> list[str]:
        """The pieces that are merged on their own. Plain texts are split here, others by
        the library, whose tables of characters may differ from Python's."""
        if _OTHER.search(text) is None:
            return _PIECES.findall(text.lower())
        text = self.model.normalizer.normalize_str(text)
        table = _letter_bytes()
        return [
            bytes(map(table.__getitem__, piece)).decode()
            for piece, _ in self.model.pre_tokenizer.pre_tokenize_str(text)
        ]

    def count(self, text: str) -> int:
        """Tokens of a text. Strings of special tokens are a token each, as by default."""
        parts = [text]
        if self.special is not None and "<|" in text:
            parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(p))) for p in parts)


@lru_cache(maxsize=1)
def _letter_bytes() -> dict[str, int]:
    return {c: b for b, c in _byte_letters().items()}


@lru_cache(maxsize=4)
def counter(path: str, whole: frozenset[str]) -> Counter:
    return Counter(path, whole)


def with_token_counts(
    docs: DataFrame, text: str = "text", out: str = "n_tokens", path: str = MODEL
) -> DataFrame:
    """Add ``out``: the number of tokens of every whole text, as the library counts them
    without begin and end tokens.

    A text that is NULL or empty has 0. Which strings are whole tokens is found
    once on the driver and sent to the tasks; that set is no larger than the vocabulary.
    Rows are counted one by one, so repeated rows, ties and empty tables need no rule;
    other columns are kept, one that is called ``out`` is replaced.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counted = counter(path, whole.value)
        for batch in batches:
            numbers = []
            for i in range(0, len(batch), SLICE):
                numbers += [counted.count(t) if t else 0 for t in batch.slice(i, SLICE).to_pylist()]
            yield pa.array(numbers, pa.int64())

    return docs.withColumn(out, count(F.col(f"`{text}`")))


def token_counts(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document."""
    counted = with_token_counts(docs.select("doc_id", "text"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
