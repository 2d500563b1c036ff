"""Hashes of words and word runs, for whole batches of texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Fixed pseudo-random values by byte and by place; any others would do.
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTERS = _TABLE[_LOWER]
# Bytes hashed at a time.
WINDOW = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step: every input bit changes about half of the output bits."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the places where they begin and end. No NULLs."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, places, data = texts.buffers()
    ends = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)
    return raw, ends - ends[0]


def word_hashes(texts: pa.Array, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z as a-z, and where each text's words begin.

    ``in_word`` tells for every byte value whether words are made of it. The second
    array has one more entry than there are texts.
    """
    raw, ends = flat(texts)
    inside = in_word[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = ends[:-1][ends[:-1] < len(raw)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    # Places among the bytes of words only.
    count = np.cumsum(inside, dtype=np.int64)
    first = count[starts] - 1 if len(starts) else starts
    letters = raw[inside]
    last = np.r_[first[1:], len(letters)]
    hashes = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(last, first[i] + WINDOW, "right")))
        lengths = last[i:j] - first[i:j]
        part = letters[first[i] : last[j - 1]]
        place = np.arange(len(part)) - np.repeat(first[i:j] - first[i], lengths)
        weights = _odd(int(lengths.max()))
        sums = np.add.reduceat(_LETTERS[part] * weights[place], first[i:j] - first[i])
        hashes[i:j] = mixed(sums + lengths.astype(np.uint64))
        i = j
    return hashes, np.searchsorted(starts, ends)


class FrozenMap:
    """Places of 64-bit keys in a fixed array, for many look-ups at a time."""

    def __init__(self, keys: np.ndarray):
        keys = keys.astype(np.uint64)
        bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.places = np.full(1 << bits, -1, np.int32)
        slot = self._slot(keys)
        self.keys[slot], self.places[slot] = keys, np.arange(len(keys), dtype=np.int32)
        lost = np.flatnonzero(self.places[slot] != np.arange(len(keys)))
        order = np.argsort(keys[lost])
        self.lost, self.lost_places = keys[lost][order], lost[order].astype(np.int32)

    def __reduce__(self):
        """Sent as its keys, and built again where it arrives."""
        taken = np.flatnonzero(self.places >= 0)
        keys = np.zeros(len(taken) + len(self.lost), np.uint64)
        keys[self.places[taken]] = self.keys[taken]
        keys[self.lost_places] = self.lost
        return FrozenMap, (keys,)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if it is not there."""
        slot = self._slot(keys)
        found = self.places[slot]
        other = np.flatnonzero((self.keys[slot] != keys) & (found >= 0))
        found[other] = -1
        if len(self.lost) and len(other):
            at = np.minimum(np.searchsorted(self.lost, keys[other]), len(self.lost) - 1)
            found[other] = np.where(self.lost[at] == keys[other], self.lost_places[at], -1)
        return found
