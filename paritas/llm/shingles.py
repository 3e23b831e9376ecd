"""Word and shingle hashes of many texts at once, with numpy.

Texts are handled as UTF-8 bytes: the six white-space characters and A-Z are
single bytes that occur in no other character.  A word's hash is the polynomial
sum of a random 64-bit value per byte; a shingle's mixes the hashes of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from paritas.llm.common import slices

#: Bytes of text hashed at a time; bounds the arrays below.
SLICE_BYTES = 1 << 20
WORDS = 5

_BASE = np.uint64(0x9E3779B97F4A7C13)  # odd, 3 modulo 8
_STEP = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    """A random value per byte; white space counts nothing, A-Z count as a-z."""
    values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
    values[65:91] = values[97:123]
    values[[9, 10, 11, 12, 13, 32]] = 0
    return values


@lru_cache(maxsize=1)
def _blank() -> np.ndarray:
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    return blank


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse; a worker holds one table for all texts of a slice."""
    return _powers(1 << max(20, int(n - 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(data, offsets)`` of a string array; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """``(hash per word, bounds)``: the words of text i are ``bounds[i]:bounds[i + 1]``.

    ``kinds`` (a number per byte value, 0 for white space) also ends a word
    where the kind of byte changes.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    data, offsets = data[lo:hi], offsets - lo
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    blank = _blank()[data]
    first = np.empty(n, bool)
    first[0] = True
    if kinds is None:
        first[1:] = blank[:-1]
    else:
        kind = kinds[data]
        first[1:] = kind[1:] != kind[:-1]
    first[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(first & ~blank)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    up, down = powers(n)
    values = _byte_values()[data] * up[:n]
    return mix(np.add.reduceat(values, starts) * down[starts]), bounds


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than a shingle: the whole sequence."""
    data, offsets = as_bytes(texts)
    for a, b in slices(np.diff(offsets).tolist(), SLICE_BYTES):
        hashes, bounds = word_hashes(data, offsets[a : b + 1])
        long = np.zeros(0, np.uint64)
        if len(hashes) >= words:
            n = len(hashes) - words + 1
            long = hashes[:n].copy()
            for i in range(1, words):
                long = long * _STEP + hashes[i : n + i]
            long = mix(long)
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if j - i >= words:
                yield np.unique(long[i : j - words + 1])
            elif j > i:
                few = np.uint64(j - i)
                for h in hashes[i:j]:
                    few = np.uint64((int(few) * int(_STEP) + int(h)) & 0xFFFFFFFFFFFFFFFF)
                yield mix(np.array([few], np.uint64) ^ np.uint64(j - i))
            else:
                yield np.zeros(0, np.uint64)


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, bounds, byte offset from the first text)`` of markup tokens: words, cut before ``<`` and after ``>``."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    data, offsets = data[lo:hi], offsets - lo
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    blank = _blank()[data]
    first = data == 0x3C
    first[0] = True
    first[1:] |= blank[:-1] | (data[:-1] == 0x3E)
    first[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(first & ~blank)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds, starts
    up, down = powers(n)
    return mix(np.add.reduceat(_byte_values()[data] * up[:n], starts) * down[starts]), bounds, starts
