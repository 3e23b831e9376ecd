"""Byte-level BPE encoding and decoding.

Texts are split without a regular expression.  Every code point gets a class
from a table, classes and their neighbours give one of eight symbols, and each
symbol is a transition function on eight states.  Functions compose
associatively, so boundaries come from a scan: all blocks of a run of text are
composed side by side, the blocks' functions are chained, and a second sweep
from the known entry states marks where pieces begin.

Pieces are hashed all at once; each distinct piece of a run is merged once, from
a cache of pieces.  Ids are laid out by array indexing, with the byte offset
where each token ends.  Decoding concatenates token bytes.  A hash never decides
the result: every encoded run is decoded and compared with its text, and a run
that differs would be encoded piece by piece.

The vocabulary is a file of ranks, found by name on each executor in the public
tokenizer package; it is not part of this repository.

Defined cases: null text is empty; empty text has no ids.  Texts of any length
are cut for processing only, at places where a piece begins.  Rows that repeat a
doc_id are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.llm.common import lean, ship, slices
from paritas.llm.shingles import as_bytes, mix, powers

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text processed at a time, and pieces a worker remembers; both bound memory.
RUN_BYTES = 1 << 20
CACHED_PIECES = 400_000

# Code point classes; white space is the Unicode property, fixed values.
_LETTER, _NUMBER, _OTHER, _SPACE, _BLANK = 1, 2, 3, 4, 5
_WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
# Contractions that end a word, fixed values.
_SHORT = "stmd"
_LONG = ("re", "ve", "ll")

# Symbols: letter, number, other, apostrophe of a contraction of 2 or 3 characters, a space that joins the
# piece after it, white space that stays with its run, the last character of a run that joins nothing.
_SYM_L, _SYM_N, _SYM_P, _SYM_Q2, _SYM_Q3, _SYM_JOIN, _SYM_RUN, _SYM_LAST = range(8)
# States: fresh start, in letters, in numbers, in others, after a joining space, in white space, 1 or 2 characters of a contraction to come.
_FRESH, _IN_L, _IN_N, _IN_P, _JOINED, _IN_W, _ONE_LEFT, _TWO_LEFT = range(8)


@lru_cache(maxsize=1)
def _machine() -> tuple[np.ndarray, np.ndarray]:
    """``(next state, piece begins)`` by ``state * 8 + symbol``."""
    step, begins = np.zeros((8, 8), np.uint8), np.ones((8, 8), bool)
    into = {_SYM_L: _IN_L, _SYM_N: _IN_N, _SYM_P: _IN_P, _SYM_Q2: _ONE_LEFT, _SYM_Q3: _TWO_LEFT,
            _SYM_JOIN: _JOINED, _SYM_RUN: _IN_W, _SYM_LAST: _FRESH}
    for symbol, state in into.items():
        step[:, symbol] = state
    for symbol, state in ((_SYM_L, _IN_L), (_SYM_N, _IN_N), (_SYM_P, _IN_P)):
        begins[[state, _JOINED], symbol] = False
    begins[_IN_W, _SYM_RUN] = False
    for symbol in (_SYM_Q2, _SYM_Q3):  # inside other characters an apostrophe is one of them
        step[[_IN_P, _JOINED], symbol] = _IN_P
        begins[[_IN_P, _JOINED], symbol] = False
    step[_ONE_LEFT], step[_TWO_LEFT] = _FRESH, _ONE_LEFT
    begins[[_ONE_LEFT, _TWO_LEFT]] = False
    return step.ravel(), begins.ravel()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[_WHITE_SPACE] = _BLANK
    table[0x20] = _SPACE
    return table


def _symbols(points: np.ndarray, ends_text: np.ndarray) -> np.ndarray:
    """The symbol of each code point; ``ends_text`` marks the last one of each text."""
    kind = _classes()[points]
    white = kind >= _SPACE
    n = len(points)
    after = np.zeros(n + 2, points.dtype)
    after[:n] = points
    next_white = np.ones(n, bool)
    next_white[:-1] = white[1:]
    next_white |= ends_text
    symbol = (kind - 1).astype(np.uint8)
    symbol[white] = _SYM_RUN
    last = white & ~next_white
    symbol[last] = _SYM_LAST
    symbol[last & (kind == _SPACE)] = _SYM_JOIN
    quotes = np.flatnonzero((points == 0x27) & ~ends_text)
    if len(quotes):
        one, two = after[quotes + 1], after[quotes + 2]
        symbol[quotes[np.isin(one, [ord(c) for c in _SHORT])]] = _SYM_Q2
        room = ~ends_text[np.minimum(quotes + 1, n - 1)]
        for a, b in _LONG:
            symbol[quotes[room & (one == ord(a)) & (two == ord(b))]] = _SYM_Q3
    return symbol


def piece_starts(points: np.ndarray, starts_text: np.ndarray) -> np.ndarray:
    """Indices of code points where a piece begins; ``starts_text`` marks the first one of each text."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    step, begins = _machine()
    ends_text = np.ones(n, bool)
    ends_text[:-1] = starts_text[1:]
    symbol = _symbols(points, ends_text)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    grid = np.zeros(rows * width, np.uint8)
    grid[:n] = symbol
    fresh = np.zeros(rows * width, bool)
    fresh[:n] = starts_text
    # Column j of these holds the j-th character of every block.
    grid, fresh = np.ascontiguousarray(grid.reshape(rows, width).T), np.ascontiguousarray(fresh.reshape(rows, width).T)
    through = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))  # each block's function so far
    for j in range(width):
        through[fresh[j]] = _FRESH
        through = step[through * 8 + grid[j][:, None]]
    enter = np.zeros(rows, np.uint8)
    for r in range(1, rows):
        enter[r] = through[r - 1, enter[r - 1]]
    found = np.empty((width, rows), bool)
    state = enter
    for j in range(width):
        state = np.where(fresh[j], _FRESH, state).astype(np.uint8)
        at = state * 8 + grid[j]
        found[j] = begins[at] | fresh[j]
        state = step[at]
    return np.flatnonzero(found.T.ravel()[:n])


class Vocabulary:
    """Ranks, token bytes and remembered pieces of one rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values()) + 1
        by_id = [b""] * size
        for token, rank in self.ranks.items():
            by_id[rank] = token
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.cache: dict[bytes, bytes] = {}

    def piece(self, piece: bytes) -> bytes:
        """Ids of one piece, four bytes each; what a worker remembers stays small that way."""
        rank = self.ranks.get(piece)
        if rank is not None:
            return rank.to_bytes(4, sys.byteorder)
        known = self.cache.get(piece)
        if known is None:
            known = np.array(self._merge(piece), np.uint32).tobytes()
            if len(piece) <= 64:
                if len(self.cache) >= CACHED_PIECES:
                    self.cache.clear()
                self.cache[piece] = known
        return known

    def _merge(self, piece: bytes) -> list[int]:
        """Join the neighbours of lowest rank, leftmost first, until no two join."""
        ranks = self.ranks
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        if len(piece) < 48:
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    rank = ranks.get(parts[i] + parts[i + 1])
                    if rank is not None and (best is None or rank < best):
                        best, at = rank, i
                if best is None:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            return [ranks[p] for p in parts]
        # Long pieces: a heap of joins over a linked list; joins whose parts have changed are skipped.
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n:
                rank = ranks.get(parts[i] + parts[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, len(parts[i]), len(parts[j])))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] is None or j >= n or len(parts[i]) != a or len(parts[j]) != b:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [ranks[p] for p in parts if p is not None]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        return self.bytes[_spread(self.starts[ids], self.lengths[ids])]


@lru_cache(maxsize=2)
def vocabulary(name: str) -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name))


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all items of the given spans, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)


def _encode_run(data: np.ndarray, offsets: np.ndarray, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, ids before each text)`` of the texts ``offsets`` cuts out of ``data``."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = data[lo:hi].tobytes()
    if not raw:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    at = np.concatenate([[0], np.cumsum(width)])  # byte offset of each code point
    text_starts = np.unique(np.searchsorted(at, offsets[:-1] - lo))
    starts_text = np.zeros(len(points), bool)
    starts_text[text_starts[text_starts < len(points)]] = True
    starts = at[piece_starts(points, starts_text)]
    ends = np.append(starts[1:], len(raw))
    if len(raw) <= 4 * RUN_BYTES:
        up, down = powers(len(raw))
        sums = np.add.reduceat(_byte_values()[data[lo:hi]] * up[: len(raw)], starts) * down[starts]
        _, first, place = np.unique(mix(sums) ^ (ends - starts).astype(np.uint64), return_index=True, return_inverse=True)
    else:  # one piece longer than any run
        first = place = np.arange(len(starts))
    merged = [words.piece(raw[a:b]) for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    sizes = np.fromiter(map(len, merged), np.int64, len(merged)) // 4
    flat = np.frombuffer(b"".join(merged), np.uint32).astype(np.int64)
    before = np.cumsum(sizes) - sizes
    ids = flat[_spread(before[place], sizes[place])]
    if not np.array_equal(words.decode(ids), data[lo:hi]):  # two pieces with one hash
        merged = [words.piece(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        sizes = np.fromiter(map(len, merged), np.int64, len(merged)) // 4
        ids, place = np.frombuffer(b"".join(merged), np.uint32).astype(np.int64), np.arange(len(starts))
    ids_before = np.concatenate([[0], np.cumsum(sizes[place])])
    return ids, ids_before[np.searchsorted(starts, offsets - lo)]


def _cuts(data: np.ndarray, start: int, end: int) -> list[int]:
    """Where a long text may be cut: before a space between two ASCII letters or digits, about every run."""
    cuts, plain = [], _plain()
    while end - start > RUN_BYTES:
        at = start + RUN_BYTES
        while at < end:
            window = data[at - 1 : min(at + 4097, end)]
            good = np.flatnonzero((window[1:-1] == 0x20) & plain[window[:-2]] & plain[window[2:]])
            if len(good):
                at += int(good[0])
                break
            at += 4096
        if at >= end:
            break
        cuts.append(at)
        start = at
    return cuts


@lru_cache(maxsize=1)
def _plain() -> np.ndarray:
    return np.array([i < 128 and chr(i).isalnum() for i in range(256)])


def encode_texts(texts: pa.Array, name: str = VOCABULARY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(ids, byte offset where each token ends)`` per text, in order."""
    words = vocabulary(name)
    data, offsets = as_bytes(texts)
    sizes = np.diff(offsets).tolist()
    for a, b in slices(sizes, RUN_BYTES):
        if b == a + 1 and sizes[a] > RUN_BYTES:
            bounds = [int(offsets[a]), *_cuts(data, int(offsets[a]), int(offsets[b])), int(offsets[b])]
            parts = [_encode_run(data, np.array(pair), words)[0] for pair in zip(bounds, bounds[1:])]
            ids, split = np.concatenate(parts), None
        else:
            ids, split = _encode_run(data, offsets[a : b + 1], words)
        for i in range(b - a):
            own = ids if split is None else ids[split[i] : split[i + 1]]
            yield own, np.cumsum(words.lengths[own])


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind.to_pandas_dtype()), kind))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = VOCABULARY) -> DataFrame:
    """Per row of ``docs``: id, ``n_tokens``, ``ids`` and ``ends``, the byte offset where each token ends."""
    ship(docs.sparkSession)
    inner = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("_text"))
    schema = T.StructType(inner.schema.fields[:1]).add("n_tokens", T.LongType())
    schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("ends", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            text = batch.column(1)
            lengths = np.diff(as_bytes(text)[1]).tolist()
            for a, b in slices(lengths, 4 * RUN_BYTES):
                found = list(encode_texts(text.slice(a, b - a), name))
                counts = pa.array([len(ids) for ids, _ in found], pa.int64())
                columns = [batch.column(0).slice(a, b - a), counts, _lists([i for i, _ in found], pa.int32()), _lists([e for _, e in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return inner.mapInArrow(run, schema)


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", name: str = VOCABULARY) -> DataFrame:
    """Per row of ``tokens``: id and ``bytes``, the bytes its ids stand for (null ids: empty)."""
    ship(tokens.sparkSession)
    inner = tokens.select(F.col(f"`{id_col}`"), F.col(f"`{ids_col}`").cast("array<int>").alias("_ids"))
    schema = T.StructType(inner.schema.fields[:1]).add("bytes", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name)
        for batch in lean(batches):
            for i in range(batch.num_rows):
                ids = batch.column(1)[i].values
                found = words.decode(np.asarray(ids, np.int64)).tobytes() if ids is not None else b""
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([found], pa.binary())], names=schema.names)

    return inner.mapInArrow(run, schema)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = VOCABULARY) -> DataFrame:
    """Per row of ``docs``: id, ``n_tokens`` and the digests of its ids and of the bytes they decode to."""
    ship(docs.sparkSession)
    inner = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("_text"))
    schema = T.StructType(inner.schema.fields[:1]).add("n_tokens", T.LongType())
    schema = schema.add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name)
        for batch in lean(batches):
            counts, encoded, decoded = [], [], []
            for ids, _ in encode_texts(batch.column(1), name):
                counts.append(len(ids))
                encoded.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(words.decode(ids).tobytes()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return inner.mapInArrow(run, schema)
