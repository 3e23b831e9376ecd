"""Spelling variants: words one edit apart, found through a reduced alphabet.

Every letter is hashed to one of eight symbols, so a word becomes a reduced word,
and two words one edit apart have reduced words at most one edit apart.  The
vocabulary of reduced words is small; for each of them the full one-edit
neighbourhood is generated, as 64-bit codes, and joined with that vocabulary.
Being neighbours is symmetric, so a pair of reduced words is generated from one
side only: a deletion by the longer one, a replacement by the one with the
smaller symbol, none by an insertion.  Original words of neighbouring (or equal)
reduced words are candidates and are verified as strings.

Two reduced words shared by so many words that their candidates would be more
than ``MOST_PAIRS`` are not multiplied out: their words meet by position and
rest instead (the word without its i-th letter), a key that at most one word per
letter of the alphabet has.  Both ways give every pair; the second is linear in
words, the first much cheaper for the rest.

Defined cases: null texts have no words; a null id counts as empty text; rows that
repeat count each; rows without a near word are their own root; an empty table
gives no rows.  Words may have any length: work per word is linear in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import Workspace, ship
from paritas.llm.shingles import as_bytes, mix

#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: Candidates of two reduced words that are multiplied out at most.
MOST_PAIRS = 1 << 12
LEAST_LENGTH, LEAST_COUNT, SLIPS = 5, 3, 97

#: Bytes of text cut into words at a time (a longer word goes whole), and rows sent on at a time.
_SLICE, _ROWS = 4 << 20, 1 << 17
_LONG = 64  # bytes from which a word's checksum is taken by itself

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LENGTH = np.uint64(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


# Words of texts


def _is_letter(data: np.ndarray) -> np.ndarray:
    """A-Z, a-z and U+00C0 to U+00FF: in UTF-8 the latter are 0xC3 and one byte."""
    wide = data == 0xC3
    letter = _ASCII_LETTER[data] | wide
    letter[1:] |= wide[:-1]
    return letter


def _checksums(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray, before: np.ndarray, table: np.ndarray) -> np.ndarray:
    """crc32 of every word, continued from ``before``, that of what stands in front of it."""
    state = ~before
    open_ = np.flatnonzero(sizes < _LONG)
    for at in range(_LONG):
        open_ = open_[sizes[open_] > at]
        if not len(open_):
            break
        s = state[open_]
        state[open_] = table[(s ^ letters[starts[open_] + at]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out = ~state
    for i in np.flatnonzero(sizes >= _LONG):
        out[i] = zlib.crc32(letters[starts[i] : starts[i] + sizes[i]], int(before[i]))
    return out


def _words(data: np.ndarray, owner_ends: np.ndarray, prefixes: np.ndarray, slips: int, least: int, table: np.ndarray) -> pa.Array:
    """The words of a slice that have at least ``least`` letters, a letter of some of them lost.

    ``owner_ends``: where each text ends in ``data``; ``prefixes``: checksum of each text's id.
    """
    letter = _is_letter(data)
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    begins = np.concatenate([[0], owner_ends[:-1]])
    begins = begins[begins < len(data)]
    first[begins] = letter[begins]
    letters = _LOWER[data[letter]]
    place = np.cumsum(letter) - 1
    starts = place[first]
    if not len(starts):
        return pa.array([], pa.large_string())
    sizes = np.diff(np.append(starts, len(letters)))
    wide = np.concatenate([[0], np.cumsum(letters == 0xC3)])
    lengths = sizes - (wide[starts + sizes] - wide[starts])
    keep = lengths >= least
    changed: list[str] = []
    if slips:
        owner = np.searchsorted(owner_ends, np.flatnonzero(first), "right")
        sums = _checksums(letters, starts, sizes, prefixes[owner], table)
        hit = sums % np.uint32(slips) == 0
        for i in np.flatnonzero(hit & (lengths > least)).tolist():
            word = letters[starts[i] : starts[i] + sizes[i]].tobytes().decode()
            at = int(sums[i]) % len(word)
            changed.append(word[:at] + word[at + 1 :])
        keep &= ~hit
    ends = np.append(starts, len(letters)).astype(np.int64)
    whole = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(letters.tobytes())])
    return pa.concat_arrays([whole.filter(pa.array(keep)), pa.array(changed, pa.large_string())])


def _counter(slips: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _crc_table()
        for batch in batches:
            ids = ["" if i is None else str(i) for i in batch.column(0).to_pylist()]
            prefixes = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
            data, offsets = as_bytes(batch.column(1))
            at, end = int(offsets[0]), int(offsets[-1])
            while at < end:
                to = min(at + _SLICE, end)
                while to < end and (data[to] & 0xC0 == 0x80 or data[to] == 0xC3 or _ASCII_LETTER[data[to]]):
                    to += 1  # no word is cut
                lo = int(np.searchsorted(offsets, at, "right")) - 1
                hi = int(np.searchsorted(offsets, to, "left"))
                ends = np.minimum(offsets[lo + 1 : hi + 1], to) - at
                words = _words(data[at:to], ends, prefixes[lo:hi], slips, least, table)
                counted = pc.value_counts(words)
                found, n = counted.field("values").cast(pa.string()), counted.field("counts").cast(pa.int64())
                for k in range(0, len(found), _ROWS):
                    yield pa.RecordBatch.from_arrays([found.slice(k, _ROWS), n.slice(k, _ROWS)], ["word", "n"])
                at = to

    return run


def corpus_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    slips: int = 0,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``(word, n)``: maximal runs of Latin letters, A-Z lower-cased, of a least length and number over all texts.

    With ``slips`` = k, a run whose crc32 of ``<id>:<run>`` is divisible by k first
    loses the letter at that checksum modulo its length.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = rows.mapInArrow(_counter(slips, least_length), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# Codes of words and of words that lack a letter


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row, and where each word begins (one more entry than words)."""
    words = words.cast(pa.large_string())
    text = "".join(words.to_pylist()).encode("utf-32-le")
    points = np.frombuffer(text, np.uint32).astype(np.uint64) if text else np.zeros(0, np.uint64)
    return points, np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy())]).astype(np.int64)


def _symbols(points: np.ndarray) -> np.ndarray:
    return ((points * np.uint64(0x9E3779B1)) >> np.uint64(7)) % np.uint64(SYMBOLS)


class _Codes:
    """Polynomial codes of many words, of what is left of each without one letter, and of each with a letter raised."""

    def __init__(self, values: np.ndarray, bounds: np.ndarray):
        sizes = np.diff(bounds)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(len(values)) - bounds[self.owner]
        self.sizes = sizes.astype(np.uint64)
        powers = np.full(int(sizes.max(initial=0)) + 1, _BASE)
        powers[0] = 1
        self.power = np.multiply.accumulate(powers)[self.place]
        terms = values * self.power
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.sums = sums[bounds[1:]] - sums[bounds[:-1]]
        before = sums[:-1] - sums[bounds[:-1]][self.owner]
        self.rests = before + (self.sums[self.owner] - before - terms) * _INVERSE

    def whole(self) -> np.ndarray:
        return mix(self.sums + self.sizes * _LENGTH).view(np.int64)

    def without(self) -> np.ndarray:
        return mix(self.rests + (self.sizes[self.owner] - np.uint64(1)) * _LENGTH).view(np.int64)

    def raised(self, at: np.ndarray, by: np.ndarray) -> np.ndarray:
        own = self.owner[at]
        return mix(self.sums[own] + by * self.power[at] + self.sizes[own] * _LENGTH).view(np.int64)


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each word's reduced word and the code of it."""
    for batch in batches:
        points, bounds = _letters(batch.column("word"))
        symbols = _symbols(points)
        ends = pa.py_buffer(bounds.tobytes())
        text = pa.py_buffer((symbols + np.uint64(97)).astype(np.uint8).tobytes())
        reduced = pa.Array.from_buffers(pa.large_string(), batch.num_rows, [None, ends, text]).cast(pa.string())
        code = pa.array(_Codes(symbols + np.uint64(1), bounds).whole())
        yield pa.RecordBatch.from_arrays([*batch.columns, reduced, code], ["word", "n", "reduced", "code"])


def _neighbourhood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(code, size, other)``: codes of the reduced words one deletion or one larger symbol away."""
    for batch in batches:
        points, bounds = _letters(batch.column("reduced"))
        symbols = points - np.uint64(97)
        codes = _Codes(symbols + np.uint64(1), bounds)
        own, size = codes.whole(), batch.column("size").to_numpy()
        same = np.concatenate([[False], symbols[1:] == symbols[:-1]])[: len(symbols)] & (codes.place > 0)
        drop = np.flatnonzero(~same)  # of a run of one symbol any deletion leaves the same
        found = [(codes.owner[drop], codes.without()[drop])]
        for step in range(1, SYMBOLS):
            at = np.flatnonzero(symbols + np.uint64(step) < SYMBOLS)
            found.append((codes.owner[at], codes.raised(at, np.uint64(step))))
        for owner, other in found:
            for k in range(0, len(owner), _ROWS):
                part = owner[k : k + _ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[part]), pa.array(size[part]), pa.array(other[k : k + _ROWS])], ["code", "size", "other"]
                )


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, n, place, fresh, rest)``: a row for each letter a word can lack, and one (place -1) for the whole word.

    ``fresh`` is false where the letter before is the same: lacking either leaves the same rest.
    """
    for batch in batches:
        points, bounds = _letters(batch.column("word"))
        codes = _Codes(mix(points + np.uint64(1)), bounds)
        owner = np.concatenate([codes.owner, np.arange(batch.num_rows)])
        same = np.concatenate([[False], points[1:] == points[:-1]])[: len(points)] & (codes.place > 0)
        fresh = np.concatenate([~same, np.ones(batch.num_rows, bool)])
        place = np.concatenate([codes.place, np.full(batch.num_rows, -1)])
        rest = np.concatenate([codes.without(), codes.whole()])
        rows = max(1, _ROWS * 64 // max(64, int(codes.sizes.max(initial=0))))
        for k in range(0, len(owner), rows):
            part = pa.array(owner[k : k + rows])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name).take(part) for name in ("word", "n")),
                    *(pa.array(values[k : k + rows]) for values in (place, fresh, rest)),
                ],
                ["word", "n", "place", "fresh", "rest"],
            )


# Near words, forms and roots


def _verified(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")


def near_words(words: DataFrame, work: Workspace, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``(a, n_a, b, n_b)``: every pair of different words (``word``, ``n``; unique) one edit apart, once."""
    coded = work.write(words.select("word", "n").mapInArrow(_reduce, "word string, n long, reduced string, code long"), "coded")
    reduced = coded.groupBy("reduced", "code").agg(F.count(F.lit(1)).alias("size"))
    reduced = work.write(reduced, "reduced")
    there = reduced.select(F.col("code").alias("other"), F.col("size").alias("other_size"))
    linked = reduced.select("reduced", "size").mapInArrow(_neighbourhood, "code long, size long, other long").join(there, "other")
    alone = reduced.where("size > 1").select(F.col("code").alias("other"), "code", "size", F.col("size").alias("other_size"))
    linked = work.write(linked.select("other", "code", "size", "other_size").union(alone), "linked")

    many = F.col("size") * F.col("other_size") > most_pairs
    left = coded.select("code", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = coded.select(F.col("code").alias("other"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    few = linked.where(~many).select("code", "other").join(left, "code").join(right, "other").where("code <> other or a < b")

    crowded = linked.where(many)
    crowded = crowded.select("code").union(crowded.select("other")).distinct()
    rests = coded.join(crowded, "code", "left_semi").select("word", "n").mapInArrow(_rests, "word string, n long, place long, fresh boolean, rest long")
    one = rests.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "place", "fresh", "rest")
    two = rests.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("place_b"), "rest")
    replaced = one.join(two.withColumnRenamed("place_b", "place"), ["place", "rest"]).where("place >= 0 and a < b")
    longer = one.where("place >= 0 and fresh").join(two.where("place_b = -1"), "rest")
    return _verified(few).union(_verified(replaced)).union(_verified(longer)).select(
        F.least("a", "b").alias("a"),
        F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.greatest("a", "b").alias("b"),
        F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
    ).distinct()


def _roots(links: DataFrame, work: Workspace) -> DataFrame:
    """``(word, root)`` of words with a form: forms followed to the last, twice as far each round.

    A form occurs at least twice as often as its word, so a chain has fewer than 63 links and six rounds reach its end.
    """
    now = links.select("word", F.col("form").alias("root"))
    for step in range(6):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = work.write(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{step}")
        if step:
            work.drop(f"roots-{step - 1}")
        if now.where("moved").isEmpty():
            break
        now = now.drop("moved")
    return now.select("word", "root")


def spelling_variants(words: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``(word, n)``.

    ``n_near`` counts the words one inserted, deleted or replaced code point away.
    The form is that of them with the largest ``n`` (ties: first in code-point
    order) if it occurs at least twice as often as the word; the root is where
    forms lead.  Null words are left out.
    """
    spark = words.sparkSession
    ship(spark)
    work = Workspace(spark, "spelling")
    words = work.write(words.where("word is not null").select("word", "n"), "words")
    pairs = work.write(near_words(words, work, most_pairs), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("m"))
    both = both.union(pairs.select("b", "n_b", "a", "n_a"))
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("near").alias("near")))
    near = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    chosen = -F.col("best.m") >= 2 * F.col("n")
    near = work.write(
        near.select("word", "n_near", F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.m")).alias("form_n")), "near"
    )
    roots = _roots(near.where("form is not null"), work)
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def document_variants(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of whole texts, with slips of one letter planted by checksum."""
    return spelling_variants(corpus_words(docs, slips=SLIPS))
