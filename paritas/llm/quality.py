"""Quality by importance resampling.

Two generative models of hashed n-grams: one of the target (documents labelled
good), one of the raw text (all documents).  A document's score is the mean log
ratio of its n-grams under the two; its importance weight is that of an excerpt
of 200 n-grams at this mean.  Sampling without replacement by these weights is
taking the k largest of log weight plus Gumbel noise.  k is the number of
documents that score above the threshold that best tells good from poor labelled
documents.

N-grams are tokens (runs of letters and digits, or of ASCII punctuation, lower
case) and pairs of neighbouring tokens; a pair of equal tokens counts as one
feature, repetition.  The raw model counts every document.  The target model and
the threshold use at most 40 000 labelled rows (``LABELLED``), those of lowest
hash, a broadcast of bounded size.

Defined cases: a text without tokens scores 0.  Without labels of both kinds
nothing is rejected.  Labels other than 0 and 1 and labels of null ids are
ignored; of several labels of one doc_id the lowest counts.  Null text is empty.
Rows that repeat a doc_id (null ids among them) are judged each by its own text, with
the noise of that id.  Documents whose key equals that of rank k are kept all, so
ties may keep more than k.  A table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import Workspace, lean, release, ship, slices
from paritas.llm.shingles import SLICE_BYTES, as_bytes, mix, word_hashes

BUCKETS = 1 << 16
EXCERPT = 200
LABELLED = 40_000
#: Score steps of the histogram the threshold is read from, and its range on either side of 0.
_STEP, _RANGE = 1 / 512, 8
_ONE = 1 << 16  # fixed-point unit of sampling keys
_HALF = 1 << 47


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    kinds = np.full(256, 1, np.uint8)
    kinds[[i for i in range(128) if not (chr(i).isalnum() or chr(i) == "_")]] = 2
    kinds[[9, 10, 11, 12, 13, 32]] = 0
    return kinds


def _grams(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: ``(first, end, owner, bucket)`` of every n-gram; owners count from ``first``."""
    data, offsets = as_bytes(texts)
    for a, b in slices(np.diff(offsets).tolist(), SLICE_BYTES):
        hashes, bounds = word_hashes(data, offsets[a : b + 1], _kinds())
        owner = np.repeat(np.arange(b - a), np.diff(bounds))
        paired = owner[1:] == owner[:-1]
        pairs = mix(hashes[:-1] * np.uint64(0xD6E8FEB86659FD93) + hashes[1:])
        pairs[hashes[:-1] == hashes[1:]] = mix(np.array([1], np.uint64))[0]
        owners = np.concatenate([owner, owner[1:][paired]])
        found = np.concatenate([hashes, pairs[paired]]) >> np.uint64(48)
        yield a, b, owners, found.astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams per bucket, of all texts and of those labelled good, of this partition."""
    raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in lean(batches):
        is_good = np.asarray(batch.column("quality").fill_null(0)) == 1
        for a, _, owner, bucket in _grams(batch.column("text")):
            raw += np.bincount(bucket, minlength=BUCKETS)
            good += np.bincount(bucket[is_good[owner + a]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(good[some])], names=["bucket", "raw", "good"])


def _score(texts: pa.Array, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    score, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for a, b, owner, bucket in _grams(texts):
        count[a:b] = np.bincount(owner, minlength=b - a)
        score[a:b] = np.bincount(owner, weights=ratio[bucket], minlength=b - a)
    return score / np.maximum(count, 1), count


class Resampler:
    """The two models, fitted, with the threshold and the sample's size.

    ``fit`` counts the corpus once, scores it once and finds the key of rank k.
    """

    def __init__(self, id_col: str = "doc_id", text_col: str = "text", seed: int = 9):
        self.id_col, self.text_col, self.seed = id_col, text_col, seed
        self.threshold, self.k, self.cut = -float(_RANGE), None, None
        self.ratio = np.zeros(BUCKETS)

    def fit(self, docs: DataFrame, labels: DataFrame) -> Resampler:
        ship(docs.sparkSession)
        self.work = Workspace(docs.sparkSession, "quality")
        rows = docs.select(F.col(f"`{self.id_col}`").alias("id"), F.col(f"`{self.text_col}`").alias("text"))
        known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
        known = known.agg(F.min("quality").cast("long").alias("quality"))
        known = known.orderBy(F.xxhash64("id"), "id").limit(LABELLED)
        known = F.broadcast(self.work.write(known, "labels"))
        labelled = rows.join(known, "id", "left").select("text", "quality")
        counted = labelled.mapInArrow(_count, "bucket bigint, raw bigint, good bigint")
        counted = counted.groupBy("bucket").agg(F.sum("raw"), F.sum("good")).collect()  # BUCKETS rows at most
        raw, good = np.ones(BUCKETS), np.ones(BUCKETS)
        for bucket, n, g in counted:
            raw[bucket] += n
            good[bucket] += g
        if good.sum() > BUCKETS:
            self.ratio = np.log(good / good.sum()) - np.log(raw / raw.sum())
        scored = rows.join(known, "id", "left").select("id", "quality", self.score(F.col("text")).alias("s"))
        scored = scored.select("quality", "s.score", self.key(F.col("id"), F.col("s.score")).alias("key"))
        scored = self.work.write(scored, "scores")
        self.threshold = self._best_threshold(scored)
        self.k = scored.where(F.col("score") >= self.threshold).count()
        self.cut = self._key_of_rank(scored, self.k)
        return self

    def score(self, text: Column) -> Column:
        """Struct of ``score`` (mean log ratio) and ``n_grams``."""
        ratio = self.ratio

        @F.arrow_udf("struct<score: double, n_grams: bigint>")
        def scored(texts: pa.Array) -> pa.Array:
            score, count = _score(texts, ratio)
            release()
            return pa.StructArray.from_arrays([pa.array(score), pa.array(count)], names=["score", "n_grams"])

        return scored(text)

    def key(self, id_: Column, score: Column) -> Column:
        """Log weight plus Gumbel noise drawn from the id, as a fixed-point number."""
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(self.seed), id_, id_.isNull()), 11)
        u = (bits.cast("double") + 0.5) / F.lit(2.0**53)
        return F.floor((score * EXCERPT - F.log(-F.log(u))) * _ONE) + F.lit(_HALF)

    def _best_threshold(self, scored: DataFrame) -> float:
        """Where the share of good documents above plus poor ones below is largest; the middle, if a range is."""
        place = F.floor(F.least(F.greatest(F.col("score"), F.lit(-float(_RANGE))), F.lit(float(_RANGE))) / _STEP)
        bins = scored.where("quality IS NOT NULL").groupBy(place.alias("at")).agg(
            F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)
        ).orderBy("at").collect()  # as many rows as the histogram has steps at most
        good, poor = sum(b[1] for b in bins), sum(b[2] for b in bins)
        if not good or not poor:
            return -float(_RANGE)
        best, below_good, below_poor, found = -1, 0, 0, []
        edges = [b[0] for b in bins] + [bins[-1][0] + 1]
        for i, edge in enumerate(edges):
            gain = (good - below_good) * poor + below_poor * good
            since = edges[i - 1] + 1 if i else edge
            if gain > best:
                best, found = gain, [since, edge]
            if i < len(bins):
                below_good, below_poor = below_good + bins[i][1], below_poor + bins[i][2]
        return (found[0] + found[1]) / 2 * _STEP

    @staticmethod
    def _key_of_rank(scored: DataFrame, k: int) -> int | None:
        """The k-th largest key, digit by digit: three histograms of at most 65 536 rows."""
        if not k:
            return None
        prefix, left = 0, k
        for shift in (32, 16, 0):
            digit = F.shiftright("key", shift).bitwiseAND(0xFFFF).alias("digit")
            within = scored.where(F.shiftright("key", shift + 16) == prefix)
            for value, n in sorted(within.groupBy(digit).count().collect(), reverse=True):
                if left <= n:
                    prefix = prefix << 16 | value
                    break
                left -= n
        return prefix

    def kept(self, key: Column) -> Column:
        return F.lit(False) if self.cut is None else key >= F.lit(self.cut)


def quality_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_grams``, ``score``, ``sampling_key`` and ``kept``."""
    model = Resampler(id_col, text_col).fit(docs, labels)
    scored = docs.select(F.col(f"`{id_col}`").alias("id"), model.score(F.col(f"`{text_col}`")).alias("s"))
    scored = scored.select("id", "s.n_grams", "s.score", model.key(F.col("id"), F.col("s.score")).alias("sampling_key"))
    return scored.select(F.col("id").alias(id_col), "n_grams", "score", "sampling_key", model.kept(F.col("sampling_key")).alias("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents sampled, with all columns.  No row moves: the model goes to the rows."""
    model = Resampler(id_col, text_col).fit(docs, labels)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    id_, text = F.col(f"_row.`{id_col}`"), F.col(f"_row.`{text_col}`")
    scored = packed.select("_row", model.score(text).alias("_s"))
    return scored.where(model.kept(model.key(id_, F.col("_s.score")))).select("_row.*")
