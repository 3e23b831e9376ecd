"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Components become integers, floor(256 x): the quantised impacts.  The index is
made of blocks of vectors; in each block a dimension's postings lie in order of
impact.  A query meets a block's postings by descending contribution (its own
component times the impact, so a negative component reads from the other end)
and adds them up.  After each step an unseen posting can add at most the next
contribution; vectors that can't reach the k-th best score known so far drop
out, and when few are left the rest is not read.  Those few are scored exactly.

Blocks are built where the rows are read.  Queries travel in batches.  A batch
first meets one block by itself, whose k-th best score is its floor everywhere;
then it meets the groups of blocks (an equi-join on the group's number) and keeps
its k best over the blocks of a group, so that later blocks stop earlier still.
What comes out of a group is k rows per query.  Where the segments of a dimension
end is searched for all queries of a batch at once.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part, nor do rows without an id.  A query meets vectors of its
own length.  Rows that repeat an id are candidates each, and none of them for a
query of that id; queries equal in id and vector are one.  Components beyond 2^62
after scaling end the query; scores must fit in 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paritas.llm.common import Workspace, ship

K, EVERY, SCALE = 5, 50, 256
BLOCK_ROWS, BATCH_QUERIES, GROUP_BLOCKS = 8192, 256, 4
#: Shares of a block's postings after which the proof is tried.
_STEPS = (0.15, 0.3, 0.45, 0.6, 0.8)
#: Added to every contribution, so that one weighted count gives a sum of contributions and their number.
_ONE = float(1 << 40)
_NO_FLOOR = -(1 << 63)


def _packed(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer matrices of up to ``size`` rows, by length of vector."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in rows:
        ids, vectors = batch.column(0).to_numpy(), batch.column(1)
        lengths = vectors.value_lengths().to_numpy()
        flat = np.floor(np.asarray(vectors.flatten(), np.float64) * SCALE)
        if len(flat) and np.abs(flat).max() > 2.0**62:
            raise OverflowError("a scaled component does not fit in 62 bits")
        flat = flat.astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        for dim in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == dim)
            parts = held.setdefault(dim, [])
            parts.append((ids[at], flat[starts[at][:, None] + np.arange(dim)]))
            if sum(len(i) for i, _ in parts) >= size:
                all_ids, matrix = (np.concatenate(c) for c in zip(*parts))
                whole = len(all_ids) // size * size
                for i in range(0, whole, size):
                    yield all_ids[i : i + size], matrix[i : i + size]
                held[dim] = [(all_ids[whole:], matrix[whole:])]
    for parts in held.values():
        all_ids, matrix = (np.concatenate(c) for c in zip(*parts))
        if len(all_ids):
            yield all_ids, matrix


def _small(matrix: np.ndarray) -> np.ndarray:
    fits = not matrix.size or (matrix.min() >= -(1 << 31) and matrix.max() < 1 << 31)
    return matrix.astype(np.int32) if fits else matrix


def _index(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, matrix in _packed(rows, BLOCK_ROWS):
        order = np.argsort(-matrix, axis=0, kind="stable").T.astype(np.uint16)  # postings of each dimension, highest impact first
        cells = [[matrix.shape[1]], [ids.tobytes()], [_small(matrix).tobytes()], [np.ascontiguousarray(order).tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["dim", "ids", "impacts", "postings"])


def _batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, matrix in _packed(rows, BATCH_QUERIES):
        cells = [[matrix.shape[1]], [ids.tobytes()], [matrix.tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["dim", "query_ids", "queries"])


class _Block:
    def __init__(self, dim: int, ids: bytes, impacts: bytes, postings: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        kind = np.int32 if len(impacts) == 4 * dim * len(self.ids) else np.int64
        self.matrix = np.frombuffer(impacts, kind).reshape(len(self.ids), dim).astype(np.int64)
        self.order = np.frombuffer(postings, np.uint16).reshape(dim, len(self.ids))
        self.impacts = np.take_along_axis(self.matrix.T, self.order.astype(np.int64), axis=1)  # descending per dimension
        self.rising = np.ascontiguousarray(-self.impacts)  # ascending, for binary search
        self.weights = self.impacts.astype(np.float64)

    def best(self, query: np.ndarray, own: int, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of every vector that may be among the k best, given the k-th best score known."""
        return next(self.best_of(query[None, :], [own], k, [floor]))

    def _limits(self, queries: np.ndarray) -> np.ndarray:
        """Per query the contributions at which its segments end, falling: quantiles of a sample of contributions."""
        sample = self.impacts[:, :: max(1, len(self.ids) // 64)]
        out = np.empty((len(queries), len(_STEPS)), np.int64)
        for i, query in enumerate(queries):
            dims = np.flatnonzero(query)
            gains = (query[dims][:, None] * sample[dims]).ravel() if len(dims) else np.zeros(1, np.int64)
            out[i] = np.quantile(gains, [1 - s for s in _STEPS]).astype(np.int64)
        return np.minimum.accumulate(out, axis=1)

    def _ends(self, queries: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(begin, end)`` by query, dimension and segment: postings that contribute the limit or more.

        A positive component reads from the high end to ``end``, a negative one from the low end back to ``begin``.
        """
        n = len(self.ids)
        shape = (*queries.shape, limits.shape[1])
        begin, end = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for d in range(queries.shape[1]):
            q = queries[:, d]
            high, low = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
            if len(high):  # impact >= limit / q
                end[high, d] = np.searchsorted(self.rising[d], -(-(-limits[high] // q[high][:, None])), side="right")
            if len(low):  # impact <= limit / q
                begin[low, d] = np.searchsorted(self.rising[d], -(limits[low] // q[low][:, None]), side="left")
                end[low, d] = n
        return begin, end

    def best_of(self, queries: np.ndarray, owns: list[int], k: int, floors: list[int | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """:meth:`best` of several queries in turn."""
        limits = self._limits(queries)
        begins, ends = self._ends(queries, limits)
        largest = np.maximum(np.abs(self.impacts[:, 0]), np.abs(self.impacts[:, -1]))
        for i, (query, own, floor) in enumerate(zip(queries, owns, floors)):
            yield self._read(query, own, k, floor, limits[i].tolist(), begins[i].T, ends[i].T, int((np.abs(query) * largest).sum()) < 1 << 39)

    def _read(self, query, own, k, floor, limits, begins, ends, small: bool) -> tuple[np.ndarray, np.ndarray]:
        n, dims = len(self.ids), np.flatnonzero(query)
        small = small and len(dims) < 1 << 12
        score, unseen = np.zeros(n, np.int64), np.full(n, len(dims), np.int64)
        may = np.flatnonzero(self.ids != own)
        gains = query[dims].astype(np.float64) if small else query[dims]
        weights, up = self.weights if small else self.impacts, query[dims] > 0
        low, high = np.where(up, 0, n), np.where(up, 0, n)  # where the postings read so far begin and end
        for number, limit in enumerate(limits):
            if number and limit == limits[number - 1] or not len(dims):
                continue
            # Every posting that contributes at least ``limit`` and was not read before.
            first, last = np.where(up, high, begins[number][dims]), np.where(up, ends[number][dims], low)
            first, last = np.where(up, first, np.minimum(first, low)), np.where(up, np.maximum(last, high), last)
            low, high = np.where(up, low, first), np.where(up, last, high)
            size = last - first
            if size.any():
                parts = list(zip(dims.tolist(), first.tolist(), last.tolist()))
                at = np.concatenate([self.order[d, a:b] for d, a, b in parts])
                gain = np.repeat(gains, size) * np.concatenate([weights[d, a:b] for d, a, b in parts])
                if small:
                    gain += _ONE
                    both = np.bincount(at, weights=gain, minlength=n)
                    count = np.rint(both / _ONE)
                    score += (both - count * _ONE).astype(np.int64)
                    unseen -= count.astype(np.int64)
                else:
                    score += _add(at, gain, n)
                    unseen -= np.bincount(at, minlength=n)
            if number == 0 and len(may) > 4 * k:
                # The best so far, scored exactly, raise the floor.
                probe = may[np.argpartition(-score[may], 4 * k)[: 4 * k]]
                known = np.sort(self.matrix[probe] @ query)[::-1]
                floor = int(known[k - 1]) if floor is None else max(floor, int(known[k - 1]))
            if floor is not None:
                may = may[score[may] + unseen[may] * (limit - 1) >= floor]
            if len(may) <= max(8 * k, n // 64):
                break
        exact = self.matrix[may] @ query
        if floor is not None:
            may, exact = may[exact >= floor], exact[exact >= floor]
        return self.ids[may], exact


def _add(at: np.ndarray, more: np.ndarray, n: int) -> np.ndarray:
    """Sums too large for a weighted count in doubles."""
    out = np.zeros(n, np.int64)
    np.add.at(out, at, more)
    return out


def _cell(batch: pa.RecordBatch, row: int) -> dict:
    return {name: batch.column(name)[row].as_py() for name in batch.schema.names}


def _queries(cell: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(cell["query_ids"], np.int64)
    return ids, np.frombuffer(cell["queries"], np.int64).reshape(len(ids), cell["dim"])


def _prime(rows: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Each batch of queries with a floor per query from the block it meets; without a block, the least number."""
    for batch in rows:
        for row in range(batch.num_rows):
            cell = _cell(batch, row)
            ids, matrix = _queries(cell)
            floors = np.full(len(ids), _NO_FLOOR)
            if cell["ids"] is not None:
                block = _Block(cell["dim"], cell["ids"], cell["impacts"], cell["postings"])
                for i, (_, exact) in enumerate(block.best_of(matrix, ids.tolist(), k, [None] * len(ids))):
                    if len(exact) >= k:
                        floors[i] = np.partition(exact, len(exact) - k)[len(exact) - k]
            names = ("batch", "dim", "query_ids", "queries")
            yield pa.RecordBatch.from_arrays([*(pa.array([cell[n]]) for n in names), pa.array([floors.tobytes()])], names=[*names, "floors"])


def _search(rows: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Each batch of queries over the blocks of a group, which come one after the other."""
    now, queries, held = None, None, []

    def out() -> pa.RecordBatch:
        count = [len(h[0]) for h in held]
        columns = [
            np.repeat(queries[0], count), np.repeat(queries[2], count),
            *[np.concatenate([h[c] for h in held]) if held else np.zeros(0, np.int64) for c in (0, 1)],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "query", "vec_id", "score"])

    for batch in rows:
        for row in range(batch.num_rows):
            cell = _cell(batch, row)
            if cell["batch"] != now:
                if now is not None:
                    yield out()
                now = cell["batch"]
                ids, matrix = _queries(cell)
                queries = (ids, matrix, (np.int64(now) << 16) + np.arange(len(ids)))
                floors = np.frombuffer(cell["floors"], np.int64)
                held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
            block = _Block(cell["dim"], cell["ids"], cell["impacts"], cell["postings"])
            known = [max(int(f), int(s[k - 1]) if len(s) >= k else _NO_FLOOR) for f, (_, s) in zip(floors, held)]
            found = block.best_of(queries[1], queries[0].tolist(), k, [None if f == _NO_FLOOR else f for f in known])
            for i, (more, exact) in enumerate(found):
                ids, score = np.concatenate([held[i][0], more]), np.concatenate([held[i][1], exact])
                order = np.lexsort((ids, -score))[:k]
                held[i] = ids[order], score[order]
    if now is not None:
        yield out()


def top_k(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest integer inner products of every row whose id ``every`` divides."""
    spark = vectors.sparkSession
    ship(spark)
    work = Workspace(spark, "top-k")
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), vector.alias("v")).where("id IS NOT NULL AND size(v) > 0")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.where(F.forall("v", finite))
    blocks = rows.mapInArrow(_index, "dim bigint, ids binary, impacts binary, postings binary")
    blocks = work.write(blocks.withColumn("block", F.monotonically_increasing_id()), "index")
    queries = rows.where(F.col("id") % every == 0).distinct()
    queries = queries.mapInArrow(_batches, "dim bigint, query_ids binary, queries binary")
    queries = work.write(queries.withColumn("batch", F.monotonically_increasing_id()), "queries")
    groups = max(1, -(-blocks.count() // GROUP_BLOCKS))
    placed = blocks.withColumn("grp", F.pmod(F.xxhash64("block"), F.lit(groups)))
    # A block of some group for each batch, chosen by its number; batches spread over the groups.
    firsts = placed.groupBy("grp", "dim").agg(F.min("block").alias("block"))
    firsts = placed.join(firsts, ["grp", "dim", "block"], "left_semi").select("grp", "dim", "ids", "impacts", "postings")
    home = queries.withColumn("grp", F.pmod(F.xxhash64("batch"), F.lit(groups))).join(firsts, ["grp", "dim"], "left")
    layout = "batch bigint, dim bigint, query_ids binary, queries binary, floors binary"
    queries = work.write(home.drop("grp").mapInArrow(lambda b: _prime(b, k), layout), "primed")
    sent = queries.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    met = sent.join(placed, ["grp", "dim"]).select("batch", "dim", "query_ids", "queries", "floors", "ids", "impacts", "postings")
    found = met.mapInArrow(lambda b: _search(b, k), "query_id bigint, query bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
