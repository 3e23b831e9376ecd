"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of 4096 bytes.  Sorting all blocks of the corpus
gives equal blocks one integer name.  Adjacent names are paired, the pairs are
sorted and named in turn, and so on until a document has one name left.  Names
are places among the distinct contents, so (round, name) is equal exactly for
equal texts: no hash decides.

Blocks are sorted by a 128-bit hash and then by content, so that the boundaries
Spark samples for range partitioning are small.  Ranges may cut through a block
that a third of the documents share, which so spreads over many tasks; each task
names its range by comparing contents, and only the first and last block of a
range are needed to number the ranges through.  Should a cut ever separate
different blocks of one hash, whose order it can't know, the query ends with an
error instead of a wrong name.

Defined cases: null text counts as empty; empty text is one empty block, hence
equal to other empty texts.  A null doc_id is smaller than any other.  Rows that
repeat a doc_id count one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.llm.common import LOWER, UPPER, Workspace, keep_rows, lean, row_keys, ship, slices
from paritas.llm.shingles import as_bytes

BLOCK_BYTES = 4096
_SLICE_BYTES = 4 << 20
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """One row per block: the document's columns, place, number of blocks, digest (at place 0) and content."""
    for batch in lean(batches):
        data, offsets = as_bytes(batch.column(batch.num_columns - 1))
        heads = pa.RecordBatch.from_arrays(batch.columns[:-1], names=names[: batch.num_columns - 1])
        for a, b in slices(np.diff(offsets).tolist(), _SLICE_BYTES):
            owner, place, count, digest, content = [], [], [], [], []
            for i in range(a, b):
                text = data[offsets[i] : offsets[i + 1]].tobytes().translate(_FOLD)
                n = max(1, -(-len(text) // BLOCK_BYTES))
                owner += [i] * n
                place += range(n)
                count += [n] * n
                digest += [hashlib.sha256(text).hexdigest()] + [None] * (n - 1)
                content += [text[k : k + BLOCK_BYTES] for k in range(0, n * BLOCK_BYTES, BLOCK_BYTES)]
            yield pa.RecordBatch.from_arrays(
                [
                    *heads.take(pa.array(owner)).columns,
                    pa.array(place, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(content, pa.binary()),
                ],
                names=names,
            )


def _number(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in, their content replaced by a number within this range; at the end a row that sums the range up."""
    part = TaskContext.get().partitionId()
    first, last, number, kinds = None, None, -1, None
    for batch in lean(batches):
        content = batch.column(batch.num_columns - 1)
        n = len(content)
        if not n:
            continue
        kinds = [c.type for c in batch.columns[:-1]]
        new = np.zeros(n, np.int64)
        new[0] = last is None or content[0].as_py() != last
        if n > 1:
            new[1:] = np.asarray(pc.not_equal(content.slice(1), content.slice(0, n - 1)))
        numbers = number + np.cumsum(new)
        number, last = int(numbers[-1]), content[n - 1].as_py()
        first = content[0].as_py() if first is None else first
        empty = pa.nulls(n, pa.binary())
        arrays = [*batch.columns[:-1], pa.array(np.full(n, part)), pa.array(numbers), empty, empty]
        yield pa.RecordBatch.from_arrays(arrays, names=names)
    if kinds is not None:
        summary = [*[pa.nulls(1, k) for k in kinds], pa.array([part]), pa.array([number])]
        yield pa.RecordBatch.from_arrays(
            [*summary, pa.array([first], pa.binary()), pa.array([last], pa.binary())], names=names
        )


def named(rows: DataFrame, content: str, work: Workspace, label: str) -> DataFrame:
    """``rows`` with the binary column ``content`` replaced by ``name``, its place among the distinct contents (from 1).

    Written once; equal contents get equal names wherever they lie.
    """
    carried = [c for c in rows.columns if c != content]
    hashes = [F.xxhash64(content).alias("_h1"), F.xxhash64(F.lit("second"), content).alias("_h2")]
    ordered = rows.select(*carried, *hashes, content)
    ordered = ordered.repartitionByRange("_h1", "_h2", "_k1", "_k2", "pos")
    ordered = ordered.sortWithinPartitions("_h1", "_h2", content, "_k1", "_k2", "pos").drop("_h1", "_h2")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in ordered.schema.fields[:-1]])
    for name, kind in (("part", T.LongType()), ("number", T.LongType()), ("first", T.BinaryType()), ("last", T.BinaryType())):
        schema = schema.add(name, kind)
    names = schema.names
    ranges = work.write(ordered.mapInArrow(lambda b: _number(b, names), schema), label)
    # One row per range: how many contents lie before it; a content continued from the range before counts once.
    in_order = Window.orderBy("part")
    ends = ranges.where("first IS NOT NULL").select("part", "number", "first", "last")
    ends = ends.withColumn("_before", F.lag("last").over(in_order))
    hash_of = lambda c: F.struct(F.xxhash64(c), F.xxhash64(F.lit("second"), c))
    collide = (F.col("_before") != F.col("first")) & (hash_of("_before") == hash_of("first"))
    joined = F.when(collide, F.raise_error(F.lit("different blocks of one hash"))).otherwise((F.col("_before") == F.col("first")).cast("long"))
    ends = ends.withColumn("joined", F.coalesce(joined, F.lit(0)))
    fresh = F.col("number") + 1 - F.col("joined")
    before = F.sum(fresh).over(in_order) - fresh - F.col("joined")
    starts = F.broadcast(ends.select("part", before.alias("before")))
    found = ranges.where("first IS NULL").join(starts, "part")
    return found.select(*carried, (F.col("before") + F.col("number") + 1).alias("name"))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: bool = False
) -> DataFrame:
    """Per row of ``docs``: id, ``keep_id`` (the largest id of an equal text), ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z.  ``keys`` adds the
    row's ``_k1``, ``_k2`` and its identity (``round``, ``name``).
    """
    spark = docs.sparkSession
    ship(spark)
    work = Workspace(spark, "exact-dedup")
    text = F.col(f"`{text_col}`")
    inner = docs.select(F.col(f"`{id_col}`").alias("id"), *row_keys(F.col(f"`{id_col}`"), text), text.alias("text"))
    schema = T.StructType(inner.schema.fields[:-1])
    for name, kind in (("pos", T.LongType()), ("n", T.LongType()), ("sha", T.StringType()), ("block", T.BinaryType())):
        schema = schema.add(name, kind)
    names = schema.names
    now = named(inner.mapInArrow(lambda b: _blocks(b, names), schema), "block", work, "round-0")
    heads = now.where("pos = 0")
    longest = now.agg(F.max("n")).first()[0] or 1

    columns = ["_k1", "_k2", F.lit(0).alias("round"), "name"]
    single = heads.where("n = 1").select("id", "sha", *columns)
    done, round_ = None, 0
    now = now.select("_k1", "_k2", "pos", "n", "name").where("n > 1")
    while longest > 1:
        round_, longest = round_ + 1, -(-longest // 2)
        half = F.shiftright("pos", 1).alias("pos")
        side = lambda odd: F.coalesce(F.max(F.when(F.col("pos") % 2 == odd, F.col("name"))), F.lit(0))
        pairs = now.groupBy("_k1", "_k2", half).agg(
            F.ceil(F.max("n") / 2).alias("n"), side(0).alias("left"), side(1).alias("right")
        )
        both = F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("left", "right")]))
        now = named(pairs.select("_k1", "_k2", "pos", "n", both.alias("pair")), "pair", work, f"round-{round_}")
        ended = now.where("n = 1").select("_k1", "_k2", F.lit(round_).alias("round"), "name")
        done = ended if done is None else done.union(ended)
        now = now.where("n > 1")
    rows = single
    if done is not None:
        rows = rows.union(heads.where("n > 1").select("id", "sha", "_k1", "_k2").join(done, ["_k1", "_k2"]).select(rows.columns))
    rows = work.write(rows, "identities")
    work.drop(*[f"round-{r}" for r in range(round_ + 1)])
    groups = rows.groupBy("round", "name").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = work.write(groups, "groups")
    return rows.join(groups, ["round", "name"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"), *[c for c in ("_k1", "_k2", "round", "name") if keys],
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of equal texts the row with the largest id stays, with all columns; of rows equal in that too, one."""
    found = exact_duplicates(docs, id_col, text_col, keys=True).where("kept")
    chosen = found.groupBy("round", "name").agg(F.min(F.struct("_k1", "_k2")).alias("k")).select("k._k1", "k._k2")
    return keep_rows(docs, chosen, id_col, text_col)
