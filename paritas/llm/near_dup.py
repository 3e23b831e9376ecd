"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard confirmation.

Two permutations of 2**20 positions are all the randomness there is: the first
scatters a document's shingles, the second gives each position a value, and
signature coordinate k is the smallest value after shifting the second
permutation by k.  As neighbouring coordinates read neighbouring values, a
shingle contributes one contiguous slice to the whole signature.

With 48 bands of 5 coordinates two documents of Jaccard similarity 0.75 share no
band with probability 2e-6, and less above.  Documents that share a band are
candidates if 720 coordinates, a byte of each, agree to 0.68 (a pair of
similarity 0.75 falls below that with probability 1e-5), compared within and
between blocks of a bucket.  Never all pairs of a group come out: the first
round takes only the few best candidates of every document, confirms links on
the full sets and joins the groups, so that most pairs are inside a group before
they are ever formed.  The last round takes whatever pairs between groups are
left.

Defined cases: no words or null text: no shingles, linked with nothing, its own
component.  Equal sets are one node, so copies cost nothing.  Rows that repeat a
doc_id are judged by their own text.  ``component_id`` is the smallest doc_id of
the component (null only if all are null).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.llm.common import Workspace, keep_rows, lean, row_keys, ship
from paritas.llm.components import components
from paritas.llm.shingles import mix, shingle_sets

POSITIONS = 1 << 20
BANDS, ROWS = 48, 5
BANDED = BANDS * ROWS
COORDINATES = 720
#: Agreement of candidates, on the banded coordinates and on all.
LOOKS_SIMILAR, SIMILAR = 0.62, 0.68
#: Members of a bucket compared in one go.
BLOCK = 256
#: The first round looks at so many bands and takes so many best candidates of each node; the last takes all that are left.
FIRST_BANDS, BEST = 16, 4
#: Texts signed in one go, however short; bounds the signatures a worker holds.
SIGNED = 1024
_SET_ROWS = 1024


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and the shifted views of the valuing one: row p holds coordinates 0.. of position p."""
    rng = np.random.default_rng(20240101)
    scatter = rng.permutation(POSITIONS).astype(np.uint32)
    values = rng.permutation(POSITIONS).astype(np.uint32)
    circle = np.concatenate([values, values[: COORDINATES - 1]])
    return scatter, np.lib.stride_tricks.sliding_window_view(circle, COORDINATES)


def signature(shingles: np.ndarray) -> np.ndarray:
    scatter, shifted = _permutations()
    at = scatter[(shingles >> np.uint64(44)).astype(np.uint32)]
    low = np.full(COORDINATES, POSITIONS, np.uint32)
    for i in range(0, len(at), _SET_ROWS):
        np.minimum(low, shifted[at[i : i + _SET_ROWS]].min(axis=0), out=low)
    return low


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature; the band's number is part of it."""
    cells = signatures[:, :BANDED].reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), cells.shape[:2]).copy()
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0x9FB21C651E98DF25) + cells[:, :, r])
    return keys


def _sign(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in (large.slice(at, SIGNED) for large in lean(batches) for at in range(0, large.num_rows, SIGNED)):
        text = batch.column(batch.num_columns - 1)
        counts, digests, signatures, full = [], [], [], []
        for shingles in shingle_sets(text):
            counts.append(len(shingles))
            digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
            full.append(len(shingles) > 0)
            if len(shingles):
                signatures.append(signature(shingles))
        have = np.array(signatures, np.uint32).reshape(-1, COORDINATES)
        keys = band_keys(have).view(np.int64)
        sketch = (mix(have.astype(np.uint64)) & np.uint64(255)).astype(np.uint8)
        ends = np.concatenate([[0], np.cumsum(np.array(full, np.int64) * BANDS)]).astype(np.int32)
        rows = iter(sketch)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:-1],
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1))),
                pa.array([next(rows).tobytes() if f else None for f in full], pa.binary()),
            ],
            names=names,
        )


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    inner = docs.select(
        F.col(f"`{id_col}`").alias("id"), *row_keys(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")),
        F.col(f"`{text_col}`").alias("text"),
    )
    schema = T.StructType(inner.schema.fields[:-1])
    schema = schema.add("n", T.LongType()).add("digest", T.BinaryType())
    schema = schema.add("bands", T.ArrayType(T.LongType())).add("sketch", T.BinaryType())
    names = schema.names
    signed = inner.mapInArrow(lambda batches: _sign(batches, names), schema)
    return signed.withColumn("row", F.monotonically_increasing_id())


def _cells(column: pa.ListArray) -> tuple[np.ndarray, ...]:
    """Bounds of each block, and node, group, set size, signature and band keys (if there) of all members."""
    members = column.flatten()
    bounds = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
    sketch = members.field("sketch")  # of one length each, so their bytes are a matrix
    ends = np.frombuffer(sketch.buffers()[1], np.int32)[sketch.offset : sketch.offset + len(sketch) + 1]
    sketches = np.frombuffer(sketch.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(members), -1)
    keys = members.field("bands").flatten().to_numpy().reshape(-1, BANDS) if "bands" in column.type.value_type.names else None
    return (bounds, *[members.field(f).to_numpy() for f in ("node", "grp", "n")], sketches, keys)


def _alike(batches: Iterator[pa.RecordBatch], best: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of different groups within two blocks of a bucket that look similar; of each node the best ones, or all."""
    limit = LOOKS_SIMILAR if best else SIMILAR
    for batch in lean(batches):
        if not batch.num_rows:
            continue
        cells = {name: _cells(batch.column(name)) for name in batch.schema.names if name != "key"}
        bucket, u, v, looks = batch.column("key").to_numpy() >> 32, [], [], []
        one = cells["one"]
        two = cells.get("two", one)
        for row in range(batch.num_rows):
            a, b = [slice(c[0][row], c[0][row + 1]) for c in (one, two)]
            node, group, n, sketch = (c[b] for c in two[1:5])
            for i in range(a.start, a.stop):
                size = one[3][i]
                may = np.flatnonzero((group != one[2][i]) & (4 * n >= 3 * size) & (4 * size >= 3 * n))
                if not len(may):
                    continue
                equal = np.packbits(sketch[may] == one[4][i], axis=1)
                agree = np.bitwise_count(equal).sum(axis=1) / sketch.shape[1]
                keep = np.flatnonzero(agree >= limit)
                if best and len(keep) > BEST:
                    keep = keep[np.lexsort((node[may[keep]], -agree[keep]))[:BEST]]
                if not best and len(keep):  # a pair comes out of the first bucket it shares
                    mine = one[5][i]
                    first = np.argmax(two[5][b][may[keep]] == mine, axis=1)
                    keep = keep[mine[first] == bucket[row]]
                u.append(np.full(len(keep), one[1][i]))
                v.append(node[may[keep]])
                looks.append(agree[keep])
        if u:
            u, v, looks = np.concatenate(u), np.concatenate(v), np.concatenate(looks)
            pairs, first = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0, return_index=True)
            arrays = [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(looks[first])]
            yield pa.RecordBatch.from_arrays(arrays, names=["u", "v", "agree"])


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets share ``percent`` of their union; rows come sorted by u."""
    seen, kept = None, None
    for batch in lean(batches):
        us, vs = batch.column("u").to_pylist(), batch.column("v").to_pylist()
        out_u, out_v = [], []
        for i, (u, v, other) in enumerate(zip(us, vs, shingle_sets(batch.column("text_v")))):
            if u != seen:
                seen, kept = u, next(shingle_sets(batch.column("text_u").slice(i, 1)))
            both = len(np.intersect1d(kept, other, assume_unique=True))
            if 100 * both >= percent * (len(kept) + len(other) - both):
                out_u.append(u)
                out_v.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out_u, pa.int64()), pa.array(out_v, pa.int64())], names=["u", "v"])


def _texts(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(node, text)`` of the given nodes (``node`` with its row's keys), read anew from the documents."""
    keyed = docs.select(
        *row_keys(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.col(f"`{text_col}`").alias("text")
    )
    # Rows equal in id and text are equal sets, hence one node; any of them serves.
    return keyed.join(nodes, ["_k1", "_k2"]).select("node", "text")


def _candidates(members: DataFrame, faces: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Pairs ``u < v`` of different groups that share a bucket and look similar.

    Without groups, the best of each node inside blocks of some bands; with
    groups, all there are in any two blocks of any bucket.
    """
    best = groups is None
    if best:
        placed = members.where(F.col("band") < FIRST_BANDS).select("key", "members", "node", F.col("node").alias("grp"))
    else:
        placed = members.join(groups, "node", "left")
        placed = placed.select("key", "members", "node", F.coalesce("root", "node").alias("grp"))
        several = placed.groupBy("key").agg(F.min("grp").alias("a"), F.max("grp").alias("b")).where("a <> b").select("key")
        placed = placed.join(several, "key", "left_semi")
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK)).alias("block")
    face = [F.substring("sketch", 1, BANDED).alias("sketch")] if best else ["sketch", "bands"]
    open_ = placed.join(faces.select("node", "n", *face), "node")
    member = F.struct("node", "grp", "n", "sketch", *([] if best else ["bands"]))
    blocks = open_.groupBy("key", block).agg(F.max("members").alias("members"), F.collect_list(member).alias("cell"))
    alike = lambda df: df.mapInArrow(lambda b: _alike(b, best), "u bigint, v bigint, agree double")
    if best:
        pairs = alike(blocks.select("key", F.col("cell").alias("one")))
        ends = pairs.select(F.col("u").alias("node"), "*").union(pairs.select("v", "*"))
        top = F.slice(F.sort_array(F.collect_set(F.struct("agree", "u", "v")), asc=False), 1, BEST)
        return ends.groupBy("node").agg(top.alias("top")).select(F.inline("top")).select("u", "v").distinct()
    pairs = alike(blocks.where(F.col("members") <= BLOCK).select("key", F.col("cell").alias("one")))
    large = blocks.where(F.col("members") > BLOCK)
    one = large.select("key", F.col("block").alias("i"), F.col("cell").alias("one"))
    two = large.select("key", F.col("block").alias("j"), F.col("cell").alias("two"))
    pairs = pairs.union(alike(one.join(two, "key").where("i <= j").select("key", "one", "two")))
    return pairs.select("u", "v")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    both = pairs.join(right, "v").join(left, "u").select("u", "v", "text_u", "text_v")
    return both.mapInArrow(lambda b: _confirm(b, percent), "u bigint, v bigint").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, keys: bool = False
) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles``, ``component_id`` and ``kept`` (the component's smallest id).

    ``keys`` adds the row's ``_k1`` and ``_k2`` (see ``row_keys``).
    """
    spark = docs.sparkSession
    ship(spark)
    work = Workspace(spark, "near-dup")
    rows = work.write(_signed(docs, id_col, text_col), "rows")

    # One node per distinct set.
    nodes = work.write(
        rows.where("n > 0").groupBy("digest").agg(F.min("row").alias("node"), F.min("id").alias("low")), "nodes"
    )
    own = rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    own = own.select(F.col("row").alias("node"), "n", "sketch", "bands", "_k1", "_k2")
    banded = own.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("members"))
    members = work.write(banded.join(buckets.where("members > 1"), "key"), "members")
    linked = members.select("node").distinct()
    # Of a band's key, 32 bits are enough to tell which bands two nodes share.
    short = F.transform("bands", lambda key: F.shiftright(key, 32).cast("int")).alias("bands")
    faces = own.select("node", "n", "sketch", short, "_k1", "_k2")
    faces = work.write(faces.join(linked, "node", "left_semi"), "faces")

    # What is left to know of every row; signatures are no longer needed.
    slim = work.write(rows.select("id", "n", "digest", "_k1", "_k2"), "slim")
    work.drop("rows")
    # Read anew from the documents, once for all rounds.
    texts = work.write(_texts(docs, faces.select("node", "_k1", "_k2"), id_col, text_col), "texts")
    work.sweep()
    first = work.write(_candidates(members, faces, None), "first")
    links = work.write(_confirmed(first, texts, percent), "first-links")
    # Here it is enough that most linked documents share a group.
    groups = components(links, work, "first-groups", rounds=4)
    work.sweep()
    rest = work.write(_candidates(members, faces, groups), "rest")
    links = work.write(_confirmed(rest, texts, percent), "rest-links")
    work.sweep()
    groups = components(links.union(groups.select("node", "root")), work, "groups")
    work.drop("members", "faces", "texts")

    named = nodes.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = work.write(named, "named")
    lowest = named.groupBy("root").agg(F.min("low").alias("component"))
    named = work.write(named.join(lowest, "root").select("digest", "component"), "components")
    result = slim.join(named, "digest", "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component"))
    return result.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"), *[c for c in ("_k1", "_k2") if keys],
        *[F.when(F.col("n") > 0, F.col("digest")).alias("_digest") for _ in range(keys)],
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group stays, that of the smallest id, with all columns.

    Rows without words are linked with nothing and stay.  Where several rows
    hold a group's smallest id, one of them stays.
    """
    found = near_duplicates(docs, id_col, text_col, keys=True).where("kept")
    group = F.when(F.col("_digest").isNotNull(), F.col("component_id"))
    linked = found.where("_digest IS NOT NULL").groupBy("component_id")
    linked = linked.agg(F.min(F.struct("_k1", "_k2")).alias("k")).select("k._k1", "k._k2")
    alone = found.where("_digest IS NULL").select("_k1", "_k2").distinct()
    return keep_rows(docs, linked.union(alone), id_col, text_col)
