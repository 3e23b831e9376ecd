"""Mixing sources to target weights by Pareto order sampling.

Each source has a target size in words.  A document's expected copies are its
source's target over its source's size (times its weight over the source's mean
weight, if a weight is given): the whole part is taken for certain, the rest is
its inclusion probability p.  The documents of a source are ranked by random
odds over inclusion odds, u / (1 - u) / (p / (1 - p)), and the lowest ranks fill
the words that certain copies leave open.  A document larger than what is open
is passed over and the draw goes on below it, until no document fits; then the
smallest one left may replace the last ranks drawn, if that narrows the gap.

Without a weight column, as in the registered query, the documents of a source share
one p, and the order of odds is the equal case of the design: a plain random order.
With one, p differs by document and the heavier come first.  Passing over what no
longer fits makes documents of a size near a source's open words a little rarer than p.
Each pass of the draw leaves out the text it stopped at and all that are larger than
the words still open, so there are at most as many passes as texts have sizes, and
in a random order some logarithm of that (six for sizes that fall by 3 % each).

Ranks are range partitioned by (source, odds), so one source may hold any share
of the rows; running sums carry one number per range and source.

Defined cases: null text has size 0; null source is a source of its own, last.
Sources of size 0 have target 0.  Random numbers are hashes of the doc_id, so
reruns agree and rows that repeat a doc_id share one, in order of size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paritas.llm.common import WORD, Workspace, keep_rows, row_keys

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
_PART_SHIFT = 33


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, limit: int = LIMIT
) -> DataFrame:
    """``source, source_size, target`` from one row per source with its ``source_size``.

    Weights repeat over the sources in code-point order.  Together the targets
    make ``share`` of all sizes; a target stops at ``limit`` times its source,
    and what it can't hold goes to the others by weight.  With sources in order
    of limit over weight, those that stop are a prefix: a source stops if its
    limit is below its part of what the sources before leave over.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (((place - 1) % len(weights)) + 1).cast("int"))
    known = sizes.select("source", "source_size", weight.alias("w"), (limit * F.col("source_size")).alias("most"))
    known = known.withColumn("total", F.sum("source_size").over(everything))
    by_room = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before, onward = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    left = share * F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))
    level = left / F.sum("w").over(onward)
    known = known.withColumn("level", level).withColumn("stops", F.col("most") <= F.col("level") * F.col("w"))
    # The first source that does not stop sets the level of all that follow.
    final = F.first(F.when(~F.col("stops"), F.col("level")), ignorenulls=True).over(by_room.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("stops") | final.isNull(), F.col("most").cast("double")).otherwise(final * F.col("w"))
    return known.select("source", "source_size", target.alias("target"))


def _uniform(seed: int, id_: Column) -> Column:
    """A number inside (0, 1) from the id."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_, id_.isNull()), 11).cast("double") + 0.5) / F.lit(2.0**53)


def _taken(passes: str, at: Column) -> Column:
    return F.exists(passes, lambda p: (F.col("size") <= p["most"]) & (at <= p["cut"]))


def _fill(rows: DataFrame, room: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Per source ``k`` of ``room``: the ``passes`` over its rows, and the words still ``open``.

    Each pass goes down the rows (``k, part, at, size``, in order of ``at``) that
    fit what is open, and stops before the first that no longer does; the next
    pass leaves out what is too large by then, until nothing fits.  A pass takes
    rows of up to ``most`` words up to place ``cut``, so that passes are small.
    """
    passes = F.array().cast("array<struct<most: double, cut: bigint>>")
    state = work.write(room.select("k", F.col("open").cast("double").alias("open"), passes.alias("passes")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        left = rows.where("size > 0").join(state, "k").where((F.col("size") <= F.col("open")) & ~_taken("passes", F.col("at")))
        sums = left.groupBy("k", "part").agg(F.sum("size").alias("words"), F.first("open").alias("open"))
        sums = sums.withColumn("upto", F.sum("words").over(Window.partitionBy("k").orderBy("part")))
        fits = F.col("upto") <= F.col("open")
        edge = sums.groupBy("k").agg(F.min(F.when(~fits, F.col("part"))).alias("edge"), F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("before"))
        edge = work.write(edge, f"{name}-edge-{turn}")
        if edge.isEmpty():
            return state
        cut = left.join(edge.withColumnRenamed("edge", "part"), ["k", "part"])
        cut = cut.withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("k").orderBy("at")))
        cut = cut.where("upto <= open").groupBy("k").agg(F.max("at").alias("cut"), F.max("upto").alias("got"))
        last = F.coalesce("cut", F.shiftleft("edge", _PART_SHIFT) - 1, F.lit((1 << 63) - 1))
        now = F.when(F.col("before").isNotNull(), F.array(F.struct(F.col("open").alias("most"), last.alias("cut")))).otherwise(F.array())
        state = state.join(edge, "k", "left").join(cut, "k", "left").select(
            "k", (F.col("open") - F.coalesce("got", "before", F.lit(0))).alias("open"), F.concat("passes", now).alias("passes")
        )
        state = work.write(state, f"{name}-{turn}")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weight_col: str | None = None, seed: int = 1, keys: bool = False,
) -> DataFrame:
    """Per row of ``docs``: id, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size)."""
    work = Workspace(docs.sparkSession, "mixing")
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    weight = F.lit(1.0) if weight_col is None else F.greatest(F.coalesce(F.col(f"`{weight_col}`").cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = docs.select(
        id_.alias("id"), F.col(f"`{source_col}`").alias("source"), *row_keys(id_, text), weight.alias("weight"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint").alias("size"),
    )
    rows = work.write(rows, "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("weight") * F.col("size")).alias("weighed"))
    plan = source_targets(sums.select("source", "source_size"))
    plan = plan.join(sums.select(F.col("source").alias("s"), "weighed"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = work.write(plan.withColumn("k", F.monotonically_increasing_id()), "plan")

    p = plan.withColumnRenamed("source", "s")
    rows = rows.join(p, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    expected = F.when(F.col("weighed") > 0, F.col("target") * F.col("weight") / F.col("weighed")).otherwise(F.lit(0.0))
    rows = rows.withColumn("expected", F.least(expected, F.lit(float(LIMIT))))
    rows = rows.withColumn("certain", F.floor("expected"))
    rows = rows.withColumn("p", F.col("expected") - F.col("certain"))
    u = _uniform(seed, F.col("id"))
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("odds", F.when(F.col("p") > 0, odds))

    # Ranks: the documents with something left to draw, in order of odds within their source.
    order = [F.col(c).asc_nulls_last() for c in ("source", "odds", "id", "size", "_k1", "_k2")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ordered = work.write(ordered.withColumn("part", F.shiftright("at", _PART_SHIFT)), "ordered")
    work.drop("sizes")
    sure = ordered.groupBy("k").agg(F.sum(F.col("certain") * F.col("size")).alias("all_sure"))
    room = plan.join(sure, "k").select("k", (F.col("target") - F.col("all_sure")).alias("open"))
    ranked = ordered.where("odds IS NOT NULL").select("k", "part", "at", "size")
    drawn = _fill(ranked, room, work, "drawn")

    # What is left is larger than the gap.  The smallest of it comes in, and the last ranks go out, if that narrows the gap.
    placed = ranked.where("size > 0").join(drawn, "k").withColumn("chosen", _taken("passes", F.col("at")))
    least = placed.where("NOT chosen AND open > 0").groupBy("k").agg(F.min(F.struct("size", "at")).alias("extra"), F.first("open").alias("gap"))
    least = work.write(least, "least")
    back = -F.col("at")
    leaving = placed.where("chosen").select("k", F.shiftright(back, _PART_SHIFT).alias("part"), back.alias("at"), "size")
    over = _fill(leaving, least.select("k", (F.col("extra.size") - F.col("gap")).alias("open")), work, "over")
    swaps = over.join(least, "k").where("open < gap").select("k", F.col("extra.at").alias("extra"), F.col("passes").alias("out"))

    done = ordered.join(drawn.drop("open"), "k").join(swaps, "k", "left")
    chosen = F.col("odds").isNotNull() & _taken("passes", F.col("at")) & ~F.coalesce(_taken("out", back), F.lit(False))
    chosen = chosen | F.coalesce(F.col("at") == F.col("extra"), F.lit(False))
    copies = (F.col("certain") + chosen.cast("long")).cast("bigint")
    return done.select(
        F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"), *[c for c in ("_k1", "_k2") if keys],
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix: every document as often as it is taken, with all columns.  Rows equal in id and text are one document."""
    found = mix(docs, id_col, text_col, source_col, keys=True).where("copies > 0")
    copies = found.groupBy("_k1", "_k2").agg(F.max("copies").alias("_copies"))
    return keep_rows(docs, copies, id_col, text_col, times="_copies")
