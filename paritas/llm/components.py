"""Connected components by alternating large and small stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import Workspace


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Point neighbours at the smallest one: larger neighbours in a large star, smaller ones in a small star."""
    if small:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = edges.union(edges.select("v", "u")).toDF("u", "v")
    lowest = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    pairs = near.join(lowest, "u")
    if small:
        moved = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).union(pairs.select("u", "m"))
    else:
        moved = pairs.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, work: Workspace, name: str, rounds: int | None = None) -> DataFrame:
    """``(node, root)`` of every node in ``edges`` (longs ``u``, ``v``): root is the smallest node reachable.

    Each round is written; rounds grow with the logarithm of the longest path.
    After a given number of ``rounds`` the root is some smaller node reachable.
    """
    now = work.write(edges.select("u", "v").where("u <> v").distinct(), f"{name}-0")
    mark, step = None, 0
    while rounds is None or step < rounds:
        if rounds is None:
            total = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
            if tuple(total) == mark or not total[0]:
                break
            mark = tuple(total)
        step += 1
        now = work.write(_star(_star(now, False), True), f"{name}-{step}")
        work.drop(f"{name}-{step - 1}")
    ends = now.select("u", "v").union(now.select("v", "v"))
    return ends.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
