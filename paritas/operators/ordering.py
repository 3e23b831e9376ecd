"""Ordered computations that no single key, and no single task, can swamp.

A window function sends every row of a key to one task.  Here rows are
range-partitioned by (key, order) instead, so that a key of any size spreads
over many tasks; each partition computes on its own, and the little state that
crosses partition edges is carried.  There is one path for keys of every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paritas.session import durable

_PART_SHIFT = 33  # monotonically_increasing_id keeps the partition above bit 33


def placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, with ``_part`` and ``_at``.

    ``_at`` grows along the order over the whole table and ``_part`` is the
    partition it was sorted in.  Both are written out, so later readers agree
    on them.
    """
    at = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    return durable(ordered.withColumn("_part", F.shiftright("_at", _PART_SHIFT)), "ordered")


def _with_edges(rows: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the edge columns of their (partition, key); one small row per partition and key on the right.

    ``edges`` names its keys ``_e0, _e1, ...`` and its partition ``_e``.
    """
    on = F.col("_part") == F.col("_e")
    for i, k in enumerate(keys):
        on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"_e{i}"))
    return rows.join(edges, on, "left").drop("_e", *[f"_e{i}" for i in range(len(keys))])


def _edge_names(keys: Sequence[str]) -> list[Column]:
    return [F.col("_part").alias("_e"), *[F.col(f"`{k}`").alias(f"_e{i}") for i, k in enumerate(keys)]]


def neighbour(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str], *, following: bool = False
) -> DataFrame:
    """Add, per row, values of the previous (or following) row of the same key.

    ``columns`` maps new column name to source column; ``order`` must be a
    total order within a key.
    """
    step = F.lead if following else F.lag
    rows = placed(df, [F.col(f"`{k}`").asc() for k in (*keys, *order)])
    inside = Window.partitionBy("_part", *keys).orderBy("_at")
    found = [step(F.col(f"`{src}`")).over(inside).alias(f"_in_{i}") for i, src in enumerate(columns.values())]
    inner = rows.select("*", step(F.lit(True)).over(inside).alias("_has"), *found)

    # One row per (partition, key): the value the next partition needs.
    edge = F.struct(*[F.col(f"`{src}`").alias(f"v{i}") for i, src in enumerate(columns.values())])
    pick = F.min_by if following else F.max_by
    edges = rows.groupBy("_part", *keys).agg(pick(edge, "_at").alias("_edge"))
    across = Window.partitionBy(*keys).orderBy("_part")
    edges = edges.select(*_edge_names(keys), step("_edge").over(across).alias("_edge"))
    carried = [
        F.when(F.col("_has"), F.col(f"_in_{i}")).otherwise(F.col(f"_edge.v{i}")).alias(new) for i, new in enumerate(columns)
    ]
    return _with_edges(inner, edges, keys).select(*[F.col(f"`{c}`") for c in df.columns], *carried)


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the running sum of ``value`` along ``order`` within each key, this row included."""
    frame = (Window.unboundedPreceding, Window.currentRow)
    rows = placed(df, [F.col(f"`{k}`").asc() for k in (*keys, *order)])
    inside = Window.partitionBy("_part", *keys).orderBy("_at").rowsBetween(*frame)
    inner = rows.withColumn("_inside", F.sum(value).over(inside))
    subtotals = rows.groupBy("_part", *keys).agg(F.sum(value).alias("_sub"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = subtotals.select(*_edge_names(keys), F.sum("_sub").over(earlier).alias("_carry"))
    total = (F.col("_inside") + F.coalesce("_carry", F.lit(0))).alias(name)
    return _with_edges(inner, carried, keys).select(*[F.col(f"`{c}`") for c in df.columns], total)


def table_rank(
    df: DataFrame,
    by: str,
    tiebreak: Sequence[str],
    *,
    descending: bool = False,
    prefix: str = "_",
) -> DataFrame:
    """Add ``<prefix>row`` (1-based place), ``<prefix>rank`` and ``<prefix>total``.

    Rows tied on ``by`` share the lowest rank and are placed by ``tiebreak``.
    NULL sorts lowest.  One summary row per partition reaches the driver.
    """
    spark = df.sparkSession
    value = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first()
    rows = placed(df, [value, *[F.col(t).asc() for t in tiebreak]])
    inside = Window.partitionBy("_part").orderBy(value)
    rows = rows.select(
        "*",
        F.rank().over(inside).cast("bigint").alias("_in_rank"),
        (F.col("_at").bitwiseAND(F.lit((1 << _PART_SHIFT) - 1)) + 1).alias("_in_row"),
    )
    text = F.col(by).cast("string")
    summary = (
        rows.groupBy("_part")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("_in_rank").alias("last_rank"),
            F.min_by(F.struct(text.alias("v")), "_at").alias("first"),
            F.max_by(F.struct(text.alias("v")), "_at").alias("last"),
        )
        .orderBy("_part")
        .collect()
    )
    offset, starts, places = 0, {}, []
    for part in summary:
        tie_start = starts.get(part["first"]["v"], offset + 1)
        places.append((part["_part"], offset, tie_start))
        starts.setdefault(part["last"]["v"], offset + part["last_rank"])
        offset += part["n"]
    schema = "_part bigint, _offset bigint, _tie_start bigint"
    known = F.broadcast(spark.createDataFrame(places, schema))
    ranked = rows.join(known, "_part")
    return ranked.select(
        *df.columns,
        (F.col("_offset") + F.col("_in_row")).alias(f"{prefix}row"),
        F.when(F.col("_in_rank") == 1, F.col("_tie_start"))
        .otherwise(F.col("_offset") + F.col("_in_rank"))
        .alias(f"{prefix}rank"),
        F.lit(offset).cast("bigint").alias(f"{prefix}total"),
    )


def percent_rank(rank: Column, total: Column) -> Column:
    """(rank - 1) / (rows - 1), and 0 for a single row."""
    return F.when(total > 1, (rank - 1) / (total - 1)).otherwise(F.lit(0.0))


def ntile(row: Column, total: Column, n: int) -> Column:
    """Bucket 1..n of a place; the first ``total % n`` buckets hold one row more."""
    # Spark's % and div on bigints keep this in long arithmetic.
    size = F.floor(total / n)
    larger = total % n
    in_larger = larger * (size + 1)
    return (
        F.when(row <= in_larger, F.floor((row - 1) / (size + 1)) + 1)
        .otherwise(F.floor((row - 1 - in_larger) / F.greatest(size, F.lit(1))) + larger + 1)
        .cast("bigint")
    )
