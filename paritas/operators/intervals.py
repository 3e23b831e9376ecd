"""Pairs of rows of one key within a span of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key in a slice of time to aim at; a busier key gets narrower slices.
SLICE_ROWS = 2_000


def interval_pairs(
    anchors: DataFrame,
    events: DataFrame,
    key: str,
    anchor_id: str,
    anchor_at: str,
    event_id: str,
    event_at: str,
    days: float,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``<key>, anchor_id, event_id, seconds_after`` of every event later than an anchor of its key by at most ``days``.

    Time is cut into slices as wide as the span, so an event can only meet anchors
    of its own slice and of the one before: an equi-join on (key, slice), no product.
    Keys with many events in a slice get that many times narrower slices; their
    anchors are dealt to all slices of their span, so that no slice of a key is a
    large group, however much of the table the key holds.  Each event lies in one
    slice, so no pair comes out twice.  Rows without key or time pair with nothing.
    """
    span = round(days * 86_400_000_000)
    left = anchors.select(F.col(key).alias("_key"), F.col(anchor_id).alias("anchor_id"), F.unix_micros(F.col(anchor_at).cast("timestamp")).alias("_from"))
    right = events.select(F.col(key).alias("_key"), F.col(event_id).alias("event_id"), F.unix_micros(F.col(event_at).cast("timestamp")).alias("_at"))
    left, right = left.where("_key IS NOT NULL AND _from IS NOT NULL"), right.where("_key IS NOT NULL AND _at IS NOT NULL")

    # Counted per key and slice before anything moves; only busy keys are listed.
    per_slice = right.groupBy("_key", F.expr(f"floor(_at / {span}D)").alias("_slice")).agg(F.count(F.lit(1)).alias("_n"))
    cuts = F.ceil(F.max("_n") / slice_rows).cast("bigint")
    busy = per_slice.groupBy("_key").agg(cuts.alias("_cuts")).where("_cuts > 1")
    width = f"CAST(ceil({span}D / coalesce(_cuts, 1L)) AS BIGINT)"

    right = right.join(busy, "_key", "left").select("_key", "event_id", "_at", F.expr(f"_at div {width} - IF(_at % {width} < 0, 1L, 0L)").alias("_slice"))
    first, last = "(_from + 1)", f"(_from + {span}L)"
    floor = lambda x: f"({x} div {width} - IF({x} % {width} < 0, 1L, 0L))"
    left = left.join(busy, "_key", "left").select(
        "_key", "anchor_id", "_from", F.explode(F.expr(f"sequence({floor(first)}, {floor(last)})")).alias("_slice")
    )
    pairs = left.join(right, ["_key", "_slice"]).where(f"_at > _from AND _at <= _from + {span}L")
    return pairs.select(F.col("_key").alias(key), "anchor_id", "event_id", F.expr("(_at - _from) / 1000000D").alias("seconds_after"))
