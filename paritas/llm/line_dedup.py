"""Repeated passages by overlapping windows of three lines.

Every three consecutive lines are hashed (128 bits).  Windows that occur more
than once anywhere are repeated; the occurrence with the smallest (doc_id, line)
stays, the lines that the others cover are merged and removed.

Windows are combined before the shuffle and only repeated ones come back to
their documents, in a join of two written tables that Spark may split where one
window is very frequent.

Defined cases: a text of fewer than three lines has no window and stays as it
is; null text counts as empty.  Where a later occurrence overlaps the first one
of the same window, the first one's lines stay.  Rows equal in id and text are
one document and are treated alike; null ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import Workspace, row_keys

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per window: the document's keys, the first line's place, and two hashes."""
    text = F.col(f"`{text_col}`")
    lines = docs.select(F.col(f"`{id_col}`").alias("id"), *row_keys(F.col(f"`{id_col}`"), text), _lines(text).alias("lines"))
    lines = lines.where(F.size("lines") >= WINDOW)
    parts = lambda i: [F.get("lines", i + k) for k in range(WINDOW)]
    windows = F.transform(
        F.sequence(F.lit(0), F.size("lines") - WINDOW),
        lambda i: F.struct(i.alias("at"), F.xxhash64(*parts(i)).alias("h1"), F.xxhash64(F.lit("second"), *parts(i)).alias("h2")),
    )
    return lines.select("id", "_k1", "_k2", F.explode(windows).alias("w")).select("id", "_k1", "_k2", "w.at", "w.h1", "w.h2")


def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_lines``, ``n_removed`` and ``text`` without the lines removed."""
    work = Workspace(docs.sparkSession, "line-dedup")
    windows = work.write(_windows(docs, id_col, text_col).distinct(), "windows")
    place = F.struct("id", "_k1", "_k2", "at")
    repeated = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    repeated = work.write(repeated.where("n > 1").select("h1", "h2", "first"), "repeated")
    later = windows.join(repeated, ["h1", "h2"]).where(place != F.col("first"))
    own = (F.col("_k1") == F.col("first._k1")) & (F.col("_k2") == F.col("first._k2")) & F.col("id").eqNullSafe(F.col("first.id"))
    # Lines of the first occurrence of the window itself stay.
    start = F.when(own, F.greatest(F.col("at"), F.col("first.at") + WINDOW)).otherwise(F.col("at"))
    covered = later.select("_k1", "_k2", start.alias("start"), (F.col("at") + WINDOW - 1).alias("end")).where("start <= end")
    covered = covered.groupBy("_k1", "_k2").agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("start", "end")))).alias("gone"))
    covered = work.write(covered, "covered")
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), *row_keys(F.col(f"`{id_col}`"), text), text.alias("text"))
    # Documents are dealt out by key at every size, so that the plan is the same however few lines are covered.
    rows = rows.hint("merge").join(covered, ["_k1", "_k2"], "left").select("id", F.coalesce("text", F.lit("")).alias("text"), "gone")
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    lines = _lines(F.col("text"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    # Only texts that lose lines are cut and joined again.
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    return rows.select(
        F.col("id").alias(id_col), n_lines.cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"), text.alias("text"),
    )
