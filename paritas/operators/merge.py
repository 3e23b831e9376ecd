"""Applying change batches to a table, and proving that doing so twice is safe."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paritas.functions import canon
from paritas.operators.history import cdc_latest
from paritas.operators.report import as_checks, verdict
from paritas.session import durable
from paritas.sources import ledger


class _Batch:
    """A change batch matched against a target.

    ``matched`` is the target with each row's change, if any, in ``_change``;
    ``unmatched`` is the part of the batch with no target row.  Both are left
    joins towards the batch: a batch small enough to broadcast leaves the target
    unshuffled, and a target key with many rows can be split.
    """

    def __init__(self, target: DataFrame, delta: DataFrame, keys: Sequence[str], op: str, delete: str, order):
        slots = [f"_k{i}" for i in range(len(keys))]
        changes = cdc_latest(delta, keys, order) if order else delta
        whole = F.struct(*[F.col(c) for c in changes.columns])
        keyed = changes.select(*[F.col(k).alias(s) for k, s in zip(keys, slots)], whole.alias("_change"))
        if not order:
            # Without an order no change of several is the last one: refuse the batch.
            one = F.when(F.count(F.lit(1)) == 1, F.first("_change")).otherwise(
                F.raise_error(F.lit("several changes for one key of the batch; name an order"))
            )
            keyed = keyed.groupBy(*slots).agg(one.alias("_change"))
        # Reduced once; both joins below read it.
        keyed = durable(keyed, "batch")
        on = F.lit(True)
        for k, s in zip(keys, slots):
            on = on & F.col(k).eqNullSafe(F.col(s))
        self.matched = target.join(keyed, on, "left").drop(*slots)
        self.unmatched = keyed.join(target.select(*keys), on, "left_anti").select("_change")
        self.is_delete = F.coalesce(F.col(f"_change.{op}") == delete, F.lit(False))

    def branches(self) -> DataFrame:
        """One row per target row or unmatched change, naming what happens to it."""
        ours = F.when(F.col("_change").isNull(), "kept").when(self.is_delete, "deleted").otherwise("updated")
        theirs = F.when(self.is_delete, "ignored").otherwise("inserted")
        return self.matched.select(ours.alias("branch")).unionByName(self.unmatched.select(theirs.alias("branch")))


def cdc_merge(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    op: str = "op",
    delete: str = "D",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """``target`` after a change batch: matched deletes dropped, other matches
    updated, unmatched rows inserted unless they are deletes.

    With ``order`` the batch may carry several changes per key; the last counts.
    Without it several changes of one key end the query with an error.
    Columns the batch does not carry keep their value, and are NULL in inserts.
    """
    batch = _Batch(target, delta, keys, op, delete, order)
    changed = F.col("_change").isNotNull()
    kept = batch.matched.where(~(changed & batch.is_delete)).select(
        *[
            (F.when(changed, F.col(f"_change.{c}")).otherwise(F.col(c)) if c in delta.columns else F.col(c)).alias(c)
            for c in target.columns
        ]
    )
    inserted = batch.unmatched.where(~batch.is_delete).select(
        *[
            (F.col(f"_change.{f.name}") if f.name in delta.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return kept.unionByName(inserted)


def upsert_split(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    op: str = "op",
    delete: str = "D",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """How many rows a batch updated, inserted, deleted, ignored or left alone."""
    return _Batch(target, delta, keys, op, delete, order).branches().groupBy("branch").agg(F.count(F.lit(1)).alias("n"))


def deleted_keys_present(
    target: DataFrame, delta: DataFrame, keys: Sequence[str], op: str = "op", delete: str = "D"
) -> DataFrame:
    """Keys the batch deleted that the target still holds."""
    gone = delta.where(F.col(op) == delete).select(*keys).distinct()
    return gone.join(target.select(*keys), list(keys), "left_semi")


def merge_idempotency(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    apply: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    op: str = "op",
    delete: str = "D",
    *,
    name: str = "target",
    labels: Mapping[str, str] | None = None,
) -> DataFrame:
    """Apply the batch twice; the two results must have one fingerprint, and no
    deleted key may remain."""
    labels = dict(labels or {})
    run = apply or (lambda t, d: cdc_merge(t, d, keys, op, delete))
    # The batch feeds seven readers and the first result three: each is written once.
    delta = durable(delta, "batch")
    once = durable(run(target, delta), "merged")
    twice = run(once, delta)
    prints = canon.fingerprint(once, compare).withColumn("_run", F.lit(1)).unionByName(
        canon.fingerprint(twice, compare).withColumn("_run", F.lit(2))
    )
    pick = lambda c, r: F.max(F.when(F.col("_run") == r, F.col(c)))
    both = prints.agg(
        pick("digest", 1).alias("first"), pick("digest", 2).alias("second"), pick("n", 1).alias("n1"), pick("n", 2).alias("n2")
    )
    checks = as_checks(
        both,
        "merge_idempotency",
        target=F.lit(name),
        status=verdict(F.col("first") == F.col("second")),
        message=F.format_string("run 1 has %d rows, run 2 has %d", "n1", "n2"),
        expected=F.col("n1"),
        actual=F.col("n2"),
        metrics={"first": F.col("first"), "second": F.col("second")},
        **labels,
    )
    left = deleted_keys_present(twice, delta, keys, op, delete).agg(F.count(F.lit(1)).alias("n"))
    return checks.unionByName(
        as_checks(
            left,
            "merge_idempotency",
            target=F.lit(f"{name} (deletes applied)"),
            status=verdict(F.col("n") == 0),
            message=F.concat(F.col("n").cast("string"), F.lit(" deleted keys still present")),
            expected=F.lit(0),
            actual=F.col("n"),
            **labels,
        )
    )


def incremental_append(
    existing: DataFrame, feed: DataFrame, check_column: str, key: Sequence[str], runs: Sequence[object]
) -> tuple[DataFrame, DataFrame]:
    """Load ``feed`` in runs whose upper watermarks are ``runs``; returns the final
    table and the audit rows ``run, watermark_from, rows_loaded, duplicate_keys,
    rows_not_taken, status``.

    The first run starts above the largest value the table already holds, each
    other above the run before.  ``duplicate_keys`` counts keys a run loads that
    the table or an earlier run holds, or that it loads twice.
    ``rows_not_taken`` counts the feed's rows that neither this run nor one before
    it takes: behind the start, without a value, or ahead.  A row's run follows
    from its value, so all runs are audited together.
    """
    spark = feed.sparkSession
    mark = F.col(check_column)
    start = existing.agg(F.max(check_column)).scalar()
    run_of = F.lit(None).cast("int")
    for i in range(len(runs), 0, -1):
        run_of = F.when(mark <= F.lit(runs[i - 1]), i).otherwise(run_of)
    run_of = F.when(start.isNull() | (mark > start), run_of)
    placed = feed.withColumn("_run", run_of)
    fresh = placed.where("_run IS NOT NULL")
    table = existing.unionByName(fresh.drop("_run"))

    counts = placed.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"))
    held = existing.select(*key, F.lit(0).alias("_run")).unionByName(fresh.select(*key, "_run"))
    held = held.groupBy(*key, "_run").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*key).orderBy("_run").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    repeats = held.withColumn("_upto", F.sum("_n").over(upto)).where("_run > 0 AND _upto > 1")
    repeats = repeats.groupBy("_run").agg(F.count(F.lit(1)).alias("_repeats"))

    declared = spark.createDataFrame([(i,) for i in range(1, len(runs) + 1)], "run int")
    low = F.lit(None).cast("string")
    for i in range(len(runs), 1, -1):
        low = F.when(F.col("run") == i, F.lit(str(runs[i - 2]))).otherwise(low)
    low = F.when(F.col("run") == 1, start.cast("string")).otherwise(low)
    audit = declared.join(counts, declared["run"] == counts["_run"], "left").drop("_run")
    audit = audit.join(repeats, declared["run"] == repeats["_run"], "left")
    loaded, repeated = F.coalesce("_n", F.lit(0)), F.coalesce("_repeats", F.lit(0))
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per run
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    return table, audit.select(
        "run", low.alias("watermark_from"), loaded.alias("rows_loaded"), repeated.alias("duplicate_keys"),
        (total - F.sum(loaded).over(earlier)).alias("rows_not_taken"),
        F.when(repeated == 0, "SUCCESS").otherwise("FAILED").alias("status"),
    )


def audited_append(
    feed: DataFrame, path: str, check_column: str, upto: object, run: str, *, before_commit: Callable[[], None] | None = None
) -> tuple[int, bool]:
    """Append the feed's rows above the stored watermark and up to ``upto``; returns ``(rows, added)``.

    Rows, run and watermark become visible together, by one line of the ledger
    below ``path``.  A run that is recorded adds nothing and reports what it added
    then; one that ended before its line left nothing, and is taken anew.
    ``before_commit`` is called between the rows and the line.
    """
    spark = feed.sparkSession
    lines = ledger.entries(spark, path)
    for line in lines:
        if line["run"] == run:
            return line["rows"], False
    mark = F.col(check_column)
    kind = feed.schema[check_column].dataType
    fresh = feed.where(mark <= F.lit(upto).cast(kind))
    if lines:
        fresh = fresh.where(mark > F.lit(lines[-1]["watermark"]).cast(kind))
    folder, rows = ledger.stage(fresh, path)
    if before_commit:
        before_commit()
    ledger.commit(spark, path, run, folder, feed.schema, rows, watermark=str(upto))
    return rows, True


def append_audit(spark: SparkSession, path: str) -> DataFrame:
    """``run, watermark_from, watermark, rows_loaded`` of every recorded run, in order."""
    lines = ledger.entries(spark, path)
    rows = [(line["run"], lines[i - 1]["watermark"] if i else None, line["watermark"], line["rows"]) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "run string, watermark_from string, watermark string, rows_loaded bigint")
