"""Slowly changing dimension histories (type 2) and change feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.operators.ordering import neighbour
from paritas.operators.report import as_checks, verdict

OPEN_END = "9999-12-31"


def _second(c: str) -> Column:
    return F.unix_seconds(F.col(c).cast("timestamp"))


def _with_next(df: DataFrame, entity_key: str, eff_from: str, eff_to: str, keep, tiebreak) -> DataFrame:
    """Versions with the next version's ``eff_from`` and ``_gap``: the timeline breaks after this one."""
    names = list(dict.fromkeys([entity_key, eff_from, eff_to, *keep, *tiebreak]))
    pairs = neighbour(
        df.select(*names).withColumn("_present", F.lit(True)),
        [entity_key],
        [eff_from, eff_to, *tiebreak],
        {"next_from": eff_from, "_has_next": "_present"},
        following=True,
    )
    joined = _second(eff_to).eqNullSafe(_second("next_from"))
    usable = F.col(eff_to).isNotNull() & F.col("next_from").isNotNull()
    return pairs.withColumn("_gap", F.coalesce(F.col("_has_next"), F.lit(False)) & ~(joined & usable))


def scd2_gaps(
    df: DataFrame, entity_key: str, eff_from: str, eff_to: str, *, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Consecutive versions whose ``eff_to`` is not the next ``eff_from``, to the second."""
    pairs = _with_next(df, entity_key, eff_from, eff_to, (), tiebreak)
    return pairs.where("_gap").select(entity_key, eff_from, eff_to, "next_from")


def _is_terminal(eff_to: str, terminal: str) -> Column:
    return F.coalesce(F.to_date(F.col(eff_to)) == F.lit(terminal).cast("date"), F.lit(False))


def _entity_counts(eff_to: str, current_flag: str, terminal: str) -> list[Column]:
    current = F.coalesce(F.col(current_flag), F.lit(False))
    is_open = _is_terminal(eff_to, terminal)
    return [
        F.count(F.lit(1)).alias("versions"),
        F.count_if(current).alias("n_current"),
        F.count_if(current & ~is_open).alias("current_not_open"),
        F.count_if(~current & is_open).alias("closed_but_open"),
    ]


def scd2_entities(df: DataFrame, entity_key: str, eff_to: str, current_flag: str, terminal: str = OPEN_END) -> DataFrame:
    """Per entity: versions, current versions, and open-end violations on each kind."""
    return df.groupBy(entity_key).agg(*_entity_counts(eff_to, current_flag, terminal))


def scd2_current(df: DataFrame, entity_key: str, eff_to: str, current_flag: str) -> DataFrame:
    """Entities that do not have exactly one current version."""
    return scd2_entities(df, entity_key, eff_to, current_flag).where("n_current != 1").select(entity_key, "versions", "n_current")


def scd2_terminal(df: DataFrame, entity_key: str, eff_to: str, current_flag: str, terminal: str = OPEN_END) -> DataFrame:
    """Entities whose single current version is not open-ended, or whose closed versions are."""
    per = scd2_entities(df, entity_key, eff_to, current_flag, terminal)
    wrong_current = F.when(F.col("n_current") == 1, F.col("current_not_open")).otherwise(0)
    return per.select(entity_key, wrong_current.cast("bigint").alias("current_not_open"), "closed_but_open").where(
        "current_not_open + closed_but_open > 0"
    )


def row_hash(df: DataFrame, columns: Sequence[str], null_text: str = "None") -> Column:
    """``md5`` of the values joined by ``|``; NULL, true and false are written
    ``None``, ``True`` and ``False``, as the surrogate keys were first built."""
    parts = []
    for c in columns:
        value, dtype = F.col(c), df.schema[c].dataType
        if isinstance(dtype, T.BooleanType):
            text = F.when(value, "True").when(~value, "False")
        else:
            text = value.cast("string")
        parts.append(F.coalesce(text, F.lit(null_text)))
    return F.md5(F.concat_ws("|", *parts))


def row_hash_mismatches(df: DataFrame, entity_key: str, stored: str, columns: Sequence[str]) -> DataFrame:
    """Versions whose stored surrogate hash is not the recomputed one."""
    hashed = df.select(entity_key, F.col(stored).alias("stored_hash"), row_hash(df, columns).alias("expected_hash"))
    return hashed.where(~F.col("stored_hash").eqNullSafe(F.col("expected_hash")))


def scd2_continuity(
    df: DataFrame,
    entity_key: str,
    eff_from: str,
    eff_to: str,
    current_flag: str,
    terminal: str = OPEN_END,
    row_hash_column: str | None = None,
    hash_columns: Sequence[str] | None = None,
    source: DataFrame | None = None,
    *,
    tiebreak: Sequence[str] = (),
    name: str = "target",
    **labels,
) -> DataFrame:
    """Checks that a history is gap-free, has one open current version per entity,
    closed older ones, and true surrogate hashes.

    With ``source`` (the legacy history), a further check counts hashes present
    on one side only.
    """
    # The look-ahead deals versions by ranges, so counting per entity is a second
    # shuffle, of one partial row per entity and range.
    versions = _with_next(df, entity_key, eff_from, eff_to, [current_flag], tiebreak)
    per = versions.groupBy(entity_key).agg(F.count_if("_gap").alias("gaps"), *_entity_counts(eff_to, current_flag, terminal))
    wrong_current = F.when(F.col("n_current") == 1, F.col("current_not_open")).otherwise(0)
    whats = ("gaps", "current", "terminal")
    totals = per.agg(
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("gaps"),
        F.count_if(F.col("n_current") != 1).alias("current"),
        F.coalesce(F.sum(wrong_current + F.col("closed_but_open")), F.lit(0)).alias("terminal"),
    )
    cells = [F.struct(F.lit(w).alias("what"), F.col(w).cast("bigint").alias("bad")) for w in whats]
    parts = [totals.select(F.inline(F.array(*cells)))]
    if row_hash_column and hash_columns:
        wrong = row_hash_mismatches(df, entity_key, row_hash_column, hash_columns)
        parts.append(wrong.agg(F.lit("row_hash").alias("what"), F.count(F.lit(1)).alias("bad")))
        if source is not None:
            signed = source.select(row_hash_column, F.lit(1).alias("_s")).unionByName(
                df.select(row_hash_column, F.lit(-1).alias("_s"))
            )
            net = signed.groupBy(row_hash_column).agg(F.sum("_s").alias("_net")).where("_net != 0")
            parts.append(net.agg(F.lit("source_hash").alias("what"), F.count(F.lit(1)).alias("bad")))
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return as_checks(
        counts,
        "scd2_continuity",
        target=F.concat(F.lit(f"{name} ("), F.col("what"), F.lit(")")),
        status=verdict(F.col("bad") == 0),
        message=F.concat(F.col("bad").cast("string"), F.lit(" violations")),
        expected=F.lit(0),
        actual=F.col("bad"),
        **labels,
    )


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` per key; of several, always the same one, by a hash of the row.

    An aggregate, not a window: each task keeps one candidate per key, so a
    key of any size costs one row per task in the shuffle.
    """
    whole = F.struct(*[F.col(c) for c in df.columns])
    # Ties are broken by what the rows hold, so that reruns agree; maps have no hash but their text has.
    hashable = [F.to_json(F.col(f"`{n}`")) if "map<" in kind or "variant" in kind else F.col(f"`{n}`") for n, kind in df.dtypes]
    rank = F.struct(*[F.col(c) for c in order], F.xxhash64(*hashable).alias("_tie"))
    latest = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(whole, rank).alias("_row"))
    return latest.select("_row.*")


def cdc_latest(delta: DataFrame, keys: Sequence[str], order: Sequence[str] = ("change_ms", "extract_ts")) -> DataFrame:
    """The last change of each key in a batch."""
    return latest_version(delta, keys, order)
