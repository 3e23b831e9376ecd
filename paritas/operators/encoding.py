"""Encoded columns: epochs that must become instants, decimals that must survive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.functions import canon
from paritas.operators.parity import keyed_compare
from paritas.operators.report import as_checks, several_checks, verdict

# Epoch units per second, and the default year limits.
UNITS_PER_SECOND = {"seconds": 1, "millis": 1_000, "micros": 1_000_000}
SANE_YEARS = (1970, 2100)
EXPECTED_YEARS = (1970, 9999)

_TO_TIMESTAMP = {"seconds": "timestamp_seconds", "millis": "timestamp_millis", "micros": "timestamp_micros"}


def _year_start(year: int) -> int:
    """Epoch second at which ``year`` begins; year 10000 ends the calendar."""
    days = dt.date(min(year, 9999), 1, 1).toordinal() - dt.date(1970, 1, 1).toordinal()
    return (days + (365 if year > 9999 else 0)) * 86_400


def in_years(raw: Column, encoding: str, years: Sequence[int]) -> Column:
    """Whether the epoch lies in the year range, tested on the integer so that no
    out-of-range value is ever converted."""
    unit = UNITS_PER_SECOND[encoding]
    low, high = _year_start(years[0]) * unit, _year_start(years[1] + 1) * unit
    return F.coalesce((raw >= F.lit(low)) & (raw < F.lit(high)), F.lit(False))


def epoch_to_timestamp(raw: Column, encoding: str, sane_years: Sequence[int] = SANE_YEARS) -> Column:
    """The instant of an epoch, or NULL when it is outside ``sane_years``."""
    guarded = F.when(in_years(raw, encoding, sane_years), raw)
    return F.call_function(_TO_TIMESTAMP[encoding], guarded)


def vendor_timestamp(text: Column) -> Column:
    """Timestamp of a ``YYYYMMDDHH24MISS`` string; NULL when it does not parse."""
    return F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))


def epoch_quarantine(
    df: DataFrame, key: str, column: str, encoding: str, *, table: str, sane_years: Sequence[int] = SANE_YEARS
) -> DataFrame:
    """One audit row per epoch that cannot be converted."""
    raw = F.col(column)
    reason = F.when(raw.isNull(), "null epoch").otherwise(f"epoch outside {sane_years[0]}-{sane_years[1]}")
    return df.where(~in_years(raw, encoding, sane_years)).select(
        F.lit(table).alias("src_table"),
        F.lit(column).alias("src_column"),
        F.col(key).cast("bigint").alias("row_id"),
        reason.alias("reason"),
    )


def classify_epochs(
    source: DataFrame,
    target: DataFrame,
    key: str,
    source_column: str,
    target_column: str,
    encoding: str,
    expect_years: Sequence[int] = EXPECTED_YEARS,
    sane_years: Sequence[int] = SANE_YEARS,
    out_of_range_is_null: bool = True,
) -> DataFrame:
    """Per source key: raw epoch, expected and found epoch second, and ``outcome``.

    Outcomes: ``matched``; ``nulled`` and ``null_source`` (target rightly NULL);
    ``not_nulled`` (out of range, yet a value arrived); ``lying_column`` (year
    outside ``expect_years``); ``mismatch``; ``target_only``; ``duplicate`` (a
    key with several rows on a side).
    """
    pairs = keyed_compare(source, target, [key], {source_column: target_column})
    raw, found = F.col(f"source_{source_column}"), F.col(f"target_{source_column}")
    unit = UNITS_PER_SECOND[encoding]
    second = F.floor(raw / unit) if unit == 1 else (raw - F.pmod(raw, F.lit(unit))) / unit
    second = second.cast("bigint")
    target_dtype = pairs.schema[f"target_{source_column}"].dataType
    found_second = F.unix_seconds(found.cast("timestamp") if not isinstance(target_dtype, T.TimestampType) else found)
    sane = in_years(raw, encoding, sane_years)
    outcome = (
        F.when(F.col("duplicated"), "duplicate")
        .when(F.col("n_source") == 0, "target_only")
        .when(~sane & found.isNotNull() & F.lit(out_of_range_is_null), "not_nulled")
        .when(raw.isNull(), "null_source")
        .when(~sane, "nulled")
        .when(~in_years(raw, encoding, expect_years), "lying_column")
        .when(second.eqNullSafe(found_second), "matched")
        .otherwise("mismatch")
    )
    return pairs.select(
        key,
        raw.alias("raw_epoch"),
        F.when(sane, second).alias("expected_second"),
        found_second.alias("found_second"),
        outcome.alias("outcome"),
    )


_BAD_EPOCHS = ("not_nulled", "lying_column", "mismatch", "duplicate")


def epoch_check(
    source: DataFrame,
    target: DataFrame,
    key: str,
    source_column: str,
    target_column: str,
    encoding: str,
    expect_years: Sequence[int] = EXPECTED_YEARS,
    sane_years: Sequence[int] = SANE_YEARS,
    out_of_range_is_null: bool = True,
    audit: DataFrame | None = None,
    *,
    source_table: str = "source",
    name: str = "target",
    **labels,
) -> DataFrame:
    """Summary check of an epoch conversion and, with ``audit``, one that every
    quarantined epoch left an audit row.  :func:`classify_epochs` lists the keys."""
    outcomes = classify_epochs(
        source, target, key, source_column, target_column, encoding, expect_years, sane_years, out_of_range_is_null
    )
    totals = outcomes.agg(
        F.count_if(F.col("outcome") == "matched").alias("matched"),
        F.count_if(F.col("outcome").isin("nulled", "null_source", "not_nulled")).alias("nulled"),
        F.count_if(F.col("outcome").isin(*_BAD_EPOCHS)).alias("mismatched"),
        F.count_if(F.col("outcome") == "target_only").alias("target_only"),
        F.lit(0).cast("bigint").alias("audited"),
    )
    if audit is not None:
        blank = [F.lit(0).cast("bigint").alias(c) for c in ("matched", "nulled", "mismatched", "target_only")]
        audited = audit.where(F.col("src_table") == source_table).agg(F.count(F.lit(1)).alias("audited"))
        totals = totals.unionByName(audited.select(*blank, "audited"))
        totals = totals.agg(*[F.sum(c).alias(c) for c in totals.columns])
    specs = [
        {
            "target": F.lit(name),
            "status": verdict(F.col("mismatched") == 0),
            "message": F.format_string("%d matched, %d nulled, %d bad", "matched", "nulled", "mismatched"),
            "expected": F.lit(0),
            "actual": F.col("mismatched"),
            "metrics": {c: F.col(c) for c in ("matched", "nulled", "mismatched", "target_only")},
        }
    ]
    if audit is not None:
        specs.append(
            {
                "when": F.col("nulled") > 0,
                "target": F.lit(f"{name} (audit)"),
                "status": verdict(F.col("audited") >= F.col("nulled")),
                "message": F.format_string("%d audit rows for %d quarantined epochs", "audited", "nulled"),
                "expected": F.concat(F.lit(">="), F.col("nulled").cast("string")),
                "actual": F.col("audited"),
            }
        )
    return several_checks(totals, "epoch_conversion", specs, **labels)


def _number(df: DataFrame, name: str) -> Column:
    """A number as text that equal values share, NULL for NULL."""
    text = canon.canon_value(name, df.schema[name].dataType, coerce_numeric_strings=True)
    return F.when(F.col(name).isNotNull(), text)


def decimal_differences(source: DataFrame, target: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``key, column, source_value, target_value`` wherever a value changed.

    Values are compared as numbers, so 1.50 equals 1.5; a missing target row
    reads as NULL.  Of a key with several rows on a side every column differs,
    and the value is the number of rows.
    """
    pairs = keyed_compare(source, target, key, {c: c for c in columns}).where("n_source > 0")

    def value(side: str, c: str) -> Column:
        rows = F.concat(F.col(f"n_{side}").cast("string"), F.lit(" rows"))
        return F.when(F.col("duplicated"), rows).otherwise(_number(pairs, f"{side}_{c}")).alias(f"{side}_value")

    cells = [F.struct(F.lit(c).alias("column"), value("source", c), value("target", c), F.col("duplicated")) for c in columns]
    long = pairs.select(*key, F.inline(F.array(*cells)))
    differs = F.col("duplicated") | ~F.col("source_value").eqNullSafe(F.col("target_value"))
    return long.where(differs).drop("duplicated")


def decimal_roundtrip(
    source: DataFrame, target: DataFrame, key: Sequence[str], columns: Sequence[str], *, name: str = "target", **labels
) -> DataFrame:
    """One check per column, each with its own count of changed values; keys with several rows on a side count as changed."""
    pairs = keyed_compare(source, target, key, {c: c for c in columns}).where("n_source > 0")
    texts = {c: F.col("duplicated") | ~_number(pairs, f"source_{c}").eqNullSafe(_number(pairs, f"target_{c}")) for c in columns}
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("duplicated").alias("twice"), *[F.count_if(bad).alias(f"bad_{c}") for c, bad in texts.items()]
    )
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col("n"), F.col("twice"), F.col(f"bad_{c}").alias("bad")) for c in columns])
    return as_checks(
        row.select(F.inline(cells)),
        "decimal_roundtrip",
        target=F.concat(F.lit(name + "."), F.col("column")),
        status=verdict(F.col("bad") == 0),
        message=F.format_string("%d of %d keys changed, %d of them with several rows", "bad", "n", "twice"),
        expected=F.lit(0),
        actual=F.col("bad"),
        metrics={"rows": F.col("n")},
        **labels,
    )
