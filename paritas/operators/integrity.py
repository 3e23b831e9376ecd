"""Keys, NULLs and references inside one table or between a child and its parent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.functions.types import signature
from paritas.operators.report import several_checks, verdict
from paritas.session import durable


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``n_rows, n_distinct, duplicate_keys`` of a key tuple; NULL counts as a value."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
    )


def assert_no_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, nulls`` for every named column, in one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """``key, n_rows`` of child keys with no parent; a NULL key is an orphan.

    Children are counted per key before the join, so a key holding a large
    share of the table joins as one row.
    """
    keys = child.groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_key).alias("_parent"))
    return keys.join(known, F.col("key") == F.col("_parent"), "left_anti")


def fk_orphan_rate(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """``orphans, total, rate``; an empty child has rate 0."""
    keys = child.groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    joined = keys.join(known, F.col("key") == F.col("_parent"), "left")
    totals = joined.agg(
        F.coalesce(F.sum(F.when(F.col("_parent").isNull(), F.col("n_rows"))), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total"),
    )
    rate = F.when(F.col("total") > 0, F.col("orphans") / F.col("total")).otherwise(F.lit(0.0))
    return totals.withColumn("rate", rate)


def fk_orphan(
    source: tuple[DataFrame, DataFrame],
    target: tuple[DataFrame, DataFrame],
    child_key: str,
    parent_key: str,
    tolerance_pp: float = 0.0,
    max_orphan_rate: float | None = None,
    *,
    name: str = "child->parent",
    **labels,
) -> DataFrame:
    """Orphan rates of (child, parent) on both sides must agree within
    ``tolerance_pp`` percentage points; optionally the target's is capped in percent."""
    rates = fk_orphan_rate(*source, child_key, parent_key).withColumn("_side", F.lit(0)).unionByName(
        fk_orphan_rate(*target, child_key, parent_key).withColumn("_side", F.lit(1))
    )
    pick = lambda c, side: F.max(F.when(F.col("_side") == side, F.col(c)))
    both = rates.agg(*[pick(c, i).alias(f"{s}_{c}") for i, s in enumerate("st") for c in ("orphans", "total", "rate")])
    shown = lambda s: F.concat(
        F.col(f"{s}_orphans").cast("string"), F.lit("/"), F.col(f"{s}_total").cast("string")
    )
    metrics = {"source_rate": F.col("s_rate"), "target_rate": F.col("t_rate")}
    specs = [
        {
            "target": F.lit(f"{name} (parity)"),
            "status": verdict(F.abs(F.col("t_rate") - F.col("s_rate")) <= F.lit(tolerance_pp / 100.0)),
            "message": F.concat(F.lit("orphans src "), shown("s"), F.lit(" tgt "), shown("t")),
            "expected": shown("s"),
            "actual": shown("t"),
            "metrics": metrics,
        }
    ]
    if max_orphan_rate is not None:
        specs.append(
            {
                "target": F.lit(f"{name} (max)"),
                "status": verdict(F.col("t_rate") <= F.lit(max_orphan_rate / 100.0)),
                "message": F.concat(F.lit(f"cap {max_orphan_rate} percent, orphans "), shown("t")),
                "expected": F.lit(f"<={max_orphan_rate}%"),
                "actual": shown("t"),
                "metrics": metrics,
            }
        )
    return several_checks(both, "fk_orphan", specs, **labels)


def fk_type_consistency(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    pairs: Sequence[tuple[str, str, str, str]],
    *,
    with_orphans: bool = True,
) -> DataFrame:
    """For each declared (child, child key, parent, parent key): both logical types,
    whether they agree, and (where they do) how many child rows have no parent."""
    out = None
    for child, ck, parent, pk in pairs:
        types = [signature(tables[t].schema[c].dataType, with_scale=True) if c in tables[t].columns else "MISSING"
                 for t, c in ((child, ck), (parent, pk))]
        ok = types[0] == types[1] and "MISSING" not in types
        labels = [
            F.lit(f"{child}.{ck}").alias("child"),
            F.lit(f"{parent}.{pk}").alias("parent"),
            F.lit(types[0]).alias("child_type"),
            F.lit(types[1]).alias("parent_type"),
            F.lit("PASS" if ok else "FAIL").alias("status"),
        ]
        if with_orphans and ok:
            row = fk_orphan_rate(tables[child], tables[parent], ck, pk).select(*labels, "orphans", "total")
        else:
            none = F.lit(None).cast("bigint")
            row = spark.range(1).select(*labels, none.alias("orphans"), none.alias("total"))
        out = row if out is None else out.unionByName(row)
    return out


# -- chains of references --------------------------------------------------------

Reference = tuple[str, str, str, str]


def reference_chains(references: Sequence[Reference], start: str) -> list[list[Reference]]:
    """Every way along the (child, child key, parent, parent key) references from a table to one that refers to no other.

    A table that a chain has met ends it, so circles and references of a table to itself do too.
    """
    out: list[list[Reference]] = []

    def walk(at: str, met: tuple[str, ...], chain: list[Reference]) -> None:
        onward = [r for r in references if r[0] == at and r[2] not in met]
        if not onward and chain:
            out.append(chain)
        for r in onward:
            walk(r[2], (*met, r[2]), [*chain, r])

    walk(start, (start,), [])
    return out


def fk_chain(tables: dict[str, DataFrame], chain: Sequence[Reference], *, name: str | None = None) -> DataFrame:
    """A row per reference of a chain: ``chain, hop, child, parent, child_type, parent_type, types_agree, reached, broken, status``.

    ``reached`` counts the rows of the first table that come as far as this child,
    ``broken`` those of them whose key names no parent, so a row that is lost on
    its way is counted once, where it is lost.  Rows are folded to one per key
    before each join, with how many rows of the first table stand behind it.
    """
    spark = tables[chain[0][0]].sparkSession
    name = name or " > ".join([chain[0][0], *[r[2] for r in chain]])
    weights = tables[chain[0][0]].groupBy(F.col(chain[0][1]).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    out = None
    for hop, (child, ck, parent, pk) in enumerate(chain, 1):
        kinds = [signature(tables[t].schema[c].dataType, with_scale=True) for t, c in ((child, ck), (parent, pk))]
        onward = chain[hop][1] if hop < len(chain) else pk
        # A parent key that is there twice would carry its rows twice.
        known = tables[parent].where(F.col(pk).isNotNull()).groupBy(F.col(pk).alias("_parent")).agg(F.min(F.col(onward)).alias("_onward"))
        met = durable(weights.join(known, F.col("_key") == F.col("_parent"), "left"), "hop")
        broken = F.coalesce(F.sum(F.when(F.col("_parent").isNull(), F.col("_rows"))), F.lit(0))
        row = met.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("reached"), broken.alias("broken"))
        agree = F.lit(kinds[0] == kinds[1])
        row = row.select(
            F.lit(name).alias("chain"), F.lit(hop).alias("hop"), F.lit(f"{child}.{ck}").alias("child"), F.lit(f"{parent}.{pk}").alias("parent"),
            F.lit(kinds[0]).alias("child_type"), F.lit(kinds[1]).alias("parent_type"), agree.alias("types_agree"), "reached", "broken",
            verdict(agree & (F.col("broken") == 0)).alias("status"),
        )
        out = row if out is None else out.unionByName(row)
        weights = met.where("_parent IS NOT NULL").groupBy(F.col("_onward").alias("_key")).agg(F.sum("_rows").alias("_rows"))
    return out if out is not None else spark.createDataFrame([], "chain string")


def key_type_chain(tables: dict[str, DataFrame], column: str, names: Sequence[str] | None = None) -> DataFrame:
    """``column, table, type, status``: a key has one logical type in every table that holds it, that of the first."""
    holders = [t for t in names or tables if column in tables[t].columns]
    kinds = {t: signature(tables[t].schema[column].dataType, with_scale=True) for t in holders}
    spark = next(iter(tables.values())).sparkSession
    rows = [(column, t, kinds[t], "PASS" if kinds[t] == kinds[holders[0]] else "FAIL") for t in holders]
    return spark.createDataFrame(rows, "column string, table string, type string, status string")
