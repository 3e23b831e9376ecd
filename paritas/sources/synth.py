"""Synthetic tables whose every value is a function of the row id.

A task that runs twice writes the same rows, so generated data survives lost
executors, and a table can be regenerated from its description alone.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.operators.perf import TooExpensive, estimate
from paritas.sources.files import row_salt, write_partitioned

# Rows per size tier.
TIERS = {"small": 1_000_000, "medium": 100_000_000, "large": 1_000_000_000}

_RAND = re.compile(r"\brand\(\s*\)", re.IGNORECASE)


def row_count(rows: str | int) -> int:
    text = str(rows).strip()
    return TIERS[text] if text in TIERS else int(float(text))


def uniform(seed: int, salt: str) -> Column:
    """A double in [0, 1) that depends only on the row id, ``seed`` and ``salt``."""
    text = F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed)), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))


def _column(spec: Mapping, seed: int) -> Column:
    if spec["gen"] == "sequence":
        return F.col("id").alias(spec["name"])
    expression = spec["gen"]
    if _RAND.search(expression):
        # Each rand() of each column draws its own stream.
        counter = iter(range(expression.count("(")))
        expression = _RAND.sub(
            lambda _: f"(conv(substring(md5(concat_ws(':', cast(id AS string), '{seed}', '{spec['name']}{next(counter)}')), 1, 12),"
            f" 16, 10) / {float(1 << 48)!r})",
            expression,
        )
    value = F.expr(expression)
    if spec.get("type"):
        value = value.cast(spec["type"])
    return value.alias(spec["name"])


def synth_table(
    spark: SparkSession, rows: str | int, columns: Sequence[Mapping], seed: int = 42, partitions: int | None = None
) -> DataFrame:
    """Rows 1..n with one column per ``{name, gen, type?}``.

    ``gen`` is ``"sequence"`` or a Spark SQL expression over ``id``; ``rand()``
    in it becomes a hash of the row id.
    """
    ids = spark.range(1, row_count(rows) + 1, 1, partitions) if partitions else spark.range(1, row_count(rows) + 1)
    return ids.select(*[_column(c, seed) for c in columns])


def write_synth_table(
    spark: SparkSession,
    path: str,
    rows: str | int,
    columns: Sequence[Mapping],
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    seed: int = 42,
    max_bytes: int | None = None,
) -> DataFrame:
    """Generate a table, lay it out by partition and cluster columns, and read it back.

    With ``max_bytes`` a table that the optimiser's statistics put above it is
    refused before a row is made.
    """
    df = synth_table(spark, rows, columns, seed)
    if max_bytes is not None and (expected := estimate(df)["result_bytes"]) > max_bytes:
        raise TooExpensive(f"{rows} rows would take {expected} bytes; the limit is {max_bytes}")
    if partition_by:
        write_partitioned(df, path, partition_by, cluster_by)
    elif cluster_by:
        order = [F.col(c) for c in cluster_by]
        df.repartitionByRange(*order, row_salt(df)).sortWithinPartitions(*order).write.parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
