"""Rollups kept up to date from change batches, without reading the fact again.

The state of a group is what can be added and taken away: its rows, and per
measure the sum and the number of values.  Distinct counts keep a row per group
and value with its multiplicity, since a value that is deleted once may still be
there.  A batch is folded to the same form, deletions with negative signs, and
added; groups and values of which nothing is left go.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.sources import ledger


@dataclass(frozen=True)
class Rollup:
    """``keys`` to group by, ``measures`` with sums and means, ``distinct`` columns to count values of."""

    keys: Sequence[str]
    measures: Sequence[str] = ()
    distinct: Sequence[str] = field(default_factory=tuple)

    def state(self, rows: DataFrame, sign: str = "1") -> tuple[DataFrame, DataFrame]:
        """``(groups, values)`` of fact rows; ``sign`` is SQL, 1 for a row that comes and -1 for one that goes."""
        exact = lambda m: F.col(m).cast(_summable(rows.schema[m].dataType))
        signed = rows.withColumn("_sign", F.expr(sign))
        parts = [F.sum(F.col("_sign").cast("bigint")).alias("_rows")]
        for m in self.measures:
            parts.append(F.sum(exact(m) * F.col("_sign").cast("decimal(1,0)")).cast(_SUM).alias(f"sum_{m}"))
            parts.append(F.sum(F.when(F.col(m).isNotNull(), F.col("_sign")).otherwise(0).cast("bigint")).alias(f"n_{m}"))
        groups = signed.groupBy(*self.keys).agg(*parts)
        values = None
        for c in self.distinct:
            one = signed.where(F.col(c).isNotNull()).select(*self.keys, F.lit(c).alias("_column"), F.col(c).cast("string").alias("_value"), "_sign")
            one = one.groupBy(*self.keys, "_column", "_value").agg(F.sum(F.col("_sign").cast("bigint")).alias("_copies"))
            values = one if values is None else values.unionByName(one)
        if values is None:
            values = groups.select(*self.keys, F.lit("").alias("_column"), F.lit("").alias("_value"), F.col("_rows").alias("_copies")).where("false")
        return groups, values

    def added(self, one: tuple[DataFrame, DataFrame], other: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
        """The sum of two states.  More rows taken away than there are ends the query."""
        sums = [F.sum("_rows").alias("_rows")]
        for m in self.measures:
            sums += [F.sum(f"sum_{m}").cast(_SUM).alias(f"sum_{m}"), F.sum(f"n_{m}").alias(f"n_{m}")]
        groups = _whole(one[0].unionByName(other[0]).groupBy(*self.keys).agg(*sums), "_rows")
        values = one[1].unionByName(other[1]).groupBy(*self.keys, "_column", "_value").agg(F.sum("_copies").alias("_copies"))
        return groups, _whole(values, "_copies")

    def table(self, groups: DataFrame, values: DataFrame) -> DataFrame:
        """The rollup: keys, ``rows``, ``sum_<m>``, ``avg_<m>`` (as a double) and ``distinct_<c>``."""
        out = groups
        if self.distinct:
            counts = [F.count_if(F.col("_column") == c).alias(f"distinct_{c}") for c in self.distinct]
            counted = values.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(self.keys)]).agg(*counts)
            same = F.lit(True)
            for i, k in enumerate(self.keys):
                same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
            out = groups.join(counted, same, "left")
        measures = [c for m in self.measures for c in (
            F.when(F.col(f"n_{m}") > 0, F.col(f"sum_{m}")).alias(f"sum_{m}"),
            F.when(F.col(f"n_{m}") > 0, F.col(f"sum_{m}").cast("double") / F.col(f"n_{m}")).alias(f"avg_{m}"),
        )]
        found = [F.coalesce(F.col(f"distinct_{c}"), F.lit(0)).alias(f"distinct_{c}") for c in self.distinct]
        return out.select(*self.keys, F.col("_rows").alias("rows"), *measures, *found)


_SUM = "decimal(38,9)"


def _summable(dtype: T.DataType) -> str:
    """Sums are exact: doubles have no place in a state that is added to and taken from."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        raise ValueError("measures of a maintained rollup must be exact; cast doubles to a decimal first")
    return "decimal(28,9)"


def _whole(state: DataFrame, count: str) -> DataFrame:
    left = F.when(F.col(count) >= 0, F.col(count)).otherwise(F.raise_error(F.lit("a batch takes away more rows than there are")))
    return state.withColumn(count, left).where(F.col(count) > 0)


class MaintainedRollup:
    """A rollup whose state lies below ``path`` and changes by whole batches.

    Every batch is recorded with its run, so a batch that is applied again after
    a crash changes nothing; one that did not get to its record left nothing.
    """

    def __init__(self, spark: SparkSession, path: str, rollup: Rollup):
        self.spark, self.path, self.rollup = spark, path.rstrip("/"), rollup

    def _state(self) -> tuple[DataFrame, DataFrame] | None:
        groups, values = (ledger.table(self.spark, f"{self.path}/{part}") for part in ("groups", "values"))
        return None if groups is None else (groups, self._matching(groups, values))

    def _matching(self, groups: DataFrame, values: DataFrame | None) -> DataFrame:
        # Values are committed first; the record of the groups, written last, names the state that counts.
        run = ledger.live(ledger.entries(self.spark, f"{self.path}/groups"))[-1]["run"]
        lines = [line for line in ledger.entries(self.spark, f"{self.path}/values") if line["run"] == run]
        return self.spark.read.schema(values.schema).parquet(f"{self.path}/values/{lines[0]['folder']}")

    def apply(self, batch: DataFrame, run: str, op: str | None = None, delete: str = "D") -> bool:
        """Add a batch of fact rows, those whose ``op`` is ``delete`` with negative signs; False if the run is recorded.

        A changed row is two rows of a batch: the old one deleted, the new one added.
        """
        if any(line["run"] == run for line in ledger.entries(self.spark, f"{self.path}/groups")):
            return False
        state = self.rollup.state(batch, f"IF(`{op}` <=> '{delete}', -1, 1)" if op else "1")
        before = self._state()
        groups, values = self.rollup.added(before, state) if before else (_whole(state[0], "_rows"), _whole(state[1], "_copies"))
        for part, df in (("values", values), ("groups", groups)):
            folder, rows = ledger.stage(df, f"{self.path}/{part}")
            ledger.commit(self.spark, f"{self.path}/{part}", run, folder, df.schema, rows, replaces=True)
        return True

    def table(self) -> DataFrame:
        """The rollup as the last batch left it."""
        state = self._state()
        if state is None:
            raise ValueError("no batch was applied yet")
        return self.rollup.table(*state)
