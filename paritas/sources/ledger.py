"""Tables that change by whole commits: folders of files, and a ledger of which of them count.

A change writes its rows to a new folder beside the others and then appends one
line to the ledger.  A table is what its ledger lists, so a change that ends
early, wherever it ends, leaves the table as it was, and a run that is recorded
is not taken twice.  Both are plain Spark writes: a line of the ledger is a file
that appears when its job commits.

The ledger is read on the driver: a line per change, not per row.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from paritas.session import delete_path

LINE = "seq bigint, run string, folder string, layout string, rows bigint, watermark string, replaces boolean, at timestamp"


def entries(spark: SparkSession, path: str) -> list[Row]:
    """The ledger's lines in order; of several lines of one run (written side by side) the first counts."""
    try:
        found = spark.read.schema(LINE).json(f"{path}/ledger").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    out: dict[str, Row] = {}
    for line in sorted(found, key=lambda r: (r["seq"], r["at"], r["folder"])):
        out.setdefault(line["run"], line)
    return list(out.values())


def live(lines: list[Row]) -> list[Row]:
    """The lines whose folders make up the table: from the last that replaces everything before it."""
    last = max((i for i, line in enumerate(lines) if line["replaces"]), default=0)
    return lines[last:]


def table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as its ledger has it; None before the first commit."""
    lines = live(entries(spark, path))
    if not lines:
        return None
    layout = T.StructType.fromJson(json.loads(lines[-1]["layout"]))
    return spark.read.schema(layout).parquet(*[f"{path}/{line['folder']}" for line in lines])


def stage(df: DataFrame, path: str) -> tuple[str, int]:
    """Write ``df`` to a new folder below ``path``; returns its name and the rows that landed."""
    folder = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    return folder, df.sparkSession.read.schema(df.schema).parquet(f"{path}/{folder}").count()


def commit(
    spark: SparkSession, path: str, run: str, folder: str, layout: T.StructType, rows: int, *, watermark: str | None = None, replaces: bool = False
) -> None:
    """Make a staged folder part of the table, or all of it."""
    lines = entries(spark, path)
    seq = max((line["seq"] for line in lines), default=0) + 1
    line = (seq, run, folder, layout.json(), rows, watermark, replaces, dt.datetime.now())
    spark.createDataFrame([line], LINE).coalesce(1).write.mode("append").json(f"{path}/ledger")


def replace(df: DataFrame, path: str, run: str | None = None) -> int:
    """Make ``df`` the whole table; returns its rows."""
    folder, rows = stage(df, path)
    commit(df.sparkSession, path, run or folder, folder, df.schema, rows, replaces=True)
    return rows


def sweep(spark: SparkSession, path: str) -> int:
    """Delete the folders of recorded changes that no longer count; readers of older states end here."""
    lines = entries(spark, path)
    kept = {line["folder"] for line in live(lines)}
    gone = [line["folder"] for line in lines if line["folder"] not in kept]
    for folder in gone:
        delete_path(spark, f"{path}/{folder}")
    return len(gone)
