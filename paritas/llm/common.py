"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import paritas
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paritas.session import scratch_path

_SHIPPED: set[str] = set()
#: Rows that go to a Python worker at a time, in bytes; bounds what workers hold, however long the texts.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``spark-submit --py-files`` would, and bound Arrow batches."""
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(paritas.__file__).parent
        # The driver serves the archive to executors until the application ends, then the folder goes.
        folder = tempfile.mkdtemp(prefix="paritas-py-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/paritas", "zip", package.parent, package.name))
        _SHIPPED.add(app)


def release() -> None:
    """Give memory freed by numpy and Arrow back to the system.

    Spark reuses its Python workers, so what a worker keeps for later counts
    against the executor through all stages that follow.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what the work on one has freed is given back before the next, and after the last."""
    for batch in batches:
        yield batch
        del batch
        release()


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


class Workspace:
    """Tables an operator writes below the shared folder, so that a lost executor costs no recomputation.

    ``write`` cuts the lineage: later steps read files every executor reaches.
    ``drop`` deletes a table as soon as no later step reads it; what a result
    still reads stays until ``paritas.session.release_scratch``.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = scratch_path(spark, label)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = hadoop(f"{self.folder}/{name}")
            path.getFileSystem(conf).delete(path, True)

    def sweep(self) -> None:
        """Let Spark's cleaner delete shuffle files of finished steps now, not when the driver next collects garbage."""
        gc.collect()
        self.spark._jvm.System.gc()


def row_keys(id_col: Column, text: Column) -> list[Column]:
    """128 bits that tell rows apart by id and text, nulls included."""
    return [
        F.xxhash64(id_col, text, text.isNull()).alias("_k1"),
        F.xxhash64(F.lit("second"), text, id_col, id_col.isNull()).alias("_k2"),
    ]


def keep_rows(
    docs: DataFrame, chosen: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: str | None = None
) -> DataFrame:
    """Rows of ``docs`` whose key is in ``chosen`` (``_k1``, ``_k2``, unique), each key once, all columns.

    Rows equal in id and text are one document; of them the one whose other
    columns hash lowest stays.  ``times`` names a column of ``chosen``: so many
    copies of the row come out.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *row_keys(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    )
    hashable = [F.to_json(f"_row.`{n}`") if "map<" in kind else F.col(f"_row.`{n}`") for n, kind in docs.dtypes]
    same = Window.partitionBy("_k1", "_k2").orderBy(F.xxhash64(*hashable))
    kept = packed.join(chosen, ["_k1", "_k2"]).withColumn("_n", F.row_number().over(same)).where("_n = 1")
    if times:
        kept = kept.select("_row", F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))))
    return kept.select("_row.*")


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring items of at most ``limit`` in sum; a larger item goes alone."""
    start = total = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > limit:
            yield start, at
            start, total = at, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)
