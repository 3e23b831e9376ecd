"""Loads, staged copies, partitioned writes and exports."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.functions import canon
from paritas.operators.parity import multiset_counts
from paritas.operators.report import FAIL, as_checks, check_row, error_text, several_checks, verdict
from paritas.session import delete_path, durable
from paritas.sources import ledger

# Accepted format names.
FORMATS = {
    "NEWLINE_DELIMITED_JSON": "json",
    "JSON": "json",
    "CSV": "csv",
    "PARQUET": "parquet",
    "AVRO": "avro",
    "ORC": "orc",
}


def _after_leading_lines(spark: SparkSession, uri: str, skip: int) -> DataFrame:
    """Lines of every file under ``uri`` except its first ``skip``.

    Line numbers are row ids within a scan task, which reads a file split from
    front to back; only the first split of a file can hold its leading lines.
    """
    lines = spark.read.text(uri).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        (F.col("_metadata.file_block_start") == 0).alias("_front"),
        F.monotonically_increasing_id().alias("_id"),
    )
    first = lines.where("_front").groupBy("_file").agg(F.min("_id").alias("_first"))
    kept = lines.join(first, "_file").where(~F.col("_front") | (F.col("_id") >= F.col("_first") + skip))
    return kept.select("value")


def load(
    spark: SparkSession,
    uri: str,
    fmt: str,
    schema: T.StructType | str | None = None,
    *,
    field_delimiter: str = ",",
    skip_leading_rows: int = 0,
    hive_partitioning: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read files of one format.

    ``hive_partitioning`` is ``{source_uri_prefix, mode}``; mode AUTO infers the
    types of partition columns, STRINGS keeps them as text, CUSTOM takes them
    from ``schema``.  Without ``schema``, types are inferred where the format
    carries none.  A row that does not parse ends the job that reads it.
    """
    name = FORMATS.get(fmt.upper())
    if name is None:
        raise ValueError(f"unsupported load format {fmt!r}")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if hive_partitioning:
        reader = reader.option("basePath", hive_partitioning["source_uri_prefix"])
        infer = hive_partitioning.get("mode", "AUTO").upper() == "AUTO"
        setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = spark.conf.get(setting, "true")
        spark.conf.set(setting, str(infer).lower())
        try:
            # Partition discovery happens here, while the setting holds.
            return _read(spark, reader, uri, name, schema, field_delimiter, skip_leading_rows)
        finally:
            spark.conf.set(setting, before)
    return _read(spark, reader, uri, name, schema, field_delimiter, skip_leading_rows)


def _read(spark, reader, uri, name, schema, delimiter, skip) -> DataFrame:
    if name in ("json", "csv"):
        reader = reader.option("mode", "FAILFAST")
    if name != "csv":
        return reader.format(name).load(uri)
    reader = reader.option("sep", delimiter)
    if schema is None:
        reader = reader.option("inferSchema", True)
    if skip <= 1:
        return reader.option("header", skip == 1).option("enforceSchema", True).csv(uri)
    if schema is None:
        raise ValueError("skipping several leading rows needs a schema")
    layout = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("value", layout, {"sep": delimiter, "mode": "FAILFAST"})
    return _after_leading_lines(spark, uri, skip).select(parsed.alias("r")).select("r.*")


def bulk_load(spark: SparkSession, loads: Sequence[Mapping], folder: str) -> DataFrame:
    """Checks of a list of loads ``{table, uri, format, expected_count, schema?,
    field_delimiter?, skip_leading_rows?, hive_partitioning?}``.

    A load lands in a new folder below ``folder/<table>`` and its rows are counted
    there; only a load of the expected count becomes the table (:func:`landed_table`),
    at once.  One that fails, be it for a single malformed row, is a FAIL row: the
    table keeps the rows it had, and the next load still runs.
    """
    out = None
    for spec in loads:
        target = spec["table"]
        try:
            df = load(
                spark,
                spec["uri"],
                spec["format"],
                spec.get("schema"),
                field_delimiter=spec.get("field_delimiter", ","),
                skip_leading_rows=spec.get("skip_leading_rows", 0),
                hive_partitioning=spec.get("hive_partitioning"),
            )
            path, want = f"{folder}/{target}", spec["expected_count"]
            staged, landed = ledger.stage(df, path)
            if landed == want:
                ledger.commit(spark, path, staged, staged, df.schema, landed, replaces=True)
            else:
                delete_path(spark, f"{path}/{staged}")
        except Exception as e:  # noqa: BLE001 - a failed load is a finding
            row = check_row(spark, "bulk_load", target, FAIL, f"load failed: {error_text(e)}")
            out = row if out is None else out.unionByName(row)
            continue
        rows = check_row(
            spark, "bulk_load", f"{target} ({spec['format']})", "PASS" if landed == want else FAIL,
            f"landed {landed} rows", expected=want, actual=landed, metrics={"rows": landed, "format": spec["format"]},
        )
        column = (spec.get("hive_partitioning") or {}).get("expect_partition_column")
        if column:
            present = column in df.columns
            rows = rows.unionByName(
                check_row(spark, "bulk_load", f"{target} (partition meta)", "PASS" if present else FAIL,
                          "partition column " + ("present" if present else "missing"), expected=column,
                          actual=column if present else None)
            )
        out = rows if out is None else out.unionByName(rows)
    return out


def landed_table(spark: SparkSession, folder: str, table: str) -> DataFrame | None:
    """The table as the last load of :func:`bulk_load` that passed left it; None if there was none."""
    return ledger.table(spark, f"{folder}/{table}")


def stage_formats(df: DataFrame, folder: str, partition: str) -> dict[str, str]:
    """Write four staged copies below ``folder`` and return their paths.

    JSON and pipe-delimited CSV carry decimals and instants as text; Parquet is
    typed; the partitioned JSON keeps ``partition`` only in its folder names.
    """
    texts = df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (T.DecimalType, T.TimestampType, T.TimestampNTZType, T.DateType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    paths = {name: f"{folder}/{name}" for name in ("json", "csv", "parquet", "hive_json")}
    texts.write.json(paths["json"])
    texts.write.option("sep", "|").option("header", True).csv(paths["csv"])
    df.write.parquet(paths["parquet"])
    write_partitioned(texts, paths["hive_json"], [partition], fmt="json")
    return paths


def row_salt(df: DataFrame) -> Column:
    """A hash of the row: the same whenever a task runs again, unlike a row number."""
    return F.xxhash64(*[F.to_json(F.col(f"`{n}`")) if "map<" in kind else F.col(f"`{n}`") for n, kind in df.dtypes])


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    *,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    max_records_per_file: int = 0,
) -> None:
    """Write one folder per partition value, rows sorted by ``cluster_by`` inside.

    Rows are range-partitioned by (partition, cluster, hash of the row) first, so
    a partition value or cluster key holding much of the table is written by
    several tasks, each covering a narrow range that file statistics can skip.
    """
    order = [F.col(c) for c in (*partition_by, *cluster_by)]
    arranged = df.repartitionByRange(*order, row_salt(df)).sortWithinPartitions(*order)
    # Only matters with mode="overwrite": leave partitions alone that df does not hold.
    writer = arranged.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.format(fmt).save(path)


def write_clustered(
    df: DataFrame, path: str, cluster_by: Sequence[str], *, files: int | None = None, bloom: Mapping[str, int] | None = None
) -> None:
    """Write files that each cover a narrow range of ``cluster_by``, so that their statistics skip what a filter excludes.

    ``bloom`` maps other columns to their expected number of values: such a column
    gets a Bloom filter per row group, for lookups of single values.  ``files``
    sets their number; by default it follows from the shuffled bytes.
    """
    order = [F.col(c) for c in cluster_by]
    number = [files] if files else []
    arranged = df.repartitionByRange(*number, *order, row_salt(df)).sortWithinPartitions(*order) if order else df
    writer = arranged.write
    for column, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")  # a filter is only written where no dictionary is
    writer.parquet(path)


def dynamic_partition_write(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df``."""
    write_partitioned(df, path, partition_by, mode="overwrite")


def drop_expired_partitions(spark: SparkSession, path: str, column: str, keep_days: int, today: dt.date) -> list[str]:
    """Delete the date partitions below ``path`` older than ``keep_days``; returns their dates."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    oldest = (today - dt.timedelta(days=keep_days)).isoformat()
    dropped = []
    for status in system.listStatus(root):
        key, _, value = status.getPath().getName().partition("=")
        if key == column and re.fullmatch(r"\d{4}-\d{2}-\d{2}", value) and value < oldest:
            system.delete(status.getPath(), True)
            dropped.append(value)
    return sorted(dropped)


def partition_collapse(df: DataFrame, event_ts: str, drop: Sequence[str], name: str = "event_date") -> DataFrame:
    """Replace (year, month) partition columns by one DATE derived from the event instant."""
    return df.drop(*drop).withColumn(name, F.to_date(event_ts))


def create_table_as(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace ``table`` from ``df`` and return it."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def export_json(df: DataFrame, path: str) -> DataFrame:
    """Export as newline JSON and read every line back with the same schema; a line that does not parse ends the read."""
    df.write.json(path)
    return df.sparkSession.read.schema(df.schema).option("mode", "FAILFAST").json(path)


def control_totals(df: DataFrame, column: str) -> DataFrame:
    """``row_cnt, control_total``: exact sum, what does not read as a number counts 0."""
    amount = F.coalesce(F.col(column).cast("string").try_cast("decimal(38,9)"), F.lit(0).cast("decimal(38,9)"))
    # Whole units and fractions apart: neither sum leaves its type.
    whole = F.floor(amount)
    fraction = (amount - whole).cast("decimal(10,9)")
    total = F.coalesce(F.sum(whole.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,9)") + F.coalesce(F.sum(fraction), F.lit(0))
    total = total.cast("decimal(38,9)")
    return df.agg(F.count(F.lit(1)).alias("row_cnt"), total.alias("control_total"))


def egress_parity(
    legacy: DataFrame,
    exported: DataFrame,
    columns: Sequence[str],
    control_total: str | None = None,
    *,
    name: str = "export",
    **labels,
) -> DataFrame:
    """Checks that an export equals its legacy counterpart: same multiset of
    canonical rows (numeric text read as numbers), same row count, same control total."""
    counts = multiset_counts(legacy, exported, columns, coerce_numeric_strings=True)
    differing = counts.select((F.col("missing") + F.col("unexpected")).alias("n"))
    checks = as_checks(
        differing,
        "egress_parity",
        target=F.lit(f"{name} (identity)"),
        status=verdict(F.col("n") == 0),
        message=F.concat(F.col("n").cast("string"), F.lit(" differing rows")),
        expected=F.lit(0),
        actual=F.col("n"),
        **labels,
    )
    column = control_total or columns[0]
    sides = control_totals(legacy, column).withColumn("_side", F.lit(0)).unionByName(
        control_totals(exported, column).withColumn("_side", F.lit(1))
    )
    pick = lambda c, side: F.max(F.when(F.col("_side") == side, F.col(c)))
    both = sides.agg(*[pick(c, i).alias(f"{s}_{c}") for i, s in enumerate("le") for c in ("row_cnt", "control_total")])
    compared = [("row_cnt", "row_cnt")] + ([("control_total", f"control_total:{control_total}")] if control_total else [])
    specs = []
    for c, label in compared:
        dtype = both.schema[f"l_{c}"].dataType
        variance = canon.canon_sql(f"CAST(abs(l_{c} - e_{c}) AS {dtype.simpleString()})", dtype)
        specs.append(
            {
                "target": F.lit(f"{name} ({label})"),
                "status": verdict(F.col(f"l_{c}") == F.col(f"e_{c}")),
                "message": F.concat(F.lit("variance "), F.expr(variance)),
                "expected": canon.canon_value(f"l_{c}", dtype),
                "actual": canon.canon_value(f"e_{c}", dtype),
            }
        )
    return checks.unionByName(several_checks(both, "egress_parity", specs, **labels))


#: Largest file read as one piece where only its first line is wanted.
_WHOLE_FILE = 1 << 40


def _file_per_task(spark: SparkSession) -> SparkSession:
    """A session whose scans give every file (up to a terabyte) to a task of its own, whole and from its front."""
    session = spark.newSession()
    for setting in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{setting}", str(_WHOLE_FILE))
    return session


#: Files whose first line is read at a time, and bytes of a line at most.
_HEADS_AT_ONCE, _LONGEST_HEADER = 16, 1 << 20


def first_lines(spark: SparkSession, uri: str) -> DataFrame:
    """``_path, line``: the first line of every file that has one; paths as :func:`_file_path` has them.

    Each file is opened and read up to its first line break, so the bytes read do
    not depend on the sizes of the files.  (A Spark scan can't end after a row per
    file: Python workers read their input to the end, and a limit holds for the
    whole result.)  The driver holds a line per file, as it holds their listing.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def head(name: str) -> tuple[str, str] | None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = path.getFileSystem(conf).open(path)
        try:
            codec = codecs.getCodec(path)
            line = jvm.org.apache.hadoop.io.Text()
            lines = jvm.org.apache.hadoop.util.LineReader(codec.createInputStream(stream) if codec else stream)
            return (name, line.toString()) if lines.readLine(line, _LONGEST_HEADER) else None
        finally:
            stream.close()

    with ThreadPoolExecutor(_HEADS_AT_ONCE) as pool:
        found = [x for x in pool.map(head, spark.read.text(uri).inputFiles()) if x]
    listed = spark.createDataFrame(found, "_path string, line string")
    return listed.select(_one_slash("_path").alias("_path"), "line")


def _one_slash(path: str) -> Column:
    """A path with one slash after its scheme: listings and scans differ in how many they write."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _file_path() -> Column:
    """The path of the file a scanned row comes from."""
    return _one_slash("_metadata.file_path").alias("_path")


def _header_verdicts(spark: SparkSession, uri: str, header: str) -> DataFrame:
    """``_path, found, status`` per file."""
    same = F.col("line") == header
    return first_lines(spark, uri).select("_path", F.col("line").alias("found"), F.when(same, "ACCEPTED").otherwise("QUARANTINED").alias("status"))


def header_drift(spark: SparkSession, uri: str, expected: Sequence[str], delimiter: str = ",") -> DataFrame:
    """``file, status``: files whose first line is not the expected header are quarantined."""
    verdicts = _header_verdicts(spark, uri, delimiter.join(expected))
    return verdicts.select(F.regexp_extract("_path", r"([^/]+)$", 1).alias("file"), "status")


def quarantine(spark: SparkSession, uri: str, expected: Sequence[str], folder: str, delimiter: str = ",") -> DataFrame:
    """Copy the files with another header below ``folder``; returns the reasons, a row per file.

    ``folder/lines`` holds ``line_no, line`` by ``file``, ``folder/reasons`` the rows
    ``file, path, reason, expected, found``.  A file without the header's columns is
    told from one with the same columns in another order.
    """
    header = delimiter.join(expected)
    drifted = durable(_header_verdicts(spark, uri, header).where("status = 'QUARANTINED'"), "drifted")
    columns = F.split("found", re.escape(delimiter), -1)
    listed = F.array(*[F.lit(c) for c in expected])
    missing, extra = F.array_except(listed, columns), F.array_except(columns, listed)
    parts = [
        F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))),
        F.when(F.size(extra) > 0, F.concat(F.lit("unexpected: "), F.array_join(extra, ", "))),
    ]
    reason = F.when((F.size(missing) == 0) & (F.size(extra) == 0), "other order").otherwise(F.concat_ws("; ", *parts))
    name = F.regexp_extract("_path", r"([^/]+)$", 1).alias("file")
    reasons = drifted.select(name, F.col("_path").alias("path"), reason.alias("reason"), F.lit(header).alias("expected"), "found")
    reasons.write.json(f"{folder}/reasons")
    # In file order: a task reads one file from its front, and ids within a task count up.
    session = _file_per_task(spark)
    lines = session.read.text(uri).select(
        _file_path(), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("line_no"), F.col("value").alias("line")
    )
    known = session.read.json(f"{folder}/reasons", schema="file string, path string") if not drifted.isEmpty() else None
    if known is not None:
        kept = lines.join(known, F.col("_path") == F.col("path")).select("file", (F.col("line_no") + 1).alias("line_no"), "line")
        kept.write.partitionBy("file").parquet(f"{folder}/lines")
    return reasons


def accepted_rows(
    spark: SparkSession, uri: str, expected: Sequence[str], schema: str, delimiter: str = ","
) -> DataFrame:
    """Rows of the files whose header is the expected one."""
    verdicts = _header_verdicts(spark, uri, delimiter.join(expected)).where("status = 'ACCEPTED'").select("_path")
    rows = spark.read.schema(schema).option("sep", delimiter).option("header", True).csv(uri)
    kept = rows.select("*", _file_path().alias("_from")).join(verdicts, F.col("_from") == F.col("_path"), "left_semi")
    return kept.drop("_from")
