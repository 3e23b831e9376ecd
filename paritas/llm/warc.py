"""WARC archives of pages: written as whole-file gzip streams, normalised to one member per record, read back by offset.

* ``write_archives`` gives every page a record.  Of pages with equal payloads of
  at least 1000 bytes the one with the largest id is a response, the others
  revisit it and carry no payload.  Spark's text writer makes each part file one
  gzip stream, through whatever store the folder lies in.
* ``normalise`` inflates each stream once, in pieces, rewrites every record as a
  gzip member of its own and writes a sidecar index of offsets beside the archive.
* ``read_records`` fetches members by offset, checks lengths and payload digests
  and returns the records.

A task that runs again writes under a name of its own and then renames, so an
archive is whole or absent.

Defined cases: null html is an empty payload; a null id is an empty field and
reads back null; line breaks in a url are percent-encoded.  Rows that repeat the
largest id of a payload are responses all.  Payloads below 1000 bytes never
revisit.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.llm.common import Workspace, ship

REVISIT_BYTES = 1000
RECORDS_PER_ARCHIVE = 20_000
_END = "\r\n\r\n"
_CHUNK = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"

INDEX = "archive string, seq bigint, offset bigint, length bigint, record_id string, record_type string"
RECORD = (
    "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"
)


def _plan(pages: DataFrame, id_col: str, url_col: str, html_col: str, work: Workspace) -> DataFrame:
    """Pages with ``digest``, ``size`` and ``refers_to`` (null for responses)."""
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), html.alias("html"))
    rows = rows.withColumn("size", F.octet_length("html")).withColumn("digest", F.sha1("html"))
    groups = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("n"))
    groups = work.write(groups.where("n > 1").select("digest", "largest"), "groups")
    rows = rows.join(groups, "digest", "left")
    # Null ids are smaller than any other, so a null id revisits if its group has a page with an id.
    return rows.withColumn("refers_to", F.when(~F.col("largest").eqNullSafe(F.col("id")), F.col("largest")))


def _record_id(id_: str):
    digest = F.md5(F.concat(F.lit("page:"), F.coalesce(F.col(id_).cast("string"), F.lit(""))))
    groups = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def write_archives(
    pages: DataFrame, work: Workspace, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> str:
    """Write the archives below the workspace; the folder's path comes back."""
    rows = _plan(pages, id_col, url_col, html_col, work)
    revisit = F.col("refers_to").isNotNull()
    payload = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(_END)
    )
    block = F.concat(http, payload)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id("id")),
        line("WARC-Date", F.lit(_DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(
            revisit, F.concat(line("WARC-Refers-To", _record_id("refers_to")), line("WARC-Profile", F.lit(_PROFILE)),
                              line("X-Refers-To-Page", F.col("refers_to").cast("string")))
        ).otherwise(F.lit("")),
        line("X-Page", F.coalesce(F.col("id").cast("string"), F.lit(""))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    path = f"{work.folder}/whole"
    writer = rows.select(F.concat(header, block)).write.option("lineSep", _END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path)
    return path


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8").split("\r\n")[1:]
    return {name: value for name, _, value in (line.partition(": ") for line in lines if line)}


def _records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(fields, record bytes)`` of one inflated stream, read in pieces; holds one record and a piece."""
    inflate, held, done = zlib.decompressobj(31), bytearray(), False
    while True:
        end = held.find(b"\r\n\r\n")
        fields = _fields(bytes(held[:end])) if end >= 0 else None
        whole = end + 8 + int(fields["Content-Length"]) if fields else None
        while not done and (whole is None or len(held) < whole):
            piece = source.read(_CHUNK)
            if not piece:
                done = True
                held += inflate.flush()
                break
            while piece:
                held += inflate.decompress(piece)
                piece = inflate.unused_data  # a store may have joined streams
                if piece:
                    inflate = zlib.decompressobj(31)
            if whole is None:
                break
        if whole is not None and len(held) >= whole:
            yield fields, bytes(held[:whole])
            del held[:whole]
        elif done and not held:
            return
        elif done and (whole is None and held.find(b"\r\n\r\n") < 0 or whole is not None):
            raise ValueError(f"archive ends within a record, {len(held)} bytes left")


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:/") else f"file://{uri}")


def _uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def normalise(spark: SparkSession, whole: str, work: Workspace) -> DataFrame:
    """Rewrite every archive of ``whole``, one gzip member per record; the index of all members comes back.

    Beside each archive lies its sidecar, ``<archive>.idx``: offset, length,
    record id and type per line.
    """
    ship(spark)
    target = _uri(f"{work.folder}/members")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, source = _open(_uri(path))
                out, folder = _open(target)
                out.create_dir(folder, recursive=True)
                name = path.rsplit("/", 1)[-1].removesuffix(".txt.gz") + ".warc.gz"
                rows, at = [], 0
                with store.open_input_stream(source, compression=None) as stream, out.open_output_stream(
                    f"{folder}/.{name}.{attempt}", compression=None
                ) as archive:
                    for fields, record in _records(stream):
                        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = squeeze.compress(record) + squeeze.flush()
                        archive.write(member)
                        rows.append((f"{target}/{name}", len(rows), at, len(member), fields["WARC-Record-ID"], fields["WARC-Type"]))
                        at += len(member)
                with out.open_output_stream(f"{folder}/.{name}.idx.{attempt}", compression=None) as sidecar:
                    sidecar.write("".join(f"{r[2]}\t{r[3]}\t{r[4]}\t{r[5]}\n" for r in rows).encode())
                out.move(f"{folder}/.{name}.{attempt}", f"{folder}/{name}")
                out.move(f"{folder}/.{name}.idx.{attempt}", f"{folder}/{name}.idx")
                if rows:
                    columns = [pa.array(c) for c in zip(*rows)]
                    yield pa.RecordBatch.from_arrays(columns, names=["archive", "seq", "offset", "length", "record_id", "record_type"])

    files = spark.read.format("binaryFile").load(whole).select("path")  # names only; contents are pruned
    each = max(1, files.count())
    return work.write(files.repartition(each, "path").mapInArrow(rewrite, INDEX), "index")


def read_records(index: DataFrame) -> DataFrame:
    """The records an index names, fetched member by member and checked."""
    ship(index.sparkSession)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, archive = None, None
        for batch in batches:
            rows = []
            for path, offset, length in zip(*[batch.column(c).to_pylist() for c in ("archive", "offset", "length")]):
                if path != name:
                    if archive is not None:
                        archive.close()
                    store, source = _open(path)
                    name, archive = path, store.open_input_file(source)
                archive.seek(offset)
                record = zlib.decompress(archive.read(length), 31)
                head, _, rest = record.partition(b"\r\n\r\n")
                fields = _fields(head)
                block = rest[: int(fields["Content-Length"])]
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(_fields(http)["Content-Length"])
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"{fields['WARC-Record-ID']} in {path}: payload differs from its header")
                rows.append((
                    fields["X-Page"] or None, fields["WARC-Target-URI"], size, digest, fields["WARC-Type"],
                    fields.get("X-Refers-To-Page"), payload,
                ))
                if len(rows) == 256:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return index.select("archive", "offset", "length").mapInArrow(fetch, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write, normalise and read back: per page its id, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``."""
    spark = pages.sparkSession
    work = Workspace(spark, "warc")
    index = normalise(spark, write_archives(pages, work, id_col, url_col, html_col), work)
    work.drop("whole")
    kind = pages.schema[id_col].dataType
    return read_records(index).select(
        F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
