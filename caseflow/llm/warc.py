"""Operator 7: WARC archives, written by Spark and read by a Python data source.

Writing.  A record is text: header lines, an empty line, the payload.  Spark's
own text sink writes the records with ``\\r\\n\\r\\n`` between them, which is the
record end that the format asks for, so any file system Spark can write to
works.  Of rows with equal payloads of at least ``MIN_REVISIT_BYTES`` bytes, the
one with the smallest id is written as ``response`` with its payload; the others
are ``revisit`` records without payload that name it.  Equal payloads meet
through an aggregation of (digest -> smallest id) with map-side combine; the
payloads themselves are never grouped.

Reading.  ``spark.read.format("warc")`` plans one partition per file (small files
share one), takes filters on ``record_type`` and on other header columns, parses
the header lines of each record first, and jumps over the payload of a record
that the filters or the selected columns do not want, without decoding it.
Files may be plain or gzip.  A file is one partition because a payload may hold
anything, also text that looks like a record; the writer keeps files small with
``rows_per_file``.

Defined results: null or empty html has an empty payload and is a response; a
payload below the limit is always a response; rows that repeat the smallest id
of their payload are responses too; a null id never is a referred one unless all
ids of its payload are null, when its rows are responses.  Line ends in a url
are escaped in its header; a null url has no header.  An empty table gives an
archive without records.  Extra columns are never read.
"""

from __future__ import annotations

import gzip
import os
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from caseflow.session import staging_root

MIN_REVISIT_BYTES = 100
ROWS_PER_FILE = 20_000
PARTITION_BYTES = 32 * 1024 * 1024
RECORD_END = "\r\n\r\n"

# Header names of the format, and two of our own.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "page_id": "X-Page-ID",
    "payload_bytes": "X-Payload-Length",
}
SCHEMA = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, page_id long, payload_bytes long, content_length long, payload binary"


def classify(df: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds ``payload``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    large = F.col("payload_bytes") >= min_bytes
    first = (
        rows.where(large).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first_id is not null").drop("n")
    )
    revisit = large & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def header(name: str, value) -> F.Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archives(records: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, compression: str | None = None) -> None:
    """Write classified rows as WARC files below ``path``."""
    url = F.replace(F.replace(F.replace(F.col("url"), F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    is_response = F.col("record_type") == "response"
    body = F.when(is_response, F.col("payload")).otherwise("")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        header(HEADERS["record_type"], F.col("record_type")),
        header(HEADERS["record_id"], F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))),
        header(HEADERS["target_uri"], url),
        header(HEADERS["payload_digest"], F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        header(HEADERS["refers_to"], F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        header(HEADERS["page_id"], F.col("page_id").cast("string")),
        header(HEADERS["payload_bytes"], F.col("payload_bytes").cast("string")),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n")),
        body,
    )
    writer = records.select(record.alias("value")).write.option("lineSep", RECORD_END).option("maxRecordsPerFile", rows_per_file)
    (writer.option("compression", compression) if compression else writer).text(path)


def open_file(uri: str):
    """A local or mounted file directly, any other scheme through Arrow."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path) if parts.scheme else uri, "rb")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def skip(stream, n: int) -> None:
    """Jump over n bytes; gzip streams have to inflate them, but nothing is decoded."""
    if stream.seekable() and not isinstance(stream, gzip.GzipFile):
        stream.seek(n, os.SEEK_CUR)
        return
    while n > 0 and (got := stream.read(min(n, 1 << 20))):
        n -= len(got)


class WarcFiles(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class WarcReader(DataSourceReader):
    """Reads header lines first and payloads only where they are wanted."""

    def __init__(self, spark_files: list[tuple[str, int]], want_payload: bool):
        self.listed = spark_files
        self.want_payload = want_payload
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]):
        """Take equality and IN on header columns; hand the rest back to Spark."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo) and f.value is not None:
                self.wanted.append((name, frozenset([str(f.value)])))
            elif name in HEADERS and isinstance(f, In) and None not in f.value:
                self.wanted.append((name, frozenset(map(str, f.value))))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        parts, run, size = [], [], 0
        for path, n in sorted(self.listed):
            if run and size + n > PARTITION_BYTES:
                parts.append(WarcFiles(run))
                run, size = [], 0
            run.append(path)
            size += n
        return [*parts, WarcFiles(run)]

    def records(self, stream) -> Iterator[dict]:
        names = {v.lower(): k for k, v in HEADERS.items()}
        while line := stream.readline():
            if not line.startswith(b"WARC/"):
                if line.strip():
                    raise ValueError(f"not a WARC record: {line[:80]!r}")
                continue
            got: dict = dict.fromkeys(HEADERS)
            length = 0
            while (line := stream.readline().rstrip(b"\r\n")):
                key, _, value = line.decode("utf-8", "replace").partition(":")
                key, value = key.strip().lower(), value.strip()
                if key == "content-length":
                    length = int(value)
                elif key in names:
                    got[names[key]] = value
            got["target_uri"] = unquote(got["target_uri"]) if got["target_uri"] is not None else None
            if not all(got[name] in allowed for name, allowed in self.wanted):
                skip(stream, length)
                continue
            if self.want_payload:
                got["payload"] = stream.read(length)
            else:
                got["payload"] = None
                skip(stream, length)
            yield got | {"content_length": length}

    def read(self, partition: WarcFiles) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
            ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("content_length", pa.int64()), ("payload", pa.binary()),
        ])
        rows: list[dict] = []
        size = 0
        for path in partition.files:
            with open_file(path) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
                for r in self.records(stream):
                    for name in ("page_id", "payload_bytes"):
                        r[name] = int(r[name]) if r[name] is not None else None
                    rows.append(r)
                    size += len(r["payload"] or b"")
                    if len(rows) >= 2_000 or size >= 16_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    """``spark.read.format("warc").option("files", ...)``; see :func:`read_archives`."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        lines = self.options.get("files", "").split("\n")
        listed = [(p, int(n)) for p, _, n in (x.rpartition("\t") for x in lines if x)]
        return WarcReader(listed, self.options.get("payload", "true").lower() == "true")


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Data files below ``path`` and their sizes, by Spark's own file system."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(jpath)
    return [(f.getPath().toString(), f.getLen()) for f in files if f.isFile() and not f.getPath().getName().startswith(("_", "."))]


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives below ``path``; ``payload=False`` never reads payloads."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    listed = "\n".join(f"{p}\t{n}" for p, n in list_files(spark, path))
    return spark.read.format("warc").option("files", listed).option("payload", str(payload).lower()).load()


def round_trip(df: DataFrame, id_col: str = "page_id", payload_col: str = "html", compression: str | None = "gzip") -> DataFrame:
    """Write ``df`` as archives in the shared folder, read them back, and describe each record.

    The digest and size of a response come from the payload that was read; a
    revisit carries those of the full payload in its header.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(classify(df, id_col, payload_col), path, compression=compression)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    responses = read_archives(spark, path).where(F.col("record_type") == "response").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"), "target_uri",
    )
    revisits = read_archives(spark, path, payload=False).where(F.col("record_type") == "revisit").select(
        "page_id", "payload_bytes", F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type", F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1).cast("long").alias("refers_to"), "target_uri",
    )
    return responses.unionByName(revisits)
