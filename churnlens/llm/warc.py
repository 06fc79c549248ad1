"""WARC archives: a Python data source that writes and reads them, and payload de-duplication.

Reading plans one partition per archive file (the writer starts a new file at ``max_file_bytes``).
Equality and IN filters on the record type and other header columns are pushed down.  A reader parses
a record's headers first; if the record is not wanted, or no payload is asked for, it jumps to the next
record by the lengths in the gzip member's extra field and never inflates the rest.

Files are reached through Arrow's filesystems, so the path may be local, S3, GCS or HDFS.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)

from churnlens.llm.tables import checkpointed

#: Column, WARC header.  Values pass through unchanged; ``page_id`` is a number.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to_id": "WARC-Refers-To", "page_id": "X-Page-ID", "refers_to": "X-Refers-To-Page-ID",
}
SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to_id string, "
    "page_id long, refers_to long, payload_bytes long, payload binary"
)
_NUMBERS = ("page_id", "refers_to")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH_BYTES = 8 << 20


def _member(record: bytes) -> bytes:
    """One gzip member whose extra field ``sl`` gives its own length and the record's."""
    z = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    head = 10 + 2 + 12
    total = head + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return (
        b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", 12) + extra + body
        + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    )


def _clean(value: str) -> str:
    """Header values hold no line ends: CR, LF and NUL are percent-encoded."""
    return value.replace("\r", "%0D").replace("\n", "%0A").replace("\0", "%00")


def record(row: dict) -> bytes:
    """A whole record: WARC headers, then an HTTP head and, for a response, the payload."""
    payload = row.get("payload")
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http + (payload or b"") if row["record_type"] == "response" else http
    lines = ["WARC/1.1"]
    lines += [f"{h}: {_clean(str(row[c]))}" for c, h in HEADERS.items() if row.get(c) is not None]
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class _Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    """Tasks write under ``_temporary``, a folder for each attempt; the commit moves their files."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.max_file_bytes = int(options.get("max_file_bytes", 256 << 20))
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        where, top = _open(self.path)
        task = TaskContext.get()
        base = f"{top}/_temporary/{self.job}/{task.partitionId()}-{task.taskAttemptId()}"
        done = _Written()
        out, size = None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                member = _member(record(row))
                if out is not None and size + len(member) > self.max_file_bytes:
                    out.close()
                    out = None
                if out is None:
                    name = f"part-{task.partitionId():06d}-{len(done.files):04d}-{self.job}.warc.gz"
                    where.create_dir(base, recursive=True)
                    out, size = where.open_output_stream(f"{base}/{name}", compression=None), 0
                    done.files.append(f"{base}/{name}")
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
        return done

    def commit(self, messages: Sequence[WriterCommitMessage | None]) -> None:
        where, top = _open(self.path)
        where.create_dir(top, recursive=True)
        for m in messages:
            for f in m.files if m else []:
                where.move(f, f"{top}/{f.rsplit('/', 1)[1]}")
        self._drop(where, top)

    def abort(self, messages: Sequence[WriterCommitMessage | None]) -> None:
        self._drop(*_open(self.path))

    def _drop(self, where: fs.FileSystem, top: str) -> None:
        temporary = f"{top}/_temporary/{self.job}"
        if where.get_file_info(temporary).type == fs.FileType.Directory:
            where.delete_dir(temporary)


@dataclass
class _Archive(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        """Take equality and IN on header columns; others stay with Spark."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, EqualNullSafe, In)) and len(f.attribute) == 1 else None
            if column not in HEADERS or (isinstance(f, EqualNullSafe) and f.value is None):
                yield f
                continue
            values = set(f.value) if isinstance(f, In) else {f.value}
            self.wanted[column] = self.wanted[column] & values if column in self.wanted else values

    def partitions(self) -> Sequence[InputPartition]:
        where, top = _open(self.path)
        found = where.get_file_info(fs.FileSelector(top, recursive=False, allow_not_found=True))
        return [_Archive(f.path) for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and f.base_name.endswith(".warc.gz")] or [_Archive("")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema()
        rows, size = [], 0
        if partition.path:
            where, _ = _open(self.path)
            with where.open_input_file(partition.path) as f:
                for row in records(f, self.wanted, self.with_payload):
                    rows.append(row)
                    size += 200 + len(row["payload"] or b"")
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in SCHEMA.split(", "))])


def _parse_head(head: bytes) -> dict:
    by_name = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        by_name[name.strip().lower()] = value.strip()
    row = {c: by_name.get(h.lower()) for c, h in HEADERS.items()}
    for c in _NUMBERS:
        row[c] = int(row[c]) if row[c] is not None else None
    return row


def records(f, wanted: dict[str, set], with_payload: bool) -> Iterator[dict]:
    """Records of an archive whose headers hold the wanted values, in file order."""
    at, end = 0, f.size()
    while at < end:
        f.seek(at)
        start = f.read(4096)
        length = None
        if start[:4] == b"\x1f\x8b\x08\x04" and start[12:14] == b"sl":
            length = struct.unpack_from("<I", start, 16)[0]
        z = zlib.decompressobj(31)
        raw = z.decompress(start)
        got = len(start)
        while raw.count(b"\r\n\r\n") < 2 and not z.eof:  # the WARC head and the HTTP head
            more = f.read(4096)
            if not more:
                raise ValueError(f"archive ends inside the record at byte {at}")
            got += len(more)
            raw += z.decompress(more)
        head, _, block = raw.partition(b"\r\n\r\n")
        row = _parse_head(head)
        keep = all(row[c] in values for c, values in wanted.items())
        need_body = keep and with_payload and row["record_type"] == "response"
        if need_body or length is None:
            parts = [block]
            while not z.eof:
                more = f.read(1 << 20 if length is None else max(length - got, 4096))
                if not more:
                    raise ValueError(f"archive ends inside the record at byte {at}")
                got += len(more)
                parts.append(z.decompress(more))
            block = b"".join(parts)
            at += got - len(z.unused_data)
        else:
            at += length
        if keep:
            http, _, body = block.partition(b"\r\n\r\n")
            stated = [ln for ln in http.decode("latin-1").split("\r\n") if ln.lower().startswith("content-length:")]
            row["payload_bytes"] = int(stated[0].split(":")[1]) if stated else None
            row["payload"] = body[:-4] if with_payload and row["record_type"] == "response" else None
            yield row


class WarcSource(DataSource):
    """``format("warc")``: option ``path``; reading: ``payload`` (true) to decode payloads; writing:
    ``max_file_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 1000) -> DataFrame:
    """A record per row, in the source's schema.

    Of rows with one payload of at least ``min_bytes`` that with the largest id is a response and the
    others revisit it; rows that share the largest id are all responses.  A null id is smaller than any;
    rows without ids do not revisit one another.  Null html: an empty payload.

    Payloads are compared by digest over narrow rows; the html itself moves at most once, by page."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("target_uri"), html.alias("payload")
    ).withColumn("digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    narrow = rows.where(F.col("payload_bytes") >= min_bytes).select("digest", "page_id")
    heads = checkpointed(
        narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL").drop("n")
    )
    revisits = narrow.join(heads, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()
    v, r = checkpointed(revisits).alias("v"), rows.alias("r")
    joined = r.join(v, F.col("r.page_id").eqNullSafe(F.col("v.page_id")) & (F.col("r.digest") == F.col("v.digest")), "left")
    old = F.col("v.digest").isNotNull()
    urn = lambda page: F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"), F.col("r.digest"), F.lit(">"))
    return joined.select(
        F.when(old, "revisit").otherwise("response").alias("record_type"), urn(F.col("r.page_id")).alias("record_id"),
        "r.target_uri", F.lit("2024-01-01T00:00:00Z").alias("date"), F.concat(F.lit("sha1:"), "r.digest").alias("payload_digest"),
        F.when(old, urn(F.col("v.refers_to"))).alias("refers_to_id"), "r.page_id", "v.refers_to", "r.payload_bytes",
        F.when(~old, F.col("r.payload")).alias("payload"),
    )


def write(records_: DataFrame, path: str, max_file_bytes: int = 256 << 20) -> None:
    register(records_.sparkSession)
    records_.write.format("warc").mode("append").option("max_file_bytes", max_file_bytes).save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri`` of every record.
    Responses are measured on the decoded payload; revisits, whose payload is not decoded, state both."""
    full = read(spark, path).where("record_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"), "target_uri",
    )
    heads = read(spark, path, payload=False).where("record_type = 'revisit'").select(
        "page_id", "payload_bytes", F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type", "refers_to", "target_uri",
    )
    return full.unionByName(heads)
