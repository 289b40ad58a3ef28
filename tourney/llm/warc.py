"""WARC archives: a Python data source that reads and writes them, and payload deduplication.

Reading plans partitions from byte ranges that start and end between records, parses the headers of
each record first, tests the pushed-down predicates on them, and seeks over the blocks of records
that fail. Payloads are only read when the ``payload`` option asks for them.

Writing appends records to files of bounded size; the driver lists the files of the successful tasks
in a manifest when the job commits, so files of lost or repeated tasks are never read.

    register(spark)
    records.write.format("warc").mode("append").save(path)
    spark.read.format("warc").option("payload", "false").load(path).where("warc_type = 'revisit'")
"""

from __future__ import annotations

import io
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tourney.llm.scratch import materialise


FILE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
BATCH_ROWS = 500
BATCH_BYTES = 8 << 20
READ_BYTES = 1 << 16
MANIFEST = "_manifest-"

# Columns that hold a header of the record, and the header's name.
HEADERS = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
READ_SCHEMA = (
    ", ".join(f"{name} string" for name in HEADERS)
    + ", content_length bigint, payload_bytes bigint, payload binary"
)
WRITE_COLUMNS = ("record_id", "warc_type", "target_uri", "date", "payload_digest", "refers_to")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"


def _file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def _header_value(value: str) -> str:
    """Control characters would end a header line, so they are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def record_bytes(row: dict) -> bytes:
    """One record; a revisit keeps the HTTP headers, with the payload's length, but no payload."""
    payload = row["payload"] or b""
    revisit = row["warc_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1"]
    for name in WRITE_COLUMNS:
        if row.get(name) is not None:
            lines.append(f"{HEADERS[name]}: {_header_value(row[name])}")
    if revisit:
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += [f"Content-Type: {HTTP}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: name, and the ends of their ranges."""

    files: list[tuple[str, list[int]]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = _file_system(self.path)
        system.create_dir(folder, recursive=True)
        files: list[tuple[str, list[int]]] = []
        out, at, ends = None, 0, []
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append((f"part-{uuid.uuid4().hex}.warc", ends := []))
                    out, at = system.open_output_stream(f"{folder}/{files[-1][0]}"), 0
                data = record_bytes(row)
                out.write(data)
                at += len(data)
                if at - (ends[-1] if ends else 0) >= RANGE_BYTES:
                    ends.append(at)
                if at >= FILE_BYTES:
                    if ends[-1:] != [at]:
                        ends.append(at)
                    out.close()
                    out = None
        if out is not None:
            if ends[-1:] != [at]:
                ends.append(at)
            out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        system, folder = _file_system(self.path)
        system.create_dir(folder, recursive=True)
        older = [f.path for f in system.get_file_info(pa.fs.FileSelector(folder)) if f.is_file]
        files = [f for m in messages if m is not None for f in m.files]
        with system.open_output_stream(f"{folder}/{MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())
        if self.overwrite:
            new = {name for name, _ in files}
            for path in older:
                if path.rsplit("/", 1)[-1] not in new:
                    system.delete_file(path)

    def abort(self, messages: list) -> None:
        """Nothing lists the files of a failed job; what is left of them is never read."""


@dataclass
class Range(InputPartition):
    file: str
    start: int
    end: int | None


class _Records:
    """Buffered reading of one range of an archive."""

    def __init__(self, source, start: int, end: int | None) -> None:
        self.source, self.end, self.buffer, self.at = source, end, b"", start
        source.seek(start)

    def _fill(self) -> bool:
        more = self.source.read(READ_BYTES)
        self.buffer += more
        return bool(more)

    def until(self, mark: bytes, limit: int | None = None) -> bytes | None:
        """Bytes up to and with ``mark``; None if it does not come within ``limit`` or the file."""
        start = 0
        while (found := self.buffer.find(mark, start)) < 0:
            if limit is not None and len(self.buffer) >= limit:
                return None
            start = max(0, len(self.buffer) - len(mark) + 1)
            if not self._fill():
                return None
        found += len(mark)
        if limit is not None and found > limit:
            return None
        return self.take(found)

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._fill():
            pass
        taken, self.buffer = self.buffer[:n], self.buffer[n:]
        self.at += len(taken)
        return taken

    def skip(self, n: int) -> None:
        if n <= len(self.buffer):
            self.take(n)
        else:
            self.at += n
            self.buffer = b""
            self.source.seek(self.at)

    def header(self) -> dict[str, str] | None:
        """Headers of the next record by lower-case name; None at the end of the range."""
        text = b""
        while not text.strip():  # the blank lines that end a record still belong to its range
            if self.end is not None and self.at >= self.end:
                return None
            text = self.until(b"\r\n\r\n")
            if text is None:
                return None
        lines = text.decode("utf-8", "replace").strip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {self.at - len(text)}")
        pairs = (line.partition(":") for line in lines[1:])
        return {name.strip().lower(): value.strip() for name, _, value in pairs}


_TESTS = {
    EqualTo: lambda value, f: value is not None and value == f.value,
    EqualNullSafe: lambda value, f: value == f.value,
    In: lambda value, f: value is not None and value in f.value,
    IsNull: lambda value, f: value is None,
    IsNotNull: lambda value, f: value is not None,
    StringStartsWith: lambda value, f: value is not None and value.startswith(f.value),
    StringEndsWith: lambda value, f: value is not None and value.endswith(f.value),
    StringContains: lambda value, f: value is not None and f.value in value,
}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool) -> None:
        self.path, self.payload = path, payload
        self.tests: list[tuple[str, Filter]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if type(f) in _TESTS and column in HEADERS:
                self.tests.append((column, f))
            else:
                yield f

    def partitions(self) -> list[Range]:
        """Ranges of the committed files; archives of other origin are one range per file."""
        system, folder = _file_system(self.path)
        info = system.get_file_info(pa.fs.FileSelector(folder, recursive=True))
        names = [f.path for f in info if f.is_file]
        manifests = [n for n in names if n.rsplit("/", 1)[-1].startswith(MANIFEST)]
        ranges = []
        for manifest in sorted(manifests):
            with system.open_input_stream(manifest) as source:
                listed = json.loads(source.read())
            for name, ends in listed:
                file = f"{manifest.rsplit('/', 1)[0]}/{name}"
                ranges += [Range(file, a, b) for a, b in zip([0, *ends], ends, strict=False)]
        if not manifests:
            found = (n for n in sorted(names) if n.endswith((".warc", ".warc.gz")))
            ranges = [Range(name, 0, None) for name in found]
        return ranges or [Range("", 0, 0)]

    def _passes(self, header: dict[str, str]) -> bool:
        return all(
            _TESTS[type(f)](header.get(HEADERS[column].lower()), f) for column, f in self.tests
        )

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        system, _ = _file_system(self.path)
        packed = partition.file.endswith(".gz")
        opened = (
            io.BytesIO(system.open_input_stream(partition.file).read())
            if packed
            else system.open_input_file(partition.file)
        )
        with opened as source:
            records = _Records(source, partition.start, partition.end)
            rows, held = [], 0
            while (header := records.header()) is not None:
                length = int(header.get("content-length", 0))
                if not self._passes(header):
                    records.skip(length)
                    continue
                row = {column: header.get(name.lower()) for column, name in HEADERS.items()}
                row["content_length"] = length
                self._read_block(records, length, row)
                rows.append(row)
                held += len(row["payload"] or b"")
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    def _read_block(self, records: _Records, length: int, row: dict) -> None:
        row["payload"], left, own = None, length, length
        if (row["content_type"] or "").startswith("application/http"):
            http = records.until(b"\r\n\r\n", min(length, READ_BYTES))
            if http is not None:
                left = length - len(http)
                found = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
                own = left if row["warc_type"] != "revisit" or not found else int(found[1])
        row["payload_bytes"] = own
        if self.payload and row["warc_type"] != "revisit":
            row["payload"] = records.take(left)
        else:
            records.skip(left)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema(
        [(name, pa.string()) for name in HEADERS]
        + [("content_length", pa.int64()), ("payload_bytes", pa.int64())]
        + [("payload", pa.binary())]
    )
    return pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    """``path``: folder or URI of the archives; ``payload``: whether payloads are read."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let Spark hand it predicates."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, four letters for every five hex digits."""
    digits, letters = F.sha1(payload), F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = [F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 10).cast("int") for i in range(8)]
    return F.concat(
        *[
            F.substring(letters, F.shiftright(group, shift).bitwiseAND(31) + 1, F.lit(1))
            for group in groups
            for shift in (15, 10, 5, 0)
        ]
    )


def archive_records(
    pages: DataFrame, key: str = "page_id", uri: str = "url", text: str = "html", least: int = 0
) -> DataFrame:
    """A record per row of ``pages``, equal payloads of at least ``least`` bytes kept once.

    The row with the largest key is the response, the others revisit it; rows that share even the
    key are all responses. A null text is an empty payload. A null key has the record id
    ``urn:page:`` and is a response only if no row with a key has its payload.

    Payload groups are aggregated before the shuffle, and only groups of several rows are stored and
    joined. While that table is small, Spark broadcasts it and the payloads stay where they are;
    beyond, the join shuffles, and a payload that very many rows share is split.
    """
    payload = F.coalesce(F.encode(F.col(text).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(
        F.col(key).cast("bigint").alias("page"), F.col(uri).alias("target_uri"),
        payload.alias("payload"),
    ).withColumn("digest", base32_sha1(F.col("payload")))
    copied = (
        rows.where(F.length("payload") >= least)
        .groupBy(F.col("digest").alias("same"))
        .agg(F.max("page").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    copied = materialise(copied.select("same", "first"), "copied-payloads")
    joined = rows.join(copied, (F.col("digest") == F.col("same")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    revisit &= F.length("payload") >= least
    return joined.select(
        record_id("page").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        "target_uri",
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.when(revisit, record_id("first")).alias("refers_to"),
        "payload",
    )


def record_id(key: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(">"))


def page_of(record: str) -> Column:
    return F.regexp_extract(record, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of an archive that ``archive_records`` describes, digests taken of what was read."""
    records = spark.read.format("warc").load(path)
    written = F.regexp_replace("payload_digest", "^sha1:", "")
    return records.select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        F.when(F.col("payload").isNull(), written)
        .otherwise(base32_sha1(F.col("payload")))
        .alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        page_of("refers_to").alias("refers_to"),
    )
