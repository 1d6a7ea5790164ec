"""WARC archives as a Spark data source, and the archiving of pages.

Reading plans a partition for each stretch of an archive, takes predicates on
record type and other headers down to the reader, parses a record's headers
first and steps over payloads that are not wanted: where a gzip member states
its own length (the `sl` extra field of the WARC annex, which the writer sets)
the stretch is not even inflated. Writing is by task, into files of bounded
size; only files named in the manifest of a finished write are read, so a task
that was repeated or lost leaves nothing behind that counts.

Defined cases: a null payload is empty; a null target, date, digest or
reference has no header and is read as null; line breaks in header values are
percent-coded; a malformed record ends with an error that names file and place;
an empty table gives an archive without records; further columns are ignored.
"""

from __future__ import annotations

import json
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from userlake.sources.scratch import scratch_folder

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, payload_length bigint, payload binary"
)
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
BRACKETED = {"record_id", "refers_to"}
MANIFEST = "manifest.json"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILE_BYTES = 256 << 20  # a file is closed beyond this
SPLIT_BYTES = 16 << 20  # a partition of a file ends beyond this
READ_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
GZIP_LEVEL = 1

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


# -- records as bytes ---------------------------------------------------------------


def _safe(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record_bytes(record: dict) -> bytes:
    """A WARC/1.1 record; the payload is the body of an HTTP response, which a revisit leaves out."""
    payload = record["payload"] or b""
    length = len(payload) if record["payload_length"] is None else record["payload_length"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if record["record_type"] == "revisit" else http + payload
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        value = record[column]
        if value is not None:
            value = _safe(value)
            lines.append(f"{header}: {f'<{value}>' if column in BRACKETED else value}")
    if record["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member that states its own length before and after compression."""
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    stated = size < 1 << 32 and len(data) < 1 << 32
    extra = b"sl" + struct.pack("<HII", 8, size, len(data)) if stated else b""
    head = b"\x1f\x8b\x08" + (b"\x04" if stated else b"\x00") + b"\0\0\0\0\0\xff"
    return (
        head + (struct.pack("<H", len(extra)) + extra if stated else b"") + body
        + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    )


class _Stream:
    """Bytes of a file from a place on, inflated where they are gzip members."""

    def __init__(self, file, start: int):
        self.file, self.at, self.raw = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        chunk = self.file.read(READ_BYTES)
        self.raw += chunk
        return bool(chunk)

    def need(self, count: int) -> bool:
        while len(self.raw) < count:
            if not self.more():
                return False
        return True

    def step(self, count: int) -> None:
        """Leave `count` bytes behind, unread where possible."""
        self.at += count
        if count < len(self.raw):
            self.raw = self.raw[count:]
        else:
            self.raw = b""
            self.file.seek(self.at)


class Record:
    """One record; `headers` are parsed at once, the block only when asked for."""

    def __init__(self, stream: _Stream):
        self.stream, self.start = stream, stream.at
        stream.need(18 + 12)
        self.packed = stream.raw[:2] == b"\x1f\x8b"
        self.member_bytes = None
        self.unpacker, self.plain = None, b""
        if self.packed:
            if stream.raw[3] & 4 and stream.raw[12:14] == b"sl":
                self.member_bytes = struct.unpack("<I", stream.raw[16:20])[0]
            self.unpacker = zlib.decompressobj(31)
        self._place = 0
        while b"\r\n\r\n" not in self.plain:
            if not self._grow(4096):
                raise ValueError("the headers of a record do not end")
        head, self.plain = self.plain.split(b"\r\n\r\n", 1)
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        self.headers: dict[str, str] = {}
        for line in lines[1:]:
            if line[:1] in " \t" and self.headers:  # a folded line
                self.headers[last] += " " + line.strip()
            else:
                name, _, value = line.partition(":")
                last = name.strip().lower()
                self.headers[last] = value.strip()
        self.block_bytes = int(self.headers["content-length"])

    def _grow(self, least: int) -> bool:
        """Inflate or read about `least` further bytes."""
        stream, size = self.stream, len(self.plain)
        while len(self.plain) == size:
            if self.unpacker is not None and self.unpacker.eof:
                return False
            data = self.unpacker.unconsumed_tail if self.packed and self.unpacker.unconsumed_tail else stream.raw[self._place :]
            if not data:
                if not stream.more():
                    return False
                continue
            if self.packed:
                self.plain += self.unpacker.decompress(data, least)
                self._place = len(stream.raw) - len(self.unpacker.unconsumed_tail or self.unpacker.unused_data)
            else:
                self.plain += data[:least]
                self._place += len(data[:least])
        return True

    def block(self) -> bytes:
        while len(self.plain) < self.block_bytes:
            if not self._grow(max(4096, self.block_bytes - len(self.plain))):
                raise ValueError("a record ends before its stated length")
        return self.plain[: self.block_bytes]

    def leave(self) -> None:
        """Move the stream behind this record."""
        stream = self.stream
        if self.member_bytes is not None:
            stream.step(self.member_bytes)
        elif self.packed:
            while not self.unpacker.eof:
                self.plain = b""
                if not self._grow(READ_BYTES) and not self.unpacker.eof:
                    raise ValueError("a gzip member does not end")
            stream.step(self._place)
        else:
            consumed = self._place - len(self.plain)
            stream.step(consumed + self.block_bytes + 4)


def split_http(headers: dict[str, str], block: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of the HTTP message in a block; other blocks are all body."""
    if not headers.get("content-type", "").startswith("application/http"):
        return {}, block
    head, _, body = block.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}, body


def header_values(record: Record) -> dict[str, str | None]:
    values = {}
    for column, header in HEADERS.items():
        value = record.headers.get(header.lower())
        values[column] = value.strip("<>") if value and column in BRACKETED else value
    return values


# -- the data source ------------------------------------------------------------------


@dataclass
class Stretch(InputPartition):
    """Records that start in [start, end) of a file; no end means all of it."""

    file: str
    start: int
    end: int | None


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("/") else (fs.LocalFileSystem(), path)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, with_payload: bool):
        self.path, self.with_payload = path, with_payload
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality with values on any header column; what is left is Spark's."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) else None
            if column in HEADERS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = values & self.wanted.get(column, values)
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        system, path = _place(self.path)
        if system.get_file_info(path).is_file:
            return [Stretch(self.path, 0, None)]
        manifest = f"{path}/{MANIFEST}"
        if system.get_file_info(manifest).is_file:
            with system.open_input_stream(manifest) as source:
                files = json.loads(source.read())["files"]
            return [
                Stretch(f"{self.path}/{f['name']}", start, end)
                for f in files
                for start, end in zip(f["splits"], [*f["splits"][1:], None])
            ]
        found = system.get_file_info(fs.FileSelector(path))
        names = sorted(i.base_name for i in found if i.base_name.endswith((".warc", ".warc.gz")))
        return [Stretch(f"{self.path}/{name}", 0, None) for name in names]

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an archive without files
            return
        system, path = _place(partition.file)
        schema = pa.schema(
            [(c, pa.string()) for c in HEADERS] + [("payload_length", pa.int64()), ("payload", pa.binary())]
        )
        rows, size = [], 0
        with system.open_input_file(path) as file:
            stream = _Stream(file, partition.start)
            while (partition.end is None or stream.at < partition.end) and stream.need(1):
                try:
                    record = Record(stream)
                    row = header_values(record)
                    if all(row[c] in values for c, values in self.wanted.items()):
                        row["payload_length"], row["payload"] = None, None
                        if self.with_payload:
                            http, body = split_http(record.headers, record.block())
                            if record.headers.get("warc-type") == "revisit":
                                row["payload_length"] = int(http["content-length"]) if "content-length" in http else None
                            else:
                                row["payload_length"], row["payload"] = len(body), body
                                size += len(body)
                        rows.append(row)
                    record.leave()
                except (ValueError, KeyError, zlib.error) as error:
                    raise ValueError(f"{partition.file} at byte {stream.at}: {error}") from error
                if size >= BATCH_BYTES or len(rows) >= 1000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = _place(self.path)
        system.create_dir(folder)
        done, out, size = [], None, 0
        for batch in iterator:
            for record in batch.to_pylist():
                if out is None:
                    done.append({"name": f"{uuid.uuid4().hex}.warc.gz", "splits": [0]})
                    out, size = system.open_output_stream(f"{folder}/{done[-1]['name']}", compression=None), 0
                if size - done[-1]["splits"][-1] >= SPLIT_BYTES:
                    done[-1]["splits"].append(size)
                member = gzip_member(record_bytes(record))
                out.write(member)
                size += len(member)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = _place(self.path)
        system.create_dir(folder)
        files = [f for m in messages if m is not None for f in m.files]
        with system.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps({"files": files}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = _place(self.path)
        for f in (f for m in messages if m is not None for f in m.files):
            system.delete_file(f"{folder}/{f['name']}")


class WarcDataSource(DataSource):
    """`format("warc")`; the option `payload` set to false reads headers only."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"].rstrip("/"), self.options.get("payload", "true").lower() != "false")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"].rstrip("/"))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let it take predicates."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the planner's worker has a path of its own
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_archive(records: DataFrame, path: str) -> None:
    """Write rows of the format's columns as a new archive folder."""
    register(records.sparkSession)
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    records.select(*columns).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


# -- pages ---------------------------------------------------------------------------

# Payloads that are equal are dealt over this many tasks.
SALTS = 32
PAGE = "urn:page:"


def base32_of_hex(digits: Column) -> Column:
    """RFC 4648 of 40 hexadecimal digits: each five of them are four letters."""

    def letters(group: Column) -> Column:
        number = F.conv(F.substr(digits, group * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[
            F.substr(F.lit(BASE32), F.pmod(F.shiftright(number, 15 - 5 * k), F.lit(32)) + 1, F.lit(1)) for k in range(4)
        ])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def page_records(pages: DataFrame) -> DataFrame:
    """Records of pages: the smallest page_id of equal payloads is the response, the others revisit it.

    Equal payloads are found by SHA-256 and dealt over several tasks by
    page_id. Of repeated rows of the smallest page_id one is the response.
    Rows without page_id are responses unless a page with one has their payload.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    given = pages.select(
        "page_id", "url", payload.alias("html"), F.sha2(payload, 256).alias("key"),
        F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).alias("salt"),
    )
    shared = (
        given.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("key", "first", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    )
    repeats = Window.partitionBy("key", "salt", "page_id").orderBy("url")
    joined = given.join(shared, ["key", "salt"], "left").withColumn("repeat", F.row_number().over(repeats))
    revisit = F.col("first").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") != F.col("first")) | (F.col("repeat") > 1)
    )
    return joined.select(
        F.concat(F.lit(PAGE), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("date"),
        F.concat(F.lit("sha1:"), base32_of_hex(F.sha1("html"))).alias("payload_digest"),
        F.when(revisit, F.concat(F.lit(PAGE), F.col("first").cast("string"))).alias("refers_to"),
        F.octet_length("html").cast("bigint").alias("payload_length"),
        F.when(~revisit, F.col("html").cast("binary")).alias("payload"),
    )


def _page_id(urn: str) -> Column:
    return F.when(F.col(urn) != PAGE, F.substr(F.col(urn), F.lit(len(PAGE) + 1))).cast("bigint")


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write pages to an archive and give its records as read back."""
    spark = pages.sparkSession
    path = path or scratch_folder(spark, "warc")
    write_archive(page_records(pages), path)
    return read_archive(spark, path)


def digests(records: DataFrame) -> DataFrame:
    """page_id, payload length and digest, record type and reference of each record."""
    return records.select(
        _page_id("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), F.col("payload_length")).alias("payload_bytes"),
        F.replace(F.col("payload_digest"), F.lit("sha1:"), F.lit("")).alias("payload_digest"),
        "record_type",
        _page_id("refers_to").alias("refers_to"),
    )
