"""WARC archives as a Spark data source.

``spark.read.format("warc").load(folder)`` plans partitions of whole files, packed up to
``BYTES_PER_PARTITION``. Predicates on the record type and on the columns that come from headers
are pushed down: a record's headers are parsed first, and the payload of a record that fails a
predicate is skipped, by its length in plain files and by the length in the gzip extra field
(``sl``) in compressed ones, so it is neither read nor inflated. Use :func:`read_warc`. With option ``payload`` false no
payload is read at all. Pushdown needs ``spark.sql.python.filterPushdown.enabled``, which
:func:`register` sets.

``df.write.format("warc").save(folder)`` writes rows of ``PAGE`` (an id, a target, a payload, and
the id of an earlier record with the same payload, or null): a null one becomes a response record
with its payload, any other a revisit record without. Files get their final name when all tasks are
done; what a lost task leaves behind has a hidden name.

Defined results: a null payload is an empty one; a null target is left out; line ends and other
control characters in headers are percent-encoded; payloads of any length are kept whole, one at a
time in memory; repeated ids make repeated records; an empty table writes no file, and an empty or
missing folder has no records; a truncated record ends its file with an error. Other columns are
left alone.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from corpusmill import staging, storage
from corpusmill.llm import skew

BYTES_PER_PARTITION = 128 << 20
BATCH_BYTES = 8 << 20
PREFIX = "urn:record:"
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "date": "WARC-Date",
    "content_type": "Content-Type",
}
RECORD = (
    "record_type string, record_id string, target string, refers_to string, payload_digest string, date string, "
    "content_type string, content_length bigint, http_length bigint, payload binary"
)
PAGE = "id string, target string, payload binary, same_as string"
DATE = "1970-01-01T00:00:00Z"  # fixed, so that a repeated task writes the same bytes
PLAIN_END = b"\r\n\r\n"


def encoded(value: str) -> str:
    """A header value without control characters."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(id: str, target: str | None, payload: bytes, same_as: str | None) -> tuple[bytes, bytes]:
    """Header block and content block of a response or a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if same_as is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if same_as is None else 'revisit'}",
        f"WARC-Record-ID: <{PREFIX}{encoded(id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if target is not None:
        lines.append(f"WARC-Target-URI: {encoded(target)}")
    if same_as is not None:
        lines.append(f"WARC-Refers-To: <{PREFIX}{encoded(same_as)}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), block


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member whose extra field ``sl`` tells its own and its content's length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class Plain:
    """Reads the next bytes of an uncompressed archive, or jumps over them."""

    def __init__(self, file) -> None:
        self.file, self.held = file, b""

    def line(self) -> bytes:
        """Up to and including the next line end; empty at the end of the file."""
        while b"\n" not in self.held:
            more = self.file.read(1 << 16)
            if not more:
                break
            self.held += more
        at = self.held.find(b"\n") + 1 or len(self.held)
        line, self.held = self.held[:at], self.held[at:]
        return line

    def take(self, size: int) -> bytes:
        parts = [self.held[:size]]
        self.held = self.held[size:]
        left = size - len(parts[0])
        while left:
            more = self.file.read(min(left, 1 << 20))
            if not more:
                raise EOFError("truncated record")
            parts.append(more)
            left -= len(more)
        return b"".join(parts)

    def skip(self, size: int) -> None:
        left = size - len(self.held)
        self.held = self.held[size:]
        if left > 0:
            if self.file.tell() + left > self.file.size():
                raise EOFError("truncated record")
            self.file.seek(self.file.tell() + left)

    def end_record(self) -> None:
        pass


class Packed:
    """The same for a file of gzip members; the rest of a member is skipped by its stated length."""

    def __init__(self, file) -> None:
        self.file, self.start, self.member = file, 0, None

    def _open(self) -> bool:
        self.file.seek(self.start)
        head = self.file.read(12)
        if not head:
            return False
        if head[:2] != b"\x1f\x8b":
            raise ValueError("not a gzip member")
        self.stated = None
        if head[3] & 4:
            extra = self.file.read(struct.unpack("<H", head[10:12])[0])
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    self.stated = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size :]
        self.file.seek(self.start)
        self.unpacker, self.unpacked, self.spare = zlib.decompressobj(31), b"", b""
        self.member = True
        return True

    def _more(self) -> bool:
        if self.unpacker.eof:
            return False
        raw = self.unpacker.unconsumed_tail or self.file.read(1 << 14)
        if not raw:
            raise EOFError("truncated record")
        self.unpacked += self.unpacker.decompress(raw, 1 << 18)
        return True

    def line(self) -> bytes:
        if self.member is None and not self._open():
            return b""
        while b"\n" not in self.unpacked and self._more():
            pass
        at = self.unpacked.find(b"\n") + 1 or len(self.unpacked)
        line, self.unpacked = self.unpacked[:at], self.unpacked[at:]
        return line

    def take(self, size: int) -> bytes:
        parts, left = [], size
        while True:
            parts.append(self.unpacked[:left])
            left -= len(parts[-1])
            self.unpacked = self.unpacked[len(parts[-1]) :]
            if not left:
                return b"".join(parts)
            if not self._more():
                raise EOFError("truncated record")

    def skip(self, size: int) -> None:
        if self.stated is None:
            while size:
                size -= len(self.take(min(size, 1 << 20)))

    def end_record(self) -> None:
        """Go on after this member."""
        if self.stated is None:
            self.unpacked = b""
            while self._more():
                self.unpacked = b""
            self.start = self.file.tell() - len(self.unpacker.unused_data)
        else:
            self.start += self.stated
        self.member = None


def headers_of(source: Plain | Packed) -> dict[str, str] | None:
    """The next record's headers by lower-case name, or None at the end of the file."""
    line = source.line()
    while line in (b"\r\n", b"\n"):
        line = source.line()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a record: {line[:40]!r}")
    found: dict[str, str] = {}
    name = ""
    while (line := source.line().rstrip(b"\r\n")) != b"":
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and name:
            found[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def described(headers: dict[str, str]) -> dict[str, object]:
    """The columns that come from headers alone."""
    row: dict[str, object] = {}
    for column, name in HEADERS.items():
        value = headers.get(name.lower())
        row[column] = value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value
    row["content_length"] = int(headers.get("content-length", "0"))
    return row


def passes(row: dict[str, object], filters: list[Filter]) -> bool:
    """Whether a row meets all predicates; null meets none but IsNull."""
    return all(truth(row, f) is True for f in filters)


def truth(row: dict[str, object], f: Filter) -> bool | None:
    if isinstance(f, Not):
        inner = truth(row, f.child)
        return None if inner is None else not inner
    value = row[f.attribute[0]]
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if value is None:
        return None
    if isinstance(f, In):
        return value in f.value or (None if None in f.value else False)
    if f.value is None:
        return None
    return {
        EqualTo: lambda: value == f.value,
        GreaterThan: lambda: value > f.value,
        GreaterThanOrEqual: lambda: value >= f.value,
        LessThan: lambda: value < f.value,
        LessThanOrEqual: lambda: value <= f.value,
        StringStartsWith: lambda: value.startswith(f.value),
        StringEndsWith: lambda: value.endswith(f.value),
        StringContains: lambda: f.value in value,
    }[type(f)]()


#: Ordering of strings is left to Spark, which compares bytes.
_ANY = (EqualTo, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)
_ORDER = (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)


def supported(f: Filter) -> bool:
    """Whether a predicate needs headers only."""
    if isinstance(f, Not):
        return supported(f.child)
    if not isinstance(f, (*_ANY, *_ORDER)) or len(f.attribute) != 1:
        return False
    column = f.attribute[0]
    return column == "content_length" or column in HEADERS and isinstance(f, _ANY)


def records(file, packed: bool, filters: list[Filter], payload: bool) -> Iterator[dict[str, object]]:
    """Records of an open file that meet the predicates."""
    source = Packed(file) if packed else Plain(file)
    while (headers := headers_of(source)) is not None:
        row = described(headers)
        size = row["content_length"]
        if passes(row, filters):
            row["http_length"] = row["payload"] = None
            left = size
            if "msgtype=response" in (row["content_type"] or "") and size:
                status = source.line()
                left -= len(status)
                while left and (line := source.line()).rstrip(b"\r\n"):
                    left -= len(line)
                    name, _, value = line.partition(b":")
                    if name.strip().lower() == b"content-length" and value.strip().isdigit():
                        row["http_length"] = int(value)
                else:
                    left -= len(line) if left else 0
            if payload:
                row["payload"] = source.take(left)
            else:
                source.skip(left)
            yield row
        else:
            source.skip(size)
        source.end_record()


@dataclass
class Files(InputPartition):
    """Files of one partition."""

    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool) -> None:
        self.path, self.payload, self.filters = path, payload, []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if supported(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, inner = storage.Clients().at(self.path)
        found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=True))
        files = sorted(
            (-i.size, i.path) for i in found
            if i.type == fs.FileType.File and not i.base_name.startswith((".", "_")) and re.search(r"\.warc(\.gz)?$", i.base_name)
        )
        groups: list[list[str]] = []
        room = 0
        for size, path in files:  # large first, so that only small ones share a partition
            if not groups or room < -size:
                groups.append([])
                room = BYTES_PER_PARTITION
            groups[-1].append(path)
            room += size
        return [Files(tuple(g)) for g in groups] or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = storage.Clients().at(self.path)
        held: list[dict] = []
        size = 0
        for path in partition.paths:
            with system.open_input_file(path) as file:
                for row in records(file, path.endswith(".gz"), self.filters, self.payload):
                    held.append(row)
                    size += 200 + len(row["payload"] or b"")
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=ARROW_RECORD)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=ARROW_RECORD)


ARROW_RECORD = pa.schema(
    [(c, pa.string()) for c in HEADERS]
    + [("content_length", pa.int64()), ("http_length", pa.int64()), ("payload", pa.binary())]
)


@dataclass
class Written(WriterCommitMessage):
    """The hidden name of a task's file, or None if it had no rows."""

    temporary: str | None


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, packed: bool) -> None:
        self.path, self.packed = path, packed

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, inner = storage.Clients().at(self.path)
        out, name = None, f"{inner}/.{uuid.uuid4().hex}.tmp"
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system.create_dir(inner, recursive=True)
                    out = system.open_output_stream(name)
                head, block = record(row["id"] or "", row["target"], row["payload"] or b"", row["same_as"])
                whole = head + block + PLAIN_END
                out.write(gzip_member(whole) if self.packed else whole)
        if out is None:
            return Written(None)
        out.close()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        system, inner = storage.Clients().at(self.path)
        for number, message in enumerate(messages):
            if message is not None and message.temporary is not None:
                system.move(message.temporary, f"{inner}/part-{number:05d}.warc{'.gz' if self.packed else ''}")

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = storage.Clients().at(self.path)
        for message in messages:
            if message is not None and message.temporary is not None:
                system.delete_file(message.temporary)


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` (true: read payloads); ``gzip`` (true: write compressed)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD

    def _option(self, name: str) -> bool:
        return self.options.get(name, "true").lower() == "true"

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self._option("payload"))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("warc folders are only written anew: use mode append and a new folder")
        return WarcWriter(self.options["path"], self._option("gzip"))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives below ``path``.

    Spark keeps the predicates pushed last with a loaded frame and would use them for a later query
    without any; the predicate here, which every record meets, makes each query push its own.
    """
    register(spark)
    loaded = spark.read.format("warc").option("payload", str(payload).lower()).load(storage.qualified(spark, path))
    return loaded.where("content_length >= 0")


def write_warc(
    df: DataFrame, path: str, id: str = "page_id", target: str = "url", payload: str = "html", packed: bool = True
) -> None:
    """One record per row: of rows with equal payloads the one with the smallest id is a response,
    rows with larger ids revisit it. Payloads are told apart by their SHA-1, as WARC's revisits are:
    two different payloads made to have one SHA-1 would be taken for one."""
    spark = df.sparkSession
    register(spark)
    raw = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.unhex(F.lit("")))
    rows = df.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{target}`").cast("string").alias("target"), raw.alias("payload"),
        F.sha1(raw).alias("digest"),
    )
    slim = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    facts = staging.stage(slim.where("n > 1"), "warc-digests")
    total = facts.agg(F.sum("n")).first()[0] or 0
    same_as = F.when(F.col("id") > F.col("first"), F.col("first").cast("string"))
    joined = skew.attach(rows, facts, "digest", total)
    named = joined.select(F.col("id").cast("string").alias("id"), "target", "payload", same_as.alias("same_as"))
    writer = named.write.format("warc").mode("append").option("gzip", str(packed).lower())
    writer.save(storage.qualified(spark, path))


def page_records(records: DataFrame) -> DataFrame:
    """``id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` of the
    records that :func:`write_warc` wrote; ids as text."""
    number = lambda c: F.regexp_extract(c, f"^{PREFIX}(.*)$", 1)
    size = F.octet_length("payload").cast("long")
    payload_bytes = F.when(F.col("record_type") == "response", size).otherwise(F.col("http_length"))
    return records.select(
        number("record_id").alias("id"),
        payload_bytes.alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type",
        F.when(F.col("refers_to").isNotNull(), number("refers_to")).alias("refers_to"),
    )
