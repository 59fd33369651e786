"""WARC archives as a Python data source, and pages written with revisit records.

``spark.read.format("warc").load(path)`` plans whole files as partitions, small ones
together.  A task reads the header of a record first.  Filters on header columns,
record type included, are pushed down to it (``spark.sql.python.filterPushdown.enabled``),
and what they refuse is skipped unread: in a plain file by the record's length, in a
compressed one by the length that the member's own header names.  Members without
that length, as other writers make them, are inflated to find their end.  Payloads are read
only for records that are returned, and only if the schema asks for ``payload``.

``df.write.format("warc").save(path)`` writes one gzip member per record.  Files have
names of their own; a list of those that count is written when all tasks have ended.
The repeated or lost attempts of a task leave files that no list names.  A folder without
lists is read whole.  Files are reached by pyarrow's file systems: the folder has to
be one that all executors share.

``revisit_records`` makes records of pages: of equal payloads the one with the
largest page_id is a response, the others are revisits of it.

A null html is an empty payload; empty payloads are equal ones.  A null page_id comes
before all numbers, and of repeated rows one is the response.  A null url leaves the header
out; line breaks and blanks in urls are percent-encoded.  Payloads have any length; an
empty table gives an archive without records and an empty result.  Only page_id, url and
html are read; further columns, whatever their names, are not.  A damaged record stops
the read with its file and place.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from hashlib import sha1
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, datasource as ds, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gridloom import session
from gridloom.llm.common import Scratch, keyed, table
from gridloom.operators.joins import lookup_join

SCHEMA = (
    "record_type string, record_id string, target_uri string, warc_date string, content_type string,"
    " content_length long, payload_digest string, payload_bytes long, refers_to string,"
    " headers map<string,string>, payload binary"
)

# WARC header names of the columns, and the profile of a revisit.
NAMES = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http"

#: Bytes of files that one partition reads, and of one written file.
PARTITION_BYTES = 128 << 20
FILE_BYTES = 1 << 30
LEVEL = 4
BATCH_BYTES = 8 << 20
STEP = 1 << 12

_END = b"\r\n\r\n"
#: Gzip's fixed header with an extra field, whose part "SL" holds the lengths
#: of the member and of the record.
_GZIP = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


# --- records -----------------------------------------------------------------


def encode_record(record: dict[str, Any], now: str) -> bytes:
    """One record; the payload of a response follows an HTTP header, that of a revisit is left out."""
    kind, payload = record["record_type"], record.get("payload")
    size, digest = record.get("payload_bytes"), record.get("payload_digest")
    if payload is not None:
        size, digest = len(payload), digest or b32encode(sha1(payload).digest()).decode()
    body, content_type = payload or b"", record.get("content_type") or "application/octet-stream"
    if kind in ("response", "revisit"):
        head = f"HTTP/1.1 200 OK\r\nContent-Type: {_line(content_type)}\r\nContent-Length: {size or 0}\r\n\r\n"
        body = head.encode() + (b"" if kind == "revisit" else body)
        content_type = f"{HTTP}; msgtype=response"
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", record.get("warc_date") or now),
        ("WARC-Target-URI", record.get("target_uri") and re.sub(r"[\x00-\x20\x7f]", _percent, record["target_uri"])),
        ("WARC-Payload-Digest", digest and f"sha1:{digest}"),
        ("WARC-Refers-To", record.get("refers_to")),
        ("WARC-Profile", PROFILE if kind == "revisit" else None),
        *(record.get("headers") or ()),
        ("Content-Type", content_type),
        ("Content-Length", str(len(body))),
    ]
    head = "".join(f"{_line(name)}: {_line(value)}\r\n" for name, value in lines if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + _END


def _percent(found: re.Match) -> str:
    return f"%{ord(found[0]):02X}"


def _line(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def gzip_member(record: bytes, level: int = LEVEL) -> bytes:
    """The record as one gzip member that names its own length."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    data = deflate.compress(record) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    length = len(_GZIP) + 2 + 12 + len(data) + len(tail)
    if max(length, len(record)) >> 32:  # does not fit the field: a member without it
        return _GZIP[:3] + b"\x00" + _GZIP[4:] + data + tail
    extra = struct.pack("<H2sHII", 12, b"SL", 8, length, len(record))
    return _GZIP + extra + data + tail


def _skip(file: io.BufferedReader, end: int) -> None:
    """Go to the end of a record, which has to be there."""
    file.seek(end - 1)
    if not file.read(1):
        raise ValueError("the record is cut off")


class _Plain:
    """A record of an uncompressed file, read and skipped in place."""

    def __init__(self, file: io.BufferedReader) -> None:
        self.file, self.left = file, 0

    def head(self) -> bytes | None:
        out = self.file.read(4)
        while out and not out.endswith(_END):
            more = self.file.readline()
            if not more:
                raise ValueError("the header has no end")
            out += more
        return out or None

    def read(self, size: int) -> bytes:
        return self.file.read(size)

    def close(self, left: int) -> None:
        _skip(self.file, self.file.tell() + left)


class _Gzip:
    """A record of a file with a gzip member per record; no more is inflated than is asked for."""

    def __init__(self, file: io.BufferedReader) -> None:
        self.file = file

    def head(self) -> bytes | None:
        start = self.file.tell()
        fixed = self.file.read(10)
        if not fixed:
            return None
        if fixed[:3] != _GZIP[:3] or len(fixed) < 10:
            raise ValueError("no gzip member")
        self.end = self._fields(fixed[3], start)
        self.inflate, self.ready = zlib.decompressobj(-15), b""
        while _END not in self.ready:
            more = self._more(STEP)
            if not more:
                raise ValueError("the header has no end")
            self.ready += more
        out, _, self.ready = self.ready.partition(_END)
        return out + _END

    def _fields(self, flags: int, start: int) -> int | None:
        """Skip the member's optional fields; where it ends, if it tells."""
        end = None
        if flags & 4:
            extra = self.file.read(struct.unpack("<H", self.file.read(2))[0])
            while len(extra) >= 4:
                name, size = struct.unpack("<2sH", extra[:4])
                if name == b"SL" and size == 8:
                    end = start + struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size :]
        for flag in (8, 16):
            while flags & flag and self.file.read(1) not in (b"\0", b""):
                pass
        if flags & 2:
            self.file.read(2)
        return end

    def _more(self, size: int) -> bytes:
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.file.read(STEP)
            out = self.inflate.decompress(data, size)
            if out or not data and not self.inflate.eof:
                return out
        return b""

    def read(self, size: int) -> bytes:
        parts, have = [self.ready], len(self.ready)
        while have < size and (more := self._more(max(STEP, size - have))):
            parts.append(more)
            have += len(more)
        whole = b"".join(parts)
        self.ready = whole[size:]
        return whole[:size]

    def close(self, left: int) -> None:
        if self.end is None:
            while self._more(1 << 16):
                pass
            if not self.inflate.eof:
                raise ValueError("the member has no end")
            self.end = self.file.tell() - len(self.inflate.unused_data) + 8
        _skip(self.file, self.end)


def parse_head(head: bytes) -> dict[str, str]:
    """Header fields by name; a line that begins blank goes on with the one before."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    out: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += f" {line.strip()}"
        elif ":" in line:
            name, _, value = line.partition(":")
            out[name] = value.strip()
    return out


def records(file: io.BufferedReader, compressed: bool, wanted: Sequence[ds.Filter], payloads: bool) -> Iterator[dict]:
    """The records whose header passes the filters, with payloads if asked for."""
    reader = _Gzip(file) if compressed else _Plain(file)
    while (head := reader.head()) is not None:
        fields = parse_head(head)
        names = {name.lower(): value for name, value in fields.items()}
        row: dict[str, Any] = {column: names.get(name.lower()) for column, name in NAMES.items()}
        length = row["content_length"] = int(row["content_length"] or 0)
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        row["headers"], left = fields, length + len(_END)
        if all(matches(f, row) for f in wanted):
            row["payload_bytes"], row["payload"] = length, None
            http = (row["content_type"] or "").startswith(HTTP)
            before, size = b"", length
            if http:
                while _END not in before and len(before) < length:
                    before += reader.read(min(STEP if payloads else 512, length - len(before)))
                http_head, _, before = before.partition(_END)
                size = length - len(http_head) - len(_END)
                told = re.search(rb"(?im)^content-length:\s*(\d+)", http_head)
                row["payload_bytes"] = int(told[1]) if told else size
                left -= len(http_head) + len(_END) + len(before)
            if payloads and row["record_type"] != "revisit":
                rest = reader.read(size - len(before))
                left -= len(rest)
                row["payload"] = before + rest
                if len(row["payload"]) != size:
                    raise ValueError("the record is cut off")
            yield row
        reader.close(left)


# --- filters -----------------------------------------------------------------

_COMPARE = {
    ds.EqualTo: lambda x, y: x == y,
    ds.GreaterThan: lambda x, y: x > y,
    ds.GreaterThanOrEqual: lambda x, y: x >= y,
    ds.LessThan: lambda x, y: x < y,
    ds.LessThanOrEqual: lambda x, y: x <= y,
    ds.In: lambda x, y: x in y,
    ds.StringStartsWith: lambda x, y: x.startswith(y),
    ds.StringEndsWith: lambda x, y: x.endswith(y),
    ds.StringContains: lambda x, y: y in x,
}


def can_push(f: ds.Filter) -> bool:
    if isinstance(f, ds.Not):
        return can_push(f.child)
    known = type(f) in _COMPARE or isinstance(f, (ds.IsNull, ds.IsNotNull, ds.EqualNullSafe))
    return known and len(f.attribute) == 1 and f.attribute[0] in NAMES


def matches(f: ds.Filter, row: dict[str, Any]) -> bool | None:
    """SQL's answer of a filter on a header: None where it is unknown."""
    if isinstance(f, ds.Not):
        inner = matches(f.child, row)
        return None if inner is None else not inner
    value = row[f.attribute[0]]
    if isinstance(f, (ds.IsNull, ds.IsNotNull)):
        return (value is None) == isinstance(f, ds.IsNull)
    if isinstance(f, ds.EqualNullSafe):
        return value == f.value
    if value is None or f.value is None:
        return None
    found = _COMPARE[type(f)](value, f.value)
    return None if isinstance(f, ds.In) and not found and None in f.value else found


# --- data source -------------------------------------------------------------


@dataclass
class Files(ds.InputPartition):
    paths: list[str]


@dataclass
class Written(ds.WriterCommitMessage):
    names: list[str]


def counted_files(path: str) -> list[fs.FileInfo]:
    """The files that finished writes have listed; all archives of a folder without lists."""
    store, root = file_system(path)
    if store.get_file_info(root).type == fs.FileType.File:
        return [store.get_file_info(root)]
    found = store.get_file_info(fs.FileSelector(root, recursive=True))
    lists = [f for f in found if f.base_name.startswith("_written-")]
    archives = [f for f in found if f.is_file and re.search(r"\.warc(\.gz)?$", f.base_name)]
    if lists:
        names = {name for f in lists for name in json.loads(store.open_input_file(f.path).readall())}
        archives = [f for f in archives if f.base_name in names]
        if len(archives) != len(names):
            raise FileNotFoundError(f"{path}: {len(names)} files are listed, {len(archives)} are there")
    return sorted(archives, key=lambda f: f.path)


class WarcReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.path = schema, options["path"]
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.wanted: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:  # noqa: N802
        for f in filters:
            if can_push(f):
                self.wanted.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Whole files, in order, up to ``partition_bytes`` together."""
        out, size = [], 0
        for info in counted_files(self.path):
            if not out or size + info.size > self.partition_bytes:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(info.path)
            size += info.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kind, names = to_arrow_schema(self.schema), self.schema.names
        batch, size = [], 0
        for row in self._rows(partition.paths, "payload" in names):
            batch.append({name: row[name] for name in names})
            size += row["content_length"]
            if size >= BATCH_BYTES or len(batch) >= 1000:
                yield pa.RecordBatch.from_pylist(batch, kind)
                batch, size = [], 0
        if batch:
            yield pa.RecordBatch.from_pylist(batch, kind)

    def _rows(self, paths: list[str], payloads: bool) -> Iterator[dict]:
        store, _ = file_system(self.path)
        for path in paths:
            with io.BufferedReader(store.open_input_file(path), 1 << 18) as file:
                try:
                    yield from records(file, path.endswith(".gz"), self.wanted, payloads)
                except (ValueError, struct.error, zlib.error) as wrong:
                    raise ValueError(f"{path}, near byte {file.tell()}: {wrong}") from wrong


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.overwrite = options["path"], overwrite
        self.compressed = options.get("compression", "gzip") == "gzip"
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def _open(self, names: list[str], part: int) -> Any:
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        names.append(f"part-{part:05d}-{uuid.uuid4().hex}.warc{'.gz' if self.compressed else ''}")
        file = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
        info = {"record_type": "warcinfo", "content_type": "application/warc-fields", "payload": b"format: WARC/1.1\r\n"}
        file.write(self._bytes(info))
        return file

    def _bytes(self, record: dict[str, Any]) -> bytes:
        plain = encode_record(record, self.now)
        return gzip_member(plain) if self.compressed else plain

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        names: list[str] = []
        file, part = None, TaskContext.get().partitionId()
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if file is None or file.tell() >= self.file_bytes:
                        if file is not None:
                            file.close()
                        file = self._open(names, part)
                    file.write(self._bytes(row))
        finally:
            if file is not None:
                file.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        before = store.get_file_info(fs.FileSelector(root)) if self.overwrite else []
        names = [name for message in messages if message for name in message.names]
        with store.open_output_stream(f"{root}/_written-{uuid.uuid4().hex}.json") as file:
            file.write(json.dumps(names).encode())
        # The old list goes first: a folder is never without one.
        for info in sorted(before, key=lambda f: not f.base_name.startswith("_written-")):
            if info.is_file and info.base_name not in names:
                store.delete_file(info.path)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = file_system(self.path)
        for message in messages:
            for name in message.names if message else ():
                store.delete_file(f"{root}/{name}")


class WarcDataSource(ds.DataSource):
    """``format("warc")``; options ``path``, ``partition_bytes``, ``file_bytes`` and ``compression``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


# --- pages -------------------------------------------------------------------


def base32(hexadecimal: Column) -> Column:
    """Base32 of a hex text whose length is a multiple of 5; four characters per 20 bits."""
    part = lambda at: F.lpad(F.conv(F.substring(hexadecimal, 1 + 5 * at, 5), 16, 32), 4, "0")
    digits = F.concat(*[part(at) for at in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def revisit_records(pages: DataFrame) -> DataFrame:
    """Pages as records, equal payloads once.

    Payloads are compared by SHA-256.  Only the digests are grouped; what goes back
    to the pages is a row per payload that occurs more than once, broadcast if its counted
    size allows it.  Revisits go on without their payload.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    rows = keyed(pages.select(F.col("page_id").alias("doc_id"), "url", "html"), scratch)
    html = F.coalesce(F.col("_row.html"), F.lit("")).cast("binary")
    rows = rows.select(F.col("_row.doc_id").alias("page_id"), "_key", F.col("_row.url").alias("url"), html.alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("html", 256)))
    last = F.max(F.struct("page_id", "_key")).alias("last")
    copies = rows.groupBy("sha").agg(last, F.count("*").alias("n")).where("n > 1").select("sha", "last")
    found = lookup_join(rows, scratch.settle(copies), ["sha"], ["_key"])
    again = F.col("last").isNotNull() & (F.col("last._key") != F.col("_key"))
    name = lambda key: F.md5(F.concat(F.hex("sha"), key.cast("string")))
    urn = lambda key: F.regexp_replace(
        name(key), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>"
    )
    pairs = F.map_from_arrays(
        F.array(F.lit("X-Page-ID"), F.lit("X-Refers-To-Page-ID")),
        F.array(F.col("page_id").cast("string"), F.when(again, F.col("last.page_id").cast("string"))),
    )
    return found.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("_key")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.octet_length("html").cast("long").alias("payload_bytes"),
        base32(F.sha1("html")).alias("payload_digest"),
        F.when(again, urn(F.col("last._key"))).alias("refers_to"),
        F.map_filter(pairs, lambda _, value: value.isNotNull()).alias("headers"),
        F.when(~again, F.col("html")).alias("payload"),
    )


def write_archives(pages: DataFrame, path: str) -> None:
    register(pages.sparkSession)
    revisit_records(pages).write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    return register(spark).read.format("warc").schema(columns).load(path)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through archives and back; digests and lengths of responses are those of what was read."""
    path = session.shared_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    page = lambda name: F.col("headers")[name].cast("long")
    responses = read_archives(spark, path, "record_type string, headers map<string,string>, payload binary")
    headers = "record_type string, headers map<string,string>, payload_digest string, payload_bytes long"
    return (
        responses.where("record_type = 'response'")
        .select(
            page("X-Page-ID").alias("page_id"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            base32(F.sha1("payload")).alias("payload_digest"),
            "record_type",
            F.lit(None).cast("long").alias("refers_to"),
        )
        .unionByName(
            read_archives(spark, path, headers)
            .where("record_type = 'revisit'")
            .select(
                page("X-Page-ID").alias("page_id"),
                "payload_bytes",
                "payload_digest",
                "record_type",
                page("X-Refers-To-Page-ID").alias("refers_to"),
            )
        )
    )


ORACLE_SQL = """
with p as (
  select page_id, coalesce(html, '') html, sha1(coalesce(html, '')) h,
    row_number() over (partition by coalesce(html, '') order by page_id desc nulls last) nth,
    max(page_id) over (partition by coalesce(html, '')) last from pages)
select page_id, strlen(html)::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, (1 + 5 * (i // 4))::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31) + 1)::int, 1)), '') as payload_digest,
  case when nth = 1 then 'response' else 'revisit' end as record_type,
  case when nth > 1 then last end as refers_to
from p
"""
