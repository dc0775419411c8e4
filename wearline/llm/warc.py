"""WARC archives as a Spark data source, with pages written as response and revisit records.

Reading (`spark.read.format("warc").load(folder)`): each partition is a group of whole files of about
`splitBytes`. Headers are parsed first; a record that a pushed filter on its headers rejects, or
whose payload is not asked for (`payload=false`), is not decoded further: an uncompressed record is
stepped over by its Content-Length, a compressed one by the skip length in its gzip header, where its
writer has put one. Filters on record_type, record_id, target_uri, payload_digest and refers_to are
pushed down (equality, IN, prefix, null tests) when spark.sql.python.filterPushdown.enabled is true;
`read_archives` sets it.

Writing (`df.write.format("warc").mode("append").save(folder)`): each task attempt writes files of its
own and reports them; the commit lists the files of successful attempts in a manifest, so what failed
or speculative attempts leave behind is never read. Folders without a manifest are read by listing.

Defined cases: a null payload is empty; a null url writes no target header; line breaks in a url are
percent-encoded; an empty table writes no record; unknown record types are read with their whole
block as payload; a record that ends early raises. Of pages with equal payloads those with the
smallest page_id are responses (several when that id repeats), the others revisit them; a null
page_id revisits any other. Extra columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, payload_digest string, "
    "refers_to string, content_length long, http_length long, payload binary"
)
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
ARROW = pa.schema(
    [(c, pa.string()) for c in HEADERS] + [("content_length", pa.int64()), ("http_length", pa.int64()), ("payload", pa.binary())]
)
BLOCK = 1 << 16
BATCH_BYTES = 4 << 20
SPLIT_BYTES = 32 << 20
FILE_BYTES = 64 << 20
MANIFEST = "_committed-"
PAGE_ID = "urn:page:"


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The store behind a path or URI; file:/x is taken as file:///x."""
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


# --- records ---------------------------------------------------------------------------------


def _header(lines: dict[str, str | None]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in lines.items() if v is not None) + b"\r\n"


def record(headers: dict[str, str | None], block: bytes) -> bytes:
    return b"WARC/1.1\r\n" + _header(headers | {"Content-Length": str(len(block))}) + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """One gzip member whose extra field "sl" holds its compressed and plain length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    known = size < 1 << 32 and len(data) < 1 << 32
    extra = b"sl" + struct.pack("<HII", 8, size, len(data)) if known else b""
    start = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return start + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class _Cursor:
    """Buffered forward reading of one file; skip() does not read what it passes."""

    def __init__(self, file):
        self.file, self.at, self.buffer = file, 0, b""
        self.size = file.size()

    def peek(self, n: int) -> bytes:
        if len(self.buffer) < n and self.at + len(self.buffer) < self.size:
            self.file.seek(self.at + len(self.buffer))
            self.buffer += self.file.read(max(n - len(self.buffer), BLOCK))
        return self.buffer[:n]

    def skip(self, n: int) -> None:
        self.buffer = self.buffer[n:]
        self.at += n

    def take(self, n: int) -> bytes:
        data = self.peek(n)
        if len(data) < n:
            raise ValueError("the archive ends inside a record")
        self.skip(n)
        return data

    def ended(self) -> bool:
        return not self.peek(1)


def _parse(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return out


class _Plain:
    """An uncompressed record: the block is read or stepped over by its length."""

    def __init__(self, cursor: _Cursor):
        n = BLOCK
        while (end := cursor.peek(n).find(b"\r\n\r\n")) < 0:
            if len(cursor.peek(n)) < n:
                raise ValueError("the archive ends inside a record header")
            n *= 2
        self.cursor, self.headers = cursor, _parse(cursor.peek(end))
        cursor.skip(end + 4)
        self.left = int(self.headers["content-length"])

    def block(self) -> bytes:
        data = self.cursor.take(self.left)
        self.left = 0
        return data

    def start(self, n: int) -> bytes:
        return self.cursor.peek(min(n, self.left))

    def close(self) -> None:
        self.cursor.skip(self.left)
        while self.cursor.peek(1) in (b"\r", b"\n"):
            self.cursor.skip(1)


class _Zipped:
    """A gzip member holding one record: only as much as is needed is inflated."""

    def __init__(self, cursor: _Cursor):
        self.cursor = cursor
        fixed = cursor.peek(12)
        self.end = None
        if len(fixed) == 12 and fixed[3] & 4:
            extra = cursor.peek(12 + struct.unpack("<H", fixed[10:])[0])[12:]
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    self.end = cursor.at + struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size :]
        self.inflate, self.data = zlib.decompressobj(31), b""
        while (head := self.data.find(b"\r\n\r\n")) < 0:
            self._more()
        self.headers, self.data = _parse(self.data[:head]), self.data[head + 4 :]
        self.length = int(self.headers["content-length"])

    def _more(self) -> None:
        if self.inflate.eof or self.cursor.ended():
            raise ValueError("the archive ends inside a record")
        given = self.cursor.peek(4096)
        self.data += self.inflate.decompress(given)
        self.cursor.skip(len(given) - len(self.inflate.unused_data))

    def start(self, n: int) -> bytes:
        while len(self.data) < min(n, self.length):
            self._more()
        return self.data[: min(n, self.length)]

    def block(self) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < self.length:
            self.data = b""
            self._more()
            parts.append(self.data)
            have += len(self.data)
        self.data = b"".join(parts)
        return self.data[: self.length]

    def close(self) -> None:
        if self.end is not None:
            self.cursor.skip(self.end - self.cursor.at)
        while self.end is None and not self.inflate.eof:
            self.data = b""
            self._more()


def records(cursor: _Cursor) -> Iterator[_Plain | _Zipped]:
    """The records of a file, headers parsed; each must be closed before the next."""
    while not cursor.ended():
        yield (_Zipped if cursor.peek(2) == b"\x1f\x8b" else _Plain)(cursor)


# --- reading ---------------------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        kinds = {EqualTo: "equal", EqualNullSafe: "equal", In: "in", StringStartsWith: "starts", IsNull: "null", IsNotNull: "not null"}
        for f in filters:
            kind = kinds.get(type(f))
            if kind and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                value = set(f.value) if kind == "in" else getattr(f, "value", None)
                self.filters.append((f.attribute[0], kind, value))
            else:
                yield f

    def wanted(self, values: dict[str, str | None]) -> bool:
        for column, kind, value in self.filters:
            own = values[column]
            if kind == "equal" and own != value or kind == "in" and own not in value:
                return False
            if kind == "starts" and not (own or "").startswith(value):
                return False
            if (kind == "null") if own is not None else (kind in ("not null", "starts", "in")):
                return False
        return True

    def partitions(self):
        store, root = file_system(self.path)
        found = {f.path: f for f in store.get_file_info(pa.fs.FileSelector(root, recursive=True)) if f.type == pa.fs.FileType.File}
        manifests = [p for p in found if p.rpartition("/")[2].startswith(MANIFEST)]
        if manifests:
            names = []
            for p in manifests:
                with store.open_input_stream(p) as file:
                    names += [f"{p.rpartition('/')[0]}/{n}" for n in json.loads(file.read())]
        else:
            names = [p for p in found if re.search(r"\.warc(\.gz)?$", p)]
        groups, held = [[]], 0
        for p in sorted(names):
            if groups[-1] and held + found[p].size > self.split:
                groups.append([])
                held = 0
            groups[-1].append(p)
            held += found[p].size
        return [Files(g) for g in groups]

    def read(self, partition):
        store, _ = file_system(self.path)
        columns, held = [[] for _ in ARROW], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                for rec in records(_Cursor(file)):
                    values = {c: rec.headers.get(h) for c, h in HEADERS.items()}
                    if self.wanted(values):
                        row = [*values.values(), int(rec.headers["content-length"]), *self._content(rec, values)]
                        for column, value in zip(columns, row):
                            column.append(value)
                        held += len(row[-1] or b"") + 200
                    rec.close()
                    if held >= BATCH_BYTES:
                        yield self._batch(columns)
                        columns, held = [[] for _ in ARROW], 0
        if columns[0]:
            yield self._batch(columns)

    def _content(self, rec, values) -> tuple[int | None, bytes | None]:
        """HTTP Content-Length and payload."""
        head = b""
        if rec.headers.get("content-type", "").startswith("application/http"):
            n = BLOCK
            while (end := rec.start(n).find(b"\r\n\r\n")) < 0 and len(rec.start(n)) == n:
                n *= 2
            head = rec.start(n)[: end + 4 if end >= 0 else n]
        length = _parse(head).get("content-length") if head else None
        payload = rec.block()[len(head) :] if self.payload and values["record_type"] != "revisit" else None
        if self.verify and payload is not None and values["payload_digest"]:
            if values["payload_digest"] != f"sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}":
                raise ValueError(f"payload of {values['record_id']} does not have its digest")
        return int(length) if length is not None else None, payload

    @staticmethod
    def _batch(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ARROW.types)], schema=ARROW)


# --- writing ---------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Writes (record_type, record_id, target_uri, date, payload_digest, refers_to, http_length, payload)."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.job = options["path"], uuid.uuid4().hex
        self.level = int(options.get("level", 1))
        self.limit = int(options.get("filebytes", FILE_BYTES))
        store, root = file_system(self.path)
        if overwrite and store.get_file_info(root).type == pa.fs.FileType.Directory:
            store.delete_dir_contents(root)
        store.create_dir(root, recursive=True)

    def write(self, iterator):
        context = TaskContext.get()
        store, root = file_system(self.path)
        names, file, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if file is None or size >= self.limit:
                    if file:
                        file.close()
                    names.append(f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{len(names)}-{self.job}.warc.gz")
                    file, size = store.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                    info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": row["date"], "Content-Type": "application/warc-fields"}
                    file.write(gzip_member(record(info, b"format: WARC File Format 1.1\r\n"), self.level))
                data = gzip_member(self._record(row), self.level)
                file.write(data)
                size += len(data)
        if file:
            file.close()
        return Written(names)

    @staticmethod
    def _record(row: dict) -> bytes:
        uri = row["target_uri"]
        revisit = row["record_type"] == "revisit"
        headers = {
            "WARC-Type": row["record_type"],
            "WARC-Record-ID": row["record_id"],
            "WARC-Date": row["date"],
            "WARC-Target-URI": uri.replace("\r", "%0D").replace("\n", "%0A") if uri is not None else None,
            "WARC-Payload-Digest": row["payload_digest"],
            "WARC-Refers-To": row["refers_to"],
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
            "Content-Type": "application/http; msgtype=response",
        }
        http = b"HTTP/1.1 200 OK\r\n" + _header({"Content-Type": "text/html; charset=utf-8", "Content-Length": str(row["http_length"])})
        return record(headers, http if revisit else http + (row["payload"] or b""))

    def commit(self, messages):
        store, root = file_system(self.path)
        names = sorted(n for m in messages if m for n in m.names)
        with store.open_output_stream(f"{root}/.{self.job}") as file:
            file.write(json.dumps(names).encode())
        store.move(f"{root}/.{self.job}", f"{root}/{MANIFEST}{self.job}")

    def abort(self, messages):
        store, root = file_system(self.path)
        for name in (n for m in messages if m for n in m.names):
            store.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def read_archives(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(path)


def write_pages(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z", **options: str) -> None:
    """Write one record per page; equal payloads are stored once."""
    register(pages.sparkSession)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha"))
    # Only payloads that repeat take part in the join; most pages find no partner. A hot payload's
    # pages are the large side, which adaptive execution splits.
    repeated = rows.groupBy("sha").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rows = rows.join(repeated, "sha", "left")
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit(f"<{PAGE_ID}"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        name("key").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(F.lit("sha1:"), base32(F.col("sha"))).alias("payload_digest"),
        F.when(revisit, name("first")).alias("refers_to"),
        F.length("payload").cast("long").alias("http_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    ).write.format("warc").options(**options).mode("append").save(path)


def base32(digest: F.Column) -> F.Column:
    """Upper-case base 32 of a 40-digit hexadecimal number: 5 hexadecimal digits make 4 characters."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = []
    for at in range(8):
        number = F.conv(F.substring(digest, 1 + 5 * at, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            parts.append(F.substring(F.lit(alphabet), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*parts)


def page_number(name: F.Column) -> F.Column:
    """The page id in a record id, null where it is none."""
    return F.regexp_extract(name, f"{PAGE_ID}(-?[0-9]+)>", 1).try_cast("long")
