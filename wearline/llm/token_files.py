"""Token ids of documents in binary files, compressed by `id_coder`, as a Spark data source.

Writing: `write_documents` range-sorts whole documents by (doc_id, hash of the text); the writing tasks tokenise
them and append the end id to each. A task cuts its stream of ids into groups of up to GROUP_IDS ids of whole
documents, and a group into blocks of nearly equal length of at most BLOCK_IDS; blocks are coded
independently, a group's blocks together. A task's files are taken into a manifest when the job commits,
in range order, with their number of ids; files of failed or speculative attempts are never read.

File format, little-endian: `WIDS`, version, bits of an id (one byte each), two zero bytes; then groups,
each with a header of 24 bytes (number of documents, ids and blocks, bytes of the document table, bytes of
all blocks, CRC-32 of the table and the block list), the document table (zlib: a validity byte and a
64-bit number for each doc_id, then 64-bit token counts), the block list (ids, bytes and CRC-32 of the ids as 32-bit
integers for each block) and the blocks.

Reading: `spark.read.format("token_ids").load(folder)` gives doc_id, start (ids of all documents before
it in the folder), n_tokens (with the end id) and ids (binary, 32-bit little-endian). A partition is a
group of whole files. Bounds on doc_id are pushed down: only blocks that hold wanted documents are
decoded. A block whose ids do not have its checksum raises. `ids=false` leaves the ids out and decodes
nothing.

Defined cases: a null text is empty; a document without tokens still has the end id; a null doc_id sorts
first and stays null; rows with equal doc_id are documents of their own, in order of their texts' hashes;
a document of any length lies in one group, so a task must hold its ids; an empty table writes no
file and reads as no row; extra columns are not written. A vocabulary may have up to 2 ** 21 ids.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from wearline.llm import id_coder
from wearline.llm.byte_ids import shared_ids
from wearline.llm.text import portions
from wearline.llm.warc import file_system

SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
BLOCK_IDS = 2048
GROUP_IDS = 1 << 22
FILE_BYTES = 64 << 20
SPLIT_BYTES = 4 << 20
MAGIC, VERSION = b"WIDS", 1
HEAD = struct.Struct("<IIIIII")
MANIFEST = "_committed-"


# --- groups ----------------------------------------------------------------------------------


def block_lengths(n: int, limit: int = BLOCK_IDS) -> list[int]:
    """Lengths that differ by one at most; small groups get shorter blocks, so that many are coded together."""
    limit = max(min(limit, n // 256), min(limit, 1024))
    blocks = -(-n // limit)
    return [n // blocks + (k < n % blocks) for k in range(blocks)] if n else []


def pack_group(doc_ids: list[int | None], ids: list[np.ndarray], id_bits: int) -> bytes:
    stream = np.concatenate(ids).astype("<u4")
    cuts = np.cumsum(block_lengths(len(stream)))
    blocks = np.split(stream, cuts[:-1])
    coded = id_coder.encode(blocks, id_bits)
    valid = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    counts = np.array([len(i) for i in ids], "<i8")
    table = zlib.compress(valid.tobytes() + numbers.tobytes() + counts.tobytes(), 1)
    listed = np.array([[len(b), len(c), zlib.crc32(b)] for b, c in zip(blocks, coded)], "<u4").tobytes()
    head = HEAD.pack(len(doc_ids), len(stream), len(blocks), len(table), sum(map(len, coded)), zlib.crc32(table + listed))
    return b"".join([head, table, listed, *coded])


def unpack_group(file, id_bits: int, low: int | None = None, high: int | None = None, ids: bool = True):
    """(doc_ids, validity, token counts, ids of each wanted document or None) of the next group; None at the end.

    Documents outside low..high are not decoded and have no ids.
    """
    head = file.read(HEAD.size)
    if not head:
        return None
    docs, total, n_blocks, table_bytes, block_bytes, checksum = HEAD.unpack(head)
    table, listed = file.read(table_bytes), file.read(12 * n_blocks)
    if zlib.crc32(table + listed) != checksum:
        raise ValueError("a group's tables do not have their checksum")
    plain = zlib.decompress(table)
    valid = np.frombuffer(plain, np.uint8, docs) > 0
    numbers, counts = np.frombuffer(plain, "<i8", docs, docs), np.frombuffer(plain, "<i8", docs, 9 * docs)
    wanted = np.ones(docs, bool)
    if low is not None:
        wanted &= valid & (numbers >= low)
    if high is not None:
        wanted &= valid & (numbers <= high)
    if not ids or not wanted.any():
        file.read(block_bytes)
        return numbers, valid, counts, wanted, None
    listed = np.frombuffer(listed, "<u4").reshape(n_blocks, 3).astype(np.int64)
    data = memoryview(file.read(block_bytes))
    ends, byte_ends, doc_ends = np.cumsum(listed[:, 0]), np.cumsum(listed[:, 1]), np.cumsum(counts)
    # Number of wanted ids below a place tells which blocks hold any.
    upto = np.concatenate([[0], np.cumsum(np.where(wanted, counts, 0))])

    def before(place):
        doc = np.searchsorted(doc_ends, place, "right")
        inside = place - np.where(doc > 0, doc_ends[np.maximum(doc, 1) - 1], 0)
        return upto[doc] + np.where(np.append(wanted, False)[doc], inside, 0)

    needed = np.flatnonzero(before(ends) > before(ends - listed[:, 0]))
    found = id_coder.decode([bytes(data[byte_ends[b] - listed[b, 1] : byte_ends[b]]) for b in needed], [int(n) for n in listed[needed, 0]], id_bits)
    stream = np.zeros(total, "<u4")
    for b, part in zip(needed, found):
        if zlib.crc32(part.astype("<u4")) != listed[b, 2]:
            raise ValueError("a block's ids do not have their checksum")
        stream[ends[b] - listed[b, 0] : ends[b]] = part
    return numbers, valid, counts, wanted, stream


# --- writing ---------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    partition: int
    files: list[tuple[str, int, int]]  # name, ids, bytes


class TokenWriter(DataSourceArrowWriter):
    """Writes (doc_id, text) in the order of partitions and rows; texts are tokenised here, in the task that codes them."""

    def __init__(self, options: dict[str, str]):
        self.path, self.job = options["path"], uuid.uuid4().hex
        self.vocabulary, self.end_id = options["vocabulary"], int(options.get("endid", 0))
        self.id_bits = int(options.get("idbits", 16))
        self.group_ids = int(options.get("groupids", GROUP_IDS))
        self.limit = int(options.get("filebytes", FILE_BYTES))
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)

    def write(self, iterator):
        context = TaskContext.get()
        store, root = file_system(self.path)
        files, file = [], None
        for doc_ids, ids in self._groups(iterator):
            if file is None or files[-1][2] >= self.limit:
                if file:
                    file.close()
                files.append([f"part-{context.partitionId():06d}-{len(files):04d}-{context.taskAttemptId()}-{self.job}.ids", 0, 8])
                file = store.open_output_stream(f"{root}/{files[-1][0]}", compression=None)
                file.write(MAGIC + bytes([VERSION, self.id_bits, 0, 0]))
            data = pack_group(doc_ids, ids, self.id_bits)
            file.write(data)
            files[-1][1] += sum(map(len, ids))
            files[-1][2] += len(data)
        if file:
            file.close()
        return Written(context.partitionId(), [tuple(f) for f in files])

    def _groups(self, iterator):
        encoder = shared_ids(self.vocabulary)
        doc_ids, ids, held = [], [], 0
        for batch in portions(iterator, "text"):
            for doc_id, own in zip(batch["doc_id"].to_pylist(), encoder.encode(batch["text"])):
                own = np.append(own, self.end_id).astype("<u4")
                if doc_ids and held + len(own) > self.group_ids:
                    yield doc_ids, ids
                    doc_ids, ids, held = [], [], 0
                doc_ids.append(doc_id)
                ids.append(own)
                held += len(own)
        if doc_ids:
            yield doc_ids, ids

    def commit(self, messages):
        store, root = file_system(self.path)
        files = [f for m in sorted((m for m in messages if m), key=lambda m: m.partition) for f in m.files]
        with store.open_output_stream(f"{root}/.{self.job}") as out:
            out.write(json.dumps(files).encode())
        store.move(f"{root}/.{self.job}", f"{root}/{MANIFEST}{self.job}")

    def abort(self, messages):
        store, root = file_system(self.path)
        for name, *_ in (f for m in messages if m for f in m.files):
            store.delete_file(f"{root}/{name}")


# --- reading ---------------------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    files: list[tuple[str, int]]  # path, ids in files before it


class TokenReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.ids = options.get("ids", "true").lower() == "true"
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.low = self.high = None

    def pushFilters(self, filters):
        """Bounds on doc_id choose blocks; the rows that pass are filtered again by Spark."""
        for f in filters:
            if getattr(f, "attribute", None) == ("doc_id",) and isinstance(getattr(f, "value", None), int):
                low = {EqualTo: f.value, GreaterThanOrEqual: f.value, GreaterThan: f.value + 1}.get(type(f))
                high = {EqualTo: f.value, LessThanOrEqual: f.value, LessThan: f.value - 1}.get(type(f))
                self.low = low if self.low is None else self.low if low is None else max(low, self.low)
                self.high = high if self.high is None else self.high if high is None else min(high, self.high)
            yield f

    def partitions(self):
        store, root = file_system(self.path)
        manifests = sorted(f.path for f in store.get_file_info(pa.fs.FileSelector(root)) if f.base_name.startswith(MANIFEST))
        if len(manifests) != 1:
            raise ValueError(f"{self.path} holds {len(manifests)} committed writes, not one")
        with store.open_input_stream(manifests[0]) as file:
            files = json.loads(file.read())
        groups, held, start = [[]], 0, 0
        for name, n, size in files:
            if groups[-1] and held + size > self.split:
                groups.append([])
                held = 0
            groups[-1].append((f"{root}/{name}", start))
            held += size
            start += n
        return [Files(g) for g in groups]

    def read(self, partition):
        store, _ = file_system(self.path)
        for path, start in partition.files:
            with store.open_input_stream(path, compression=None) as file:
                magic = file.read(8)
                if magic[:4] != MAGIC or magic[4] != VERSION:
                    raise ValueError(f"{path} is not a token file of version {VERSION}")
                while (group := unpack_group(file, magic[5], self.low, self.high, self.ids)) is not None:
                    yield from self._batches(group, start)
                    start += int(group[2].sum())

    @staticmethod
    def _batches(group, start: int) -> Iterator[pa.RecordBatch]:
        numbers, valid, counts, wanted, stream = group
        ends = np.cumsum(counts)
        docs = np.flatnonzero(wanted)
        for some in np.array_split(docs, max(1, -(-len(docs) // 1024))):
            if not len(some):
                continue
            ids = pa.nulls(len(some), pa.binary()) if stream is None else pa.array([stream[ends[d] - counts[d] : ends[d]].tobytes() for d in some], pa.binary())
            yield pa.record_batch(
                [pa.array(numbers[some], pa.int64(), mask=~valid[some]), pa.array(start + ends[some] - counts[some]), pa.array(counts[some]), ids],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


class TokenDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "token_ids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return TokenReader(dict(self.options))

    def writer(self, schema, overwrite):
        return TokenWriter(dict(self.options))


def read_documents(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(TokenDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("token_ids").options(**options).load(path)


def write_documents(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, key: str = "doc_id", text: str = "text", **options: str) -> None:
    """Write the ids of all documents in ascending order of `key`. `path` must not hold an earlier write."""
    from public_tokenizers import path as vocabulary_path

    docs.sparkSession.dataSource.register(TokenDataSource)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_hash"))
    # Equal doc_ids may be many: the hash lets a range end between them.
    ranged = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash").select("doc_id", "text")
    ranged.write.format("token_ids").options(vocabulary=vocabulary_path(vocabulary), endid=str(end_id), **options).mode("append").save(path)
