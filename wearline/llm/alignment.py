"""Alignment of two tokenizers over whole texts, with corpus-wide counts of linked id pairs.

A (byte-level BPE) and B (sentencepiece, which puts a space before the text itself) tokenise space + text.
Offsets where tokens of both end cut the tokens into groups; the tokens that end there are linked.
A document's links are weighed by how often their pair of ids is linked in the whole corpus. The pairs are
counted externally:

1. Tasks align documents and collect runs of up to RUN_LINKS links. A run's (pair, document, links) records
   are radix-partitioned by the low digits of the B id into BUCKETS, sorted by B id, A id and document, and
   written as zstd frames: one column for the pairs with their counts, one for the records.
2. A bucket's runs are merged by their pairs with a heap, FAN runs at a time, in levels until one run is
   left; a merge holds one frame of each run. In this order the pairs of a B id stand together, which
   gives its maximum on the way.
3. The records of each bucket stream past the counts again, some runs per task, and give every document
   of a run its contribution; a run's buckets are then added up.

Nothing is sent per link occurrence: repeated pairs of a document are one record, and a pair that is in all
documents has one record per document, spread over the runs. A merged bucket is bounded by the vocabularies
alone, not by the corpus.

Both tokenisers find the same tokens in a text as in its pieces (see `pieces`), so a bounded memory
holds the alignment of every piece. A piece begins with its space, which is what sentencepiece puts before
a text; before one that begins with a line feed it puts a space of its own, always a token of its own, which
is taken off. Texts with two spaces in a row are taken whole.

Defined cases: a null or empty text, or one whose A or B tokens do not have the bytes of space + text, has
no tokens: zeros and an empty string. Rows with equal doc_id are documents of their own. A document's tokens
must fit in a task's memory, at any length. An empty table gives no rows. Extra columns are not carried.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm.byte_ids import UnitIds
from wearline.llm.pieces import Growing, PieceMemory, Ragged
from wearline.llm.text import slices
from wearline.session import stage

MEMORY = 500_000
BUCKETS = 64
RUN_LINKS = 1 << 20
RUN_DOCS = 1 << 13
FRAME_PAIRS = 1 << 16
FAN = 64
PLACE_BITS = 20  # RUN_DOCS is far below
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


# --- aligning pieces -------------------------------------------------------------------------


class Aligner:
    """Alignment of whole texts from that of their pieces; one per Python worker."""

    def __init__(self, path_a: str, path_b: str, memory: int = MEMORY):
        self.a = UnitIds(path_a, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(size))
        ]
        self.space = self.b.piece_to_id("▁")
        self.width = len(self.a.lengths)
        if size * self.width >= 1 << 32:
            raise ValueError("pairs of these vocabularies do not fit 32 bits")
        self.memory = PieceMemory(self._learn, self._forget, memory, double=True)

    def _forget(self) -> None:
        self.a.forget()
        self.groups: list[bytes | None] = []
        self.sizes = [Growing(np.int64) for _ in range(3)]
        self.links = Ragged(np.int64)

    def _b_ids(self, pieces: list[str]) -> list[list[int]]:
        found = self.b.encode([p[1:] if p[:1] == " " else p for p in pieces], num_threads=1)
        for n, p in enumerate(pieces):
            if p == " ":
                found[n] = [self.space]
            elif p[:1] != " ":
                found[n] = found[n][1:] if found[n][:1] == [self.space] else []
        return found

    def _learn(self, pieces: list[str]) -> None:
        counts, flat = self.a.of(pieces)
        ends = np.cumsum(counts).tolist()
        flat, lengths = flat.tolist(), self.a.lengths[flat].tolist()
        sizes, links, per_piece, at = [], [], [], 0
        for piece, b_ids, end in zip(pieces, self._b_ids(pieces), ends):
            a_ids, a_lengths = flat[at:end], lengths[at:end]
            at = end
            parts, own = self._align(piece.encode(), a_ids, a_lengths, b_ids)
            self.groups.append(parts)
            sizes.append((len(a_ids), len(b_ids), len(own)))
            links += own
            per_piece.append(len(own))
        for column, values in zip(self.sizes, np.array(sizes, np.int64).T):
            column.extend(values)
        self.links.extend(np.array(per_piece, np.int64), np.array(links, np.int64))

    def _align(self, data: bytes, a_ids: list[int], a_lengths: list[int], b_ids: list[int]) -> tuple[bytes | None, list[int]]:
        """Groups as text and linked pairs; None for tokens of other bytes."""
        if sum(a_lengths) != len(data) or b"".join([self.b_bytes[i] for i in b_ids]) != data:
            return None, []
        a_ends = accumulate(a_lengths)
        b_at = list(accumulate([len(self.b_bytes[i]) for i in b_ids]))
        parts, links, first_a, first_b, j = [], [], 0, 0, 0
        for i, end in enumerate(a_ends):
            while j < len(b_at) and b_at[j] < end:
                j += 1
            if j < len(b_at) and b_at[j] == end:
                parts.append(f"{','.join(map(str, a_ids[first_a : i + 1]))}|{','.join(map(str, b_ids[first_b : j + 1]))}")
                links.append(b_ids[j] * self.width + a_ids[i])
                first_a, first_b = i + 1, j + 1
        return ";".join(parts).encode(), links

    def align(self, texts: list[str | None]) -> list[tuple[int, int, int, str, np.ndarray] | None]:
        """For each text its token and group counts, its groups' SHA-256 and its links' pairs; None without tokens."""
        numbers = iter(self.memory.numbers([" " + t for t in texts if t]))
        found = []
        for text in texts:
            at = next(numbers) if text else None
            parts = None if at is None else [self.groups[n] for n in at.tolist()]
            if parts is None or None in parts:
                found.append(None)
                continue
            n_a, n_b, n_groups = (int(c.data[at].sum()) for c in self.sizes)
            whole = b";".join([p for p in parts if p])
            found.append((n_a, n_b, n_groups, hashlib.sha256(whole).hexdigest(), self.links.rows(at)))
        return found


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


# --- runs ------------------------------------------------------------------------------------


def _packed(*arrays: np.ndarray) -> bytes:
    body = b"".join([struct.pack("<B", len(arrays)), *(struct.pack("<cBI", a.dtype.kind.encode(), a.dtype.itemsize, len(a)) for a in arrays), *(a.tobytes() for a in arrays)])
    return zstandard.compress(body, 1)


def _unpacked(frame: bytes) -> list[np.ndarray]:
    body = zstandard.decompress(frame)
    kinds = [struct.unpack_from("<cBI", body, 1 + 6 * k) for k in range(body[0])]
    at, found = 1 + 6 * len(kinds), []
    for kind, size, n in kinds:
        found.append(np.frombuffer(body, f"<{kind.decode()}{size}", n, at))
        at += size * n
    return found


def _steps(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=0).astype(np.uint32)


def frames_of(keys: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A sorted run of pairs as frames of FRAME_PAIRS."""
    return [_packed(_steps(keys[at : at + FRAME_PAIRS]), counts[at : at + FRAME_PAIRS]) for at in range(0, len(keys), FRAME_PAIRS)]


def _run_of(frames: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for frame in frames:
        steps, counts = _unpacked(frame)
        yield np.cumsum(steps, dtype=np.int64), counts.astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    opens = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[opens], np.add.reduceat(counts, opens) if len(opens) else counts


def merge_runs(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted pairs of all runs with their counts added up, in pieces.

    The heap holds the last pair of each run's current frame. All pairs up to the smallest of them are
    in current frames, so they can be added up and given out; the run at the top then reads on.
    """
    readers = [_run_of(r) for r in runs]
    current, heap = {}, []

    def read_on(n: int) -> None:
        block = next(readers[n], None)
        if block is None:
            current.pop(n, None)
        else:
            current[n] = block
            heapq.heappush(heap, (int(block[0][-1]), n))

    for n in range(len(runs)):
        read_on(n)
    while heap:
        last = heap[0][0]
        done = [n for n, (keys, _) in current.items() if keys[-1] <= last]
        parts = []
        for n, (keys, counts) in list(current.items()):
            cut = int(np.searchsorted(keys, last, "right"))
            if cut:
                parts.append((keys[:cut], counts[:cut]))
                current[n] = (keys[cut:], counts[cut:])
        while heap and heap[0][0] <= last:
            heapq.heappop(heap)
        for n in done:
            read_on(n)
        yield _summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def _merged_frames(runs: list[list[bytes]]) -> list[bytes]:
    frames, keys, counts, held = [], [], [], 0
    for k, c in merge_runs(runs):
        keys.append(k)
        counts.append(c)
        held += len(k)
        if held >= FRAME_PAIRS:
            frames += frames_of(np.concatenate(keys), np.concatenate(counts))
            keys, counts, held = [], [], 0
    return frames + (frames_of(np.concatenate(keys), np.concatenate(counts)) if held else [])


def _records_of(composite: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unique (pair, place) records of a sorted column: pairs, records per pair, places, links per record."""
    opens = np.flatnonzero(np.diff(composite, prepend=-1))
    links = np.diff(np.append(opens, len(composite)))
    pair, place = composite[opens] >> PLACE_BITS, composite[opens] & ((1 << PLACE_BITS) - 1)
    heads = np.flatnonzero(np.diff(pair, prepend=-1))
    return pair[heads], np.diff(np.append(heads, len(pair))), place, links


STAGED = "run long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, bucket int, pairs array<binary>, records binary"
ARROW = pa.schema(
    [("run", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string()),
     ("bucket", pa.int32()), ("pairs", pa.list_(pa.binary())), ("records", pa.binary())]
)


def _run_rows(run: int, docs: list[tuple], links: list[np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
    n = len(docs)
    columns = [*zip(*docs)]
    yield pa.record_batch(
        [pa.array([run] * n, pa.int64()), pa.array(range(n), pa.int32()), *(pa.array(c, t) for c, t in zip(columns, [f.type for f in ARROW][2:8])),
         pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.binary())), pa.nulls(n, pa.binary())], schema=ARROW,
    )
    pairs = np.concatenate(links)
    if not len(pairs):
        return
    place = np.repeat(np.arange(n), [len(own) for own in links])
    bucket = pairs // width % BUCKETS
    composite = np.sort(bucket << 32 + PLACE_BITS | pairs << PLACE_BITS | place)
    edges = np.searchsorted(composite, np.arange(BUCKETS + 1) << 32 + PLACE_BITS)
    rows = []
    for b in np.flatnonzero(np.diff(edges)):
        pair, records, places, number = _records_of(composite[edges[b] : edges[b + 1]] - (int(b) << 32 + PLACE_BITS))
        counts = np.add.reduceat(number, np.cumsum(records) - records)
        rows.append((int(b), frames_of(pair, counts), _packed(_steps(pair), records.astype(np.uint32), places.astype(np.uint32), number.astype(np.uint32))))
    n = len(rows)
    numbers, frames, records = zip(*rows)
    yield pa.record_batch(
        [pa.array([run] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), *(pa.nulls(n, pa.int64()) for _ in COUNTS), pa.nulls(n, pa.string()),
         pa.array(numbers, pa.int32()), pa.array(frames, pa.list_(pa.binary())), pa.array(records, pa.binary())], schema=ARROW,
    )


def _runs(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents and the bucketed runs of their links, as rows of two kinds (`bucket` is null for documents)."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, first, number = _aligner(path_a, path_b), TaskContext.get().partitionId() << 24, 0
        rows, links, held = [], [], 0
        for batch in slices(batches, 256):
            for doc_id, found in zip(batch["doc_id"].to_pylist(), aligner.align(batch["text"].to_pylist())):
                if rows and (held >= RUN_LINKS or len(rows) >= RUN_DOCS):
                    yield from _run_rows(first + number, rows, links, aligner.width)
                    rows, links, held, number = [], [], 0, number + 1
                n_a, n_b, n_groups, digest, own = found or (0, 0, 0, "", np.zeros(0, np.int64))
                rows.append((doc_id, n_a, n_b, n_groups, len(own), digest))
                links.append(own)
                held += len(own)
        if rows:
            yield from _run_rows(first + number, rows, links, aligner.width)

    return docs.mapInArrow(align, STAGED)


# --- counting and giving back ----------------------------------------------------------------


def _merge_level(runs: DataFrame, groups: int) -> DataFrame:
    def merge(table: pa.Table) -> pa.Table:
        frames = _merged_frames(table["pairs"].to_pylist())
        return pa.table({"bucket": table["bucket"][:1], "run": table["part"][:1], "pairs": pa.array([frames], pa.list_(pa.binary()))})

    parted = runs.select("bucket", F.pmod(F.xxhash64("run"), F.lit(groups)).cast("long").alias("part"), "pairs")
    return parted.groupBy("bucket", "part").applyInArrow(merge, "bucket int, run long, pairs array<binary>")


def pair_counts(runs: DataFrame, number: int) -> DataFrame:
    """(bucket, pairs): one merged run per bucket, from `number` runs."""
    while True:
        groups = -(-number // FAN)
        runs = stage(_merge_level(runs, groups), "merged")
        if groups == 1:
            return runs.select("bucket", "pairs")
        number = groups


def contributions(runs: DataFrame, counts: DataFrame, number: int, width: int) -> DataFrame:
    """(run, values): for each bucket of a run, its documents' best links and sums of counts."""
    parts = -(-number // FAN)

    def stream(table: pa.Table) -> pa.Table:
        counted = table.filter(table["records"].is_null())
        keys, totals = (np.concatenate(c) for c in zip(*_run_of(counted["pairs"].to_pylist()[0])))
        side = keys // width
        heads = np.flatnonzero(np.diff(side, prepend=-1))
        highest = np.repeat(np.maximum.reduceat(totals, heads), np.diff(np.append(heads, len(side))))
        found_runs, values = [], []
        records = table.filter(table["records"].is_valid())
        for run, frame in zip(records["run"].to_pylist(), records["records"]):
            steps, per_pair, places, links = _unpacked(frame.as_py())
            at = np.repeat(np.searchsorted(keys, np.cumsum(steps, dtype=np.int64)), per_pair)
            best, sums = (np.zeros(int(places.max()) + 1, np.int64) for _ in range(2))
            np.add.at(best, places, links * (totals[at] == highest[at]))
            np.add.at(sums, places, links * totals[at])
            found_runs.append(run)
            values.append(_packed(best, sums))
        return pa.table({"run": pa.array(found_runs, pa.int64()), "contribution": pa.array(values, pa.binary())})

    nothing = F.lit(None)
    left = runs.select("bucket", F.pmod(F.xxhash64("run"), F.lit(parts)).alias("part"), "run", nothing.cast("array<binary>").alias("pairs"), "records")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    right = counts.select("bucket", every.alias("part"), nothing.cast("long").alias("run"), "pairs", nothing.cast("binary").alias("records"))
    return left.unionByName(right).groupBy("bucket", "part").applyInArrow(stream, "run long, contribution binary")


def _added(table: pa.Table) -> pa.Table:
    """Contributions of a run's buckets, added up per document."""
    parts = [_unpacked(c) for c in table["contribution"].to_pylist()]
    size = max(len(best) for best, _ in parts)
    best, sums = (np.zeros(size, np.int64) for _ in range(2))
    for b, s in parts:
        best[: len(b)] += b
        sums[: len(s)] += s
    run = table["run"][0].as_py()
    return pa.table({"run": pa.array([run] * size, pa.int64()), "place": pa.array(range(size), pa.int32()), "n_best": best, "count_sum": sums})


def align(docs: DataFrame, vocabulary_a: str = "byte_bpe_50k.json", vocabulary_b: str = "piece_bpe_32k.model", key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    from public_tokenizers import path

    path_a, path_b = path(vocabulary_a), path(vocabulary_b)
    rows = stage(_runs(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), path_a, path_b), "aligned")
    runs, found = rows.where("bucket IS NOT NULL"), rows.where("bucket IS NULL").select("run", "place", "doc_id", *COUNTS, "groups_sha256")
    number = runs.agg(F.count_distinct("run")).first()[0]
    if not number:
        return found.select("doc_id", *COUNTS, "groups_sha256", F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    counts = pair_counts(runs.select("bucket", "run", "pairs"), number)
    given = contributions(runs.select("bucket", "run", "records"), counts, number, vocabulary_size(path_a))
    sums = given.groupBy("run").applyInArrow(_added, "run long, place int, n_best long, count_sum long")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return found.join(sums, ["run", "place"], "left").select("doc_id", *COUNTS, "groups_sha256", zero("n_best"), zero("count_sum"))


def vocabulary_size(path_a: str) -> int:
    """Number of A's ids, the factor of the B id in a pair's key."""
    return len(UnitIds(path_a, plain_specials=True).lengths)
