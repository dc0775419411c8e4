"""Benchmark decontamination by spaced-seed hashing.

Texts become tokens: lower case, ASCII punctuation dropped, split at white space. A spaced seed looks
at some positions of a short window only and ignores the rest, so that a substituted token at an
ignored position does not hide the match. The two fixed masks hit every window of OVERLAP tokens with
at most two substitutions. Seed hashes of the documents are joined to those of the benchmark; each
hit fixes an alignment of document and item, along which every window of OVERLAP tokens (or the
whole item, where it is shorter) with at least AGREEMENT equal tokens counts as an overlap. The
largest number of substitutions that AGREEMENT allows in a window is what the seeds guarantee.

The documents are read once for each block of the benchmark; a block holds about BLOCK_CHARS of item
text, so what is sent to the tasks is bounded whatever the benchmark's size. No document is shuffled
or collected. Items of 5 to 12 tokens use contiguous seeds by the pigeonhole principle.

Defined cases: items under MIN_TOKENS tokens, null or empty items and texts match nothing; repeated
items (same item_id) are all searched, and equal spans of one item in a text are reported once; repeated rows are each reported; without
benchmark rows there are no overlaps. Other columns are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wearline.llm.text import mix, slices, word_hashes

MASKS = [(0, 1, 2, 4, 6, 7), (0, 4, 7, 8, 9, 10)]
OVERLAP = 13
AGREEMENT = 0.8
MIN_TOKENS = 5
BLOCK_CHARS = 16 << 20
FILTER_BITS = 24

_BLANK = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_FACTORS = mix(np.arange(1, OVERLAP + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def tokens(text: str | None) -> np.ndarray:
    """Token hashes of a text."""
    plain = (text or "").lower().encode("utf-8", "surrogatepass").translate(_BLANK).decode("utf-8", "surrogatepass")
    return word_hashes(" ".join(plain.split()))


def allowed(length: int) -> int:
    """Substitutions that a window of `length` tokens may have."""
    return int((1 - AGREEMENT) * length + 1e-9)


def short_mask(length: int) -> tuple[int, ...]:
    """A run that stays whole in `length` tokens with the allowed substitutions."""
    subs = allowed(length)
    return tuple(range((length - subs) // (subs + 1)))


def seeds(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The seed's hash at every position where it fits."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, mask[-1] * 64 + len(mask), np.uint64)
    for k in mask:
        total += words[k : k + n] * _FACTORS[k]
    return total


class Index:
    """Benchmark seeds of one block, sorted, with a bit table in front of the search."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        wanted: dict[tuple[int, ...], list[int]] = {}
        for n, w in enumerate(self.words):
            for mask in MASKS if len(w) >= OVERLAP else [short_mask(len(w))]:
                wanted.setdefault(mask, []).append(n)
        self.masks = []
        for mask, rows in wanted.items():
            found = [seeds(self.words[n], mask) for n in rows]
            value = np.concatenate(found)
            item = np.repeat(rows, [len(f) for f in found])
            place = np.concatenate([np.arange(len(f)) for f in found])
            order = np.argsort(value, kind="stable")
            bits = min(FILTER_BITS, 9 + int(len(value)).bit_length())
            table = np.zeros(1 << bits, bool)
            shift = np.uint64(64 - bits)
            table[(value >> shift).astype(np.int64)] = True
            self.masks.append((mask, value[order], item[order], place[order], table, shift))

    def overlaps(self, words: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item_id, first token, token after the last, equal tokens) of each overlap with `words`."""
        aligned: set[tuple[int, int]] = set()
        for mask, value, item, place, table, shift in self.masks:
            own = seeds(words, mask)
            at = np.flatnonzero(table[(own >> shift).view(np.int64)])
            if not len(at):
                continue
            low, high = np.searchsorted(value, own[at], "left"), np.searchsorted(value, own[at], "right")
            count = high - low
            if not count.any():
                continue
            pick = np.repeat(low - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
            diagonal = np.repeat(at, count) - place[pick]
            aligned.update(map(tuple, np.unique(np.stack([item[pick], diagonal], 1), axis=0).tolist()))
        found: dict[tuple[int, int], int] = {}
        spans = []
        for n, diagonal in sorted(aligned):
            spans += self._along(words, n, diagonal)
        for item, start, end, equal in spans:
            found[item, start, end] = max(equal, found.get((item, start, end), 0))
        return [(*k, v) for k, v in sorted(found.items())]

    def _along(self, words: np.ndarray, n: int, diagonal: int) -> list[tuple[int, int, int, int]]:
        item = self.words[n]
        window = min(OVERLAP, len(item))
        start, end = max(diagonal, 0), min(diagonal + len(item), len(words))
        if end - start < window:
            return []
        equal = words[start:end] == item[start - diagonal : end - diagonal]
        sums = np.append(0, np.cumsum(equal))
        good = np.flatnonzero(sums[window:] - sums[:-window] >= window - allowed(window))
        if not len(good):
            return []
        # Windows that touch or overlap are one span.
        cut = np.flatnonzero(np.diff(good) > window)
        first, last = good[np.append(0, cut + 1)], good[np.append(cut, len(good) - 1)] + window
        return [(self.ids[n], int(start + a), int(start + b), int(sums[b] - sums[a])) for a, b in zip(first, last)]


def _blocks(benchmark: DataFrame, item: str, text: str) -> list[list[tuple[int, np.ndarray]]]:
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(item).alias("item"), F.col(text).alias("text"))
    chars = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    count = max(1, -(-chars // BLOCK_CHARS))
    for b in range(count):
        block = rows if count == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == b)
        got = [(r["item"], tokens(r["text"])) for r in block.orderBy("item", "text").toLocalIterator()]
        yield [(i, w) for i, w in got if len(w) >= MIN_TOKENS]


def benchmark_overlaps(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(key, item_id, __hash, start, end, equal): each overlap, in tokens of the document; __hash is xxhash64(text)."""
    rows = docs.select(F.col(key).alias("__id"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__text"))
    kind = docs.schema[key].dataType.simpleString()
    item_kind = benchmark.schema[item].dataType.simpleString()
    context = docs.sparkSession.sparkContext

    def search(sent):
        def run(batches):
            index = Index(sent.value)
            for batch in slices(batches):
                found = [index.overlaps(tokens(t)) for t in batch.column("__text").to_pylist()]
                source = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
                flat = [x for f in found for x in f]
                columns = [pa.array([x[k] for x in flat], pa.int64()) for k in range(1, 4)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__id").take(source), batch.column("__hash").take(source), pa.array([x[0] for x in flat], item_type), *columns],
                    ["__id", "__hash", item, "start", "end", "equal"],
                )

        return run

    item_type = to_arrow_type(benchmark.schema[item].dataType)
    schema = f"__id {kind}, __hash long, `{item}` {item_kind}, start long, end long, equal long"
    out = None
    for block in _blocks(benchmark, item, item_text):
        part = rows.mapInArrow(search(context.broadcast(block)), schema)
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("__id").alias(key), "__hash", item, "start", "end", "equal")
