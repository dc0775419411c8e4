"""Word and shingle hashes of texts, as numpy arrays inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PORTION_BYTES = 6 << 20
CHUNK_BYTES = 1 << 16
BASE = 0x9E3779B97F4A7C15 | 1
SHINGLE_WORDS = 5
_STEPS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    ups, downs = np.full(n, BASE, np.uint64), np.full(n, inverse, np.uint64)
    ups[0] = downs[0] = 1
    return np.multiply.accumulate(ups), np.multiply.accumulate(downs)


def _chunks(data: bytes) -> Iterator[bytes]:
    """Pieces of about CHUNK_BYTES that end at a space; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > CHUNK_BYTES:
            end = data.rfind(b" ", at, at + CHUNK_BYTES)
            if end < 0:
                end = data.find(b" ", at + CHUNK_BYTES)
                end = len(data) if end < 0 else end
        yield data[at:end]
        at = end + 1


def normalised(text: str | None) -> str:
    """Lower case, single spaces."""
    return " ".join((text or "").lower().split())


def word_hashes(normal: str) -> np.ndarray:
    """A 64-bit hash for each space-separated word of a normalised text."""
    found = []
    for piece in _chunks(normal.encode("utf-8", "surrogatepass")):
        b = np.frombuffer(piece, np.uint8)
        size = max(CHUNK_BYTES, 1 << len(b).bit_length()) + 1
        ups, downs = _powers(size)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * ups[: len(b)], out=sums[1:])
        ends = np.append(np.flatnonzero(b == 32), len(b))
        starts = np.append(0, ends[:-1] + 1)
        found.append(mix((sums[ends] - sums[starts]) * downs[starts]))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_hashes(words: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all runs of n words; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return words
    n = min(n, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total += words[k : len(words) - n + 1 + k] * _STEPS[k % 5] + np.uint64(k // 5)
        total ^= total >> np.uint64(29)
    return mix(total)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, which bounds what a task holds as Python objects.

    When all are read, Arrow's unused memory goes back to the system: the worker stays for other tasks.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def portions(batches: Iterator[pa.RecordBatch], text: str, limit: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have about `limit` bytes, at most one text more; see `slices`."""
    for batch in slices(batches, 4096):
        number = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(), dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            yield batch.slice(low, high - low)
