"""Removal of byte passages that already stand in a document with a smaller id.

Equal strings of LENGTH bytes are found by the Burrows-Wheeler transform of a collection, built
column by column: each round inserts one more symbol of every string, from the end to the front, and
updates the transform and the array of common prefixes in one sequential pass (`build`). Whole
documents would need as many rounds as the longest has bytes, so the collection consists of short
pieces. Every window of LENGTH bytes has an anchor, the smallest hash of its ANCHOR-byte substrings;
consecutive windows with the same anchor are one piece (at most RUN windows). Equal windows have equal
anchors, so pieces are dealt out by anchor and each shard's collection is built alone, as arrays in
the task's memory that each round rewrites in order.

Steps, over documents that are written once with a block number (a part of one task's rows):
1. each block's distinct anchors are dealt out by hash; anchors of two blocks or documents go on;
2. each block's distinct pieces with such anchors, with their smallest and largest doc_id, are dealt
   out by anchor; each shard builds its collections and answers, per piece, the smallest doc_id of
   every window that stands in several documents;
3. each block marks and cuts the bytes of its documents.
A hot passage is one entry per block, whatever the number of documents that hold it.

Defined cases: a null text is empty; texts under LENGTH bytes lose nothing; a null id is smaller than
all others; rows with equal ids do not see each other; empty tables give no rows. ids are integers.
Other columns are not used.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm.text import BASE, _powers, mix, slices
from wearline.llm.warc import file_system
from wearline.session import fresh_path, stage

LENGTH = 50
ANCHOR = 20
RUN = 32
CHUNK = 1 << 18
GROUP_BYTES = 1 << 16
BLOCK_BYTES = 8 << 20
BUCKET_ANCHORS = 500_000
SHARD_PIECES = 30_000
LOT_STRINGS = 4_000
WIDTH = LENGTH + RUN - 1
NULL_ID = -(1 << 63)


# --- pieces ----------------------------------------------------------------------------------


def pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor, hash) of the pieces of a text, together covering every window once."""
    found = []
    for at in range(0, max(len(data) - LENGTH + 1, 0), CHUNK):
        part = data[at : at + CHUNK + LENGTH - 1]
        start, *rest = _pieces(part, np.array([len(part)]))
        found.append((start + at, *rest))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def with_pieces(documents: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, tuple]]:
    """(id, data, pieces) of documents; short ones are looked at together, GROUP_BYTES at a time."""
    group, held = [], 0
    for row in itertools.chain(documents, [None]):
        if group and (row is None or held + len(row[1]) > GROUP_BYTES):
            yield from _pieces_of(group)
            group, held = [], 0
        if row is not None and len(row[1]) > GROUP_BYTES:
            yield *row, pieces(row[1])
        elif row is not None:
            group.append(row)
            held += len(row[1])


def _pieces_of(group: list[tuple[int, np.ndarray]]):
    lengths = np.array([len(data) for _, data in group])
    ends = np.cumsum(lengths)
    start, *rest = _pieces(np.concatenate([data for _, data in group]), lengths)
    cuts = np.searchsorted(start, ends)
    for n, (key, data) in enumerate(group):
        own = slice(cuts[n - 1] if n else 0, cuts[n])
        yield key, data, (start[own] - (ends[n] - lengths[n]), *(x[own] for x in rest))


def _pieces(b: np.ndarray, lengths: np.ndarray):
    """Pieces of texts of these lengths that stand one after the other in `b`; no window spans two of them."""
    windows = np.maximum(lengths - LENGTH + 1, 0)
    if not windows.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    ups, downs = _powers(CHUNK + LENGTH + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    powers = b.astype(np.uint64)
    powers += np.uint64(1)
    powers *= ups[: len(b)]
    np.cumsum(powers, out=sums[1:])
    low = sums[ANCHOR:] - sums[:-ANCHOR]
    low *= downs[: len(b) - ANCHOR + 1]
    low = mix(low)
    # Smallest of the LENGTH - ANCHOR + 1 hashes from each place on, by doubling.
    width, need = 1, LENGTH - ANCHOR + 1
    while width * 2 <= need:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < need:
        low = np.minimum(low[: len(low) - (need - width)], low[need - width :])
    first = np.cumsum(windows) - windows  # of each text, among all windows
    place = np.arange(windows.sum()) + np.repeat(np.cumsum(lengths) - lengths - first, windows)
    low = low[place]
    new = np.append(True, low[1:] != low[:-1])
    new[first[windows > 0]] = True
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(low)))
    if count.max() > RUN:  # periodic text: cut long runs
        parts = -(-count // RUN)
        run = np.repeat(start, parts)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
        left = np.repeat(count, parts) - nth * RUN
        start, count = run + nth * RUN, np.minimum(left, RUN)
    anchor, start = low[start], place[start]
    end = start + count + LENGTH - 1
    value = mix((sums[end] - sums[start]) * downs[start] + count.astype(np.uint64) * np.uint64(BASE))
    return start, count, anchor, value


# --- the collection --------------------------------------------------------------------------


def _range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low .. high]) for many ranges, by tables of doubling width."""
    out = np.empty(len(low), values.dtype)
    level = (np.frexp((high - low + 1).astype(float))[1] - 1).astype(np.uint8)
    order = np.argsort(level, kind="stable")
    ends = np.cumsum(np.bincount(level))
    low, last = low[order], high[order] + 1 - (1 << level[order].astype(np.int64))
    table, begin = values, 0
    for k, end in enumerate(ends.tolist()):
        if k:
            table = np.minimum(table[: -(1 << (k - 1))], table[1 << (k - 1) :])
        if end > begin:
            out[order[begin:end]] = np.minimum(table[low[begin:end]], table[last[begin:end]])
        begin = end
    return out


def _by_symbol(transform: np.ndarray) -> tuple[np.ndarray, np.integer]:
    """Sorted (symbol, row) pairs, each as one number with the row in the low bits, and those bits."""
    kind, bits = (np.uint32, 23) if len(transform) < 1 << 23 else (np.uint64, 40)
    keys = transform.astype(kind)
    keys <<= kind(bits)
    keys |= np.arange(len(transform), dtype=kind)
    keys.sort()
    return keys, kind(bits)


def build(texts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transform and common prefixes of a collection of right-aligned rows (symbols from 1 up).

    Row i of the result is the i-th smallest suffix; the empty suffixes come first, in the order of
    the strings. transform[i] is the symbol before it (0 before a whole string), common[i] the length
    of the prefix it shares with the suffix above.
    """
    m, width = texts.shape
    columns = np.ascontiguousarray(texts.T)
    transform = columns[-1]
    both = transform.astype(np.uint32) << np.uint32(8)  # the symbol, and the common prefix in the low byte
    place = np.arange(m)  # rows of the suffixes inserted last, from the top
    live = np.arange(m)  # their strings
    for j in range(1, int(lengths.max()) + 1):
        transform, common = both >> np.uint32(8), both.astype(np.uint8)
        keys, bits = _by_symbol(transform)
        low = (keys.dtype.type(1) << bits) - keys.dtype.type(1)
        finished = len(transform) - np.count_nonzero(transform)
        # Places rise, so that a stable sort by the symbol alone, by its bytes, sorts the pairs.
        symbol = transform[place].astype(texts.dtype)
        going = np.argsort(symbol, kind="stable")
        place, live = place[going], live[going]
        own = symbol[going].astype(keys.dtype) << bits | place.astype(keys.dtype)
        k = np.searchsorted(keys, own)
        rows = m - finished + k
        # The suffix above starts with the same symbol if the pair before has it: then both share that
        # symbol and what the suffixes after it share. The same holds for the suffix below.
        before, after = keys[np.maximum(k - 1, 0)], keys[np.minimum(k + 1, len(keys) - 1)]
        up = np.flatnonzero((k > 0) & (before ^ own <= low))
        down = np.flatnonzero((k + 1 < len(keys)) & (after ^ own <= low))
        above, below = np.zeros(len(k), np.uint8), np.zeros(len(k), np.uint8)
        least = _range_minima(
            common,
            np.concatenate([(before[up] & low).astype(np.int64), place[down]]) + 1,
            np.concatenate([place[up], (after[down] & low).astype(np.int64)]),
        )
        above[up], below[down] = np.split(1 + least, [len(up)])
        total = len(both) + len(rows)
        old = np.ones(total, bool)
        old[rows] = False
        more = lengths[live] > j
        following = np.where(more, columns[width - 1 - j][live] if j < width else 0, 0)
        merged = np.empty(total, np.uint32)
        merged[old] = both
        inside = len(rows) - int(rows[-1] + 1 == total) if len(rows) else 0
        under = rows[:inside] + 1
        merged[under] = merged[under] & ~np.uint32(255) | below[:inside]
        merged[rows] = following.astype(np.uint32) << np.uint32(8) | above
        both = merged
        place, live = rows[more], live[more]
    return (both >> np.uint32(8)).astype(texts.dtype), both.astype(np.uint8)


def suffix_rows(transform: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of the collection its string and suffix length, by walking from the ends."""
    m = len(lengths)
    order = np.argsort(transform, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    finished = int(np.count_nonzero(transform == 0))
    string, length = np.empty(len(order), np.int32), np.zeros(len(order), np.int16)
    row, live = np.arange(m), np.arange(m)
    string[row] = live
    for j in range(1, int(lengths.max()) + 1):
        keep = lengths[live] >= j
        row, live = m + rank[row[keep]] - finished, live[keep]
        string[row], length[row] = live, j
    return string, length


def shared_windows(strings: np.ndarray, lengths: np.ndarray, low: np.ndarray, high: np.ndarray, size: int = LENGTH):
    """(string, offset, smallest id) of the windows of `size` symbols that several ids hold.

    strings: right-aligned bytes, one row each; low and high: smallest and largest id holding it.
    """
    used = np.bincount(strings.ravel(), minlength=256) > 0
    codes = np.cumsum(used).astype(np.uint8 if np.count_nonzero(used) < 256 else np.uint16)
    transform, common = build(codes[strings], lengths)
    string, length = suffix_rows(transform, lengths)
    rows = np.flatnonzero(length >= size)
    # Suffixes between two equal windows hold that window too, so groups are runs of rows.
    starts = np.flatnonzero(common[rows] < size)
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    smallest, largest = np.minimum.reduceat(low[string[rows]], starts), np.maximum.reduceat(high[string[rows]], starts)
    group = np.cumsum(np.bincount(starts, minlength=len(rows))) - 1
    several = (smallest < largest)[group]
    rows, group = rows[several], group[several]
    return string[rows].astype(np.int64), lengths[string[rows]] - length[rows], smallest[group]


# --- steps -----------------------------------------------------------------------------------


def with_blocks(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Written (__block, __id, __data): the texts as bytes with the number of their block."""
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("__id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__data"))

    def number(batches):
        block, held = TaskContext.get().partitionId() << 20, 0
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([block] * batch.num_rows, pa.int64()), *batch.columns], ["__block", "__id", "__data"])
            held += batch.column(1).nbytes
            if held >= BLOCK_BYTES:
                block, held = block + 1, 0

    return stage(rows.mapInArrow(number, "__block long, __id long, __data binary"), "blocks")


def _by_block(batches) -> Iterator[tuple[int, Iterator[tuple[int, np.ndarray]]]]:
    """Runs of rows with the same block number."""
    rows = ((b, i, np.frombuffer(d.as_buffer(), np.uint8)) for batch in slices(batches, 64) for b, i, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)))
    row = next(rows, None)
    while row is not None:
        block = row[0]

        def same():
            nonlocal row
            while row is not None and row[0] == block:
                yield row[1], row[2]
                row = next(rows, None)

        yield block, same()
        while row is not None and row[0] == block:
            row = next(rows, None)


def _block_anchors(buckets: int):
    def run(batches):
        for block, documents in _by_block(batches):
            own, ids = [], []
            for key, _, (_, _, anchor, _) in with_pieces(documents):
                anchors = np.unique(anchor)
                own.append(anchors)
                ids.append(np.full(len(anchors), key))
            if not own:
                continue
            anchors, ids = np.concatenate(own), np.concatenate(ids)
            order = np.lexsort((ids, anchors))
            anchors, ids = anchors[order], ids[order]
            first = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1])) if len(anchors) else np.zeros(0, np.int64)
            last = np.append(first[1:], len(anchors)) - 1
            several = (ids[first] != ids[last]).astype(np.uint8) if len(first) else np.zeros(0, np.uint8)
            anchors = anchors[first]
            yield from _dealt(anchors, buckets, [("block", block)], [anchors, several])

    return run


def _dealt(anchors: np.ndarray, parts: int, fixed: list, arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row per part: part, fixed values, the part's slice of each array as bytes.

    Anchors are minima of hashes and crowd at 0, so their range is mixed before it is cut.
    """
    if not len(anchors):
        return
    part = ((mix(anchors + np.uint64(BASE)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)):
        at = order[cuts[p] : cuts[p + 1]]
        values = [pa.array([x[at].tobytes()], pa.binary()) for x in arrays]
        names = ["part", *(n for n, _ in fixed), *(f"a{i}" for i in range(len(arrays)))]
        yield pa.RecordBatch.from_arrays([pa.array([int(p)]), *(pa.array([v], pa.int64()) for _, v in fixed), *values], names)


def _repeated(table: pa.Table) -> pa.Table:
    """Of one bucket: each block's anchors that another block or several of its documents hold."""
    blocks = table["block"].to_pylist()
    each = [np.frombuffer(x, np.uint64) for x in table["a0"].to_pylist()]
    several = np.concatenate([np.frombuffer(x, np.uint8) for x in table["a1"].to_pylist()])
    values, inverse, count = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
    keep = (count[inverse] > 1) | (several > 0)
    at, out = 0, []
    for anchors in each:
        out.append(anchors[keep[at : at + len(anchors)]])
        at += len(anchors)
    return pa.table({"block": pa.array(blocks, pa.int64()), "n": pa.array([len(x) for x in out], pa.int64()), "anchors": pa.array([x.tobytes() for x in out], pa.binary())})


def _by_block_files(rows: DataFrame, name: str) -> str:
    """Write rows so that a task can read those of one block; returns the folder."""
    path = fresh_path(rows.sparkSession, name)
    rows.repartition("block").write.partitionBy("block").parquet(path)
    return path


def _read_block(path: str, block: int) -> pa.Table | None:
    store, root = file_system(path)
    folder = f"{root}/block={block}"
    if store.get_file_info(folder).type != pa.fs.FileType.Directory:
        return None
    names = sorted(f.path for f in store.get_file_info(pa.fs.FileSelector(folder)) if f.path.endswith(".parquet"))
    return pa.concat_tables([pq.read_table(n, filesystem=store, partitioning=None) for n in names]) if names else None


def _anchors_of(path: str, block: int) -> np.ndarray:
    table = _read_block(path, block)
    found = [np.frombuffer(x, np.uint64) for x in table["anchors"].to_pylist()] if table else []
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def right_aligned(data: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows of WIDTH bytes that end with the `size` bytes before each `end`, after zeros."""
    rows = np.lib.stride_tricks.sliding_window_view(np.append(np.zeros(WIDTH, np.uint8), data), WIDTH)[end]
    rows *= np.arange(WIDTH) >= WIDTH - size[:, None]
    return rows


def _block_pieces(path: str, parts: int):
    def run(batches):
        for block, documents in _by_block(batches):
            repeated = _anchors_of(path, block)
            if not len(repeated):
                continue
            kept = []
            for key, data, (start, count, anchor, value) in with_pieces(documents):
                at = np.flatnonzero(_in_sorted(anchor, repeated))
                if not len(at):
                    continue
                value, first = np.unique(value[at], return_index=True)
                at = at[first]
                size = count[at] + LENGTH - 1
                kept.append((value, anchor[at], size.astype(np.uint8), right_aligned(data, start[at] + size, size), np.full(len(at), key)))
            if not kept:
                continue
            value, anchor, size, rows, ids = (np.concatenate(x) for x in zip(*kept))
            order = np.lexsort((ids, value))
            value, ids = value[order], ids[order]
            first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            last = np.append(first[1:], len(value)) - 1
            pick = order[first]
            yield from _dealt(anchor[pick], parts, [("block", block)], [value[first], anchor[pick], size[pick], rows[pick], ids[first], ids[last]])

    return run


def _answers(table: pa.Table) -> pa.Table:
    """Of one shard: for each block's pieces, runs of windows that several documents hold, with the smallest id."""
    kinds = [np.uint64, np.uint64, np.uint8, np.uint8, np.int64, np.int64]
    value, anchor, size, rows, low, high = (
        np.concatenate([np.frombuffer(x, kind) for x in table[f"a{i}"].to_pylist()]) for i, kind in enumerate(kinds)
    )
    blocks = np.repeat(table["block"].to_numpy(), [len(x) // 8 for x in table["a0"].to_pylist()])
    rows = rows.reshape(-1, WIDTH)
    # Equal pieces of several blocks are one string, compared by all their bytes.
    full = np.ascontiguousarray(np.concatenate([rows, size[:, None]], 1)).view(f"V{WIDTH + 1}").ravel()
    _, first, string = np.unique(full, return_index=True, return_inverse=True)
    smallest, largest = np.full(len(first), np.iinfo(np.int64).max), np.full(len(first), np.iinfo(np.int64).min)
    np.minimum.at(smallest, string, low)
    np.maximum.at(largest, string, high)
    found = [x for lot in _lots(anchor[first], size[first]) for x in [_lot(lot, rows[first], size[first].astype(np.int64), smallest, largest)]]
    strings, begins, ends, ids = (np.concatenate(x) for x in zip(*found))
    # From strings back to the pieces of each block.
    order = np.argsort(strings, kind="stable")
    strings, begins, ends, ids = strings[order], begins[order], ends[order], ids[order]
    low_at, high_at = np.searchsorted(strings, string), np.searchsorted(strings, string, "right")
    count = high_at - low_at
    pick = np.repeat(low_at - (np.cumsum(count) - count), count) + np.arange(count.sum())
    owner = np.repeat(np.arange(len(string)), count)
    # A run that no document of the block can lose (its largest id is the smallest of all) is left out.
    useful = ids[pick] < high[owner]
    pick, owner = pick[useful], owner[useful]
    out = {"block": [], "value": [], "begin": [], "end": [], "id": []}
    for block in np.unique(blocks[owner]):
        at = blocks[owner] == block
        out["block"].append(int(block))
        for name, x in (("value", value[owner[at]]), ("begin", begins[pick[at]]), ("end", ends[pick[at]]), ("id", ids[pick[at]])):
            out[name].append(x.tobytes())
    return pa.table({k: pa.array(v, pa.int64() if k == "block" else pa.binary()) for k, v in out.items()})


def _lots(anchor: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Strings in lots of about LOT_STRINGS, each with all strings of its anchors: one collection each.

    A collection takes as many rounds as its longest string has symbols, and each round passes over all of
    it, so anchors whose longest strings are alike come together.
    """
    _, group = np.unique(anchor, return_inverse=True)
    longest = np.zeros(len(anchor), size.dtype)
    np.maximum.at(longest, group, size)
    order = np.lexsort((group, longest[group]))
    group = group[order]
    last = np.append(np.flatnonzero(group[1:] != group[:-1]), len(group) - 1)  # of each anchor's strings
    at = 0
    while at < len(order):
        end = min(at + LOT_STRINGS, len(order))
        end = int(last[np.searchsorted(last, end - 1)]) + 1
        yield order[at:end]
        at = end


def _lot(lot, rows, size, smallest, largest):
    string, offset, least = shared_windows(rows[lot], size[lot], smallest[lot], largest[lot])
    order = np.lexsort((offset, string))
    string, offset, least = string[order], offset[order], least[order]
    if not len(string):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.int64)
    start = np.flatnonzero(np.append(True, (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1) | (least[1:] != least[:-1])))
    stop = np.append(start[1:], len(string)) - 1
    return lot[string[start]], offset[start].astype(np.uint8), offset[stop].astype(np.uint8), least[start]


def _cut(anchors: str, answers: str):
    def run(batches):
        for block, documents in _by_block(batches):
            repeated = _anchors_of(anchors, block)
            table = _read_block(answers, block)
            kinds = {"value": np.uint64, "begin": np.uint8, "end": np.uint8, "id": np.int64}
            got = {n: np.concatenate([np.frombuffer(x, k) for x in table[n].to_pylist()]) if table else np.zeros(0, k) for n, k in kinds.items()}
            order = np.argsort(got["value"], kind="stable")
            value, begin, end, least = (got[n][order] for n in kinds)
            out = [[] for _ in range(6)]
            for key, data, (start, _, anchor, own) in with_pieces(documents):
                removed = np.zeros(len(data), bool)
                spans = 0
                if len(value):
                    at = np.flatnonzero(_in_sorted(anchor, repeated))
                    first, last = np.searchsorted(value, own[at]), np.searchsorted(value, own[at], "right")
                    count = last - first
                    pick = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
                    base = np.repeat(start[at], count)
                    late = least[pick] < key
                    steps = np.zeros(len(data) + 1, np.int64)
                    np.add.at(steps, base[late] + begin[pick][late], 1)
                    np.add.at(steps, base[late] + end[pick][late] + LENGTH, -1)
                    removed = np.cumsum(steps[:-1]) > 0
                    spans = int(np.count_nonzero(removed & ~np.append(False, removed[:-1]))) if len(data) else 0
                kept = data[~removed].tobytes()
                for column, x in zip(out, (None if key == NULL_ID else key, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(x)
                if len(out[0]) == 256:
                    yield _rows(out)
                    out = [[] for _ in range(6)]
            if out[0]:
                yield _rows(out)

    return run


def _rows(out) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, kept): kept is what is left, as bytes."""
    rows = with_blocks(docs, text, key)
    # About one anchor for (LENGTH - ANCHOR + 2) / 2 bytes.
    size = rows.agg(F.sum(F.length("__data")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-size // (BUCKET_ANCHORS * (LENGTH - ANCHOR + 2) // 2)))
    dealt = rows.mapInArrow(_block_anchors(buckets), "part long, block long, a0 binary, a1 binary")
    repeated = stage(dealt.groupBy("part").applyInArrow(_repeated, "block long, n long, anchors binary").where("n > 0"), "anchors")
    parts = max(1, -(-(repeated.agg(F.sum("n").alias("n")).first()["n"] or 0) // SHARD_PIECES))
    anchors = _by_block_files(repeated.select("block", "anchors"), "anchors")
    found = rows.mapInArrow(_block_pieces(anchors, parts), "part long, block long, " + ", ".join(f"a{i} binary" for i in range(6)))
    answered = found.groupBy("part").applyInArrow(_answers, "block long, value binary, begin binary, end binary, id binary")
    answers = _by_block_files(answered, "answers")
    out = rows.mapInArrow(_cut(anchors, answers), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumnRenamed("id", key)
