"""Near-duplicate documents: consistent weighted sampling over TF-IDF word shingles.

A document is the weighted set of its five-word shingles (lower case, white space folded), weight =
term frequency x idf, idf = 1 + ln(documents with a shingle / documents with this one). A text's own
copies are one document to its idf: a near copy shares at least SIMILARITY of a text, so the number of
documents that each shingle in that share of a text reaches is taken for its copies, and counts are divided
by it (1 at least). Else the shingles that a group of copies shares would weigh less, the larger the group,
and every edit more, the larger the corpus, until copies of one text were no longer alike. Every shingle's
documents are counted exactly: texts are dealt to blocks of bounded size, a block sends its distinct
shingles with their counts to parts by ranges of the hash, and a part sends back the sums in the same
order, which need no hashes and are mostly ones. The block's texts are shuffled once for both passes.

Improved consistent weighted sampling draws, for every shingle and sample, r and c from Gamma(2, 1)
and beta from [0, 1) and takes the shingle with the smallest ln c - r (t - beta + 1), t =
floor(ln w / r + beta); two documents agree on (shingle, t) with probability equal to their weighted
Jaccard similarity. The draws come from hash bits through tables of 65,536 quantiles. BANDS bands of
ROWS samples make buckets: at similarity 0.8 a pair is missed with probability (1 - 0.8^3)^14 = 4e-5.

Classes are the connected components of pairs with weighted Jaccard >= 0.8, verified on all weights.
Instead of all pairs of a bucket, rounds compare its members with some pivots (one, then 1,024 a round,
fewer where texts are long). A pivot that has met every member of another class leaves the bucket; a
bucket whose members are all in one class is finished, which settles large groups of close copies in the
first rounds. So no link between different texts of a bucket is lost. Pairs are never rows: a task holds
up to PART_ROWS members and the pivots of a bucket and returns links only. It compares a pair in its first
common bucket, unless links found so far connect it, and only if its total weights are within the
similarity's ratio. Which texts have a pair to compare is settled first, on bands and weights alone, so
that a text's vector goes only to the buckets that compare it.

Defined cases: every row counts as a document, copies too; texts equal after normalisation are one class without comparison; null, empty and
blank texts have no shingle and are classes of their own; texts under five words are one shingle;
rows with equal or null ids keep one row each. Other columns of the input are not used.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.llm.graph import components
from wearline.llm.text import SHINGLE_WORDS, mix, normalised, shingle_hashes, slices, word_hashes
from wearline.session import stage, stage_counted

SIMILARITY = 0.8
BANDS, ROWS = 14, 3
# A share of documents from which on the idf would stop growing; none.
COMMON_SHARE = 0.0
# Bytes of text of a block, and those whose distinct shingles one range of hashes has on average.
BLOCK_BYTES, RANGE_BYTES = 4 << 20, 5 << 20
# What str.split takes for no white space.
NOT_BLANK = "[^" + "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace()) + "]"
# Pivots of a bucket in one round, and the bytes of their vectors.
PIVOTS, PIVOT_BYTES = 1024, 64 << 20
PART_ROWS, PART_BYTES = 1000, 32 << 20
SHINGLE_BYTES = 12
# Rows without vectors, of some 250 bytes each, that may be broadcast.
BROADCAST_ROWS = 100_000
BLOCK = 1024


def weighted_shingles(normal: str, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a normalised text and their term frequencies."""
    return np.unique(shingle_hashes(word_hashes(normal), n), return_counts=True)


# --- texts -----------------------------------------------------------------------------------


def small_texts(rows: DataFrame) -> DataFrame:
    """The same rows with __text as `text_of` reads it: every text is shuffled whole, by itself compressed better than by the shuffle."""

    def pack(batches):
        codec = pa.Codec("zstd")
        for batch in slices(batches):
            texts = (x.as_buffer() for x in batch.column("__text").cast(pa.binary()))
            packed = [None if x is None else x.size.to_bytes(8, "little") + codec.compress(x, asbytes=True) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__hash"), pa.array(packed, pa.binary())], ["__id", "__hash", "__text"])

    kind = rows.schema["__id"].dataType.simpleString()
    return rows.select("__id", "__hash", "__text").mapInArrow(pack, f"__id {kind}, __hash long, __text binary")


def text_of(packed: pa.BinaryScalar) -> str | None:
    data = packed.as_buffer()
    if data is None:
        return None
    return pa.decompress(data.slice(8), int.from_bytes(data.slice(0, 8).to_pybytes(), "little"), "zstd", asbytes=True).decode()


# --- document counts -------------------------------------------------------------------------


def _block_shingles(texts: pa.ChunkedArray) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
    """The normalised texts and their shingles with term frequencies."""
    normal = [normalised(text_of(x)) for x in texts]
    return normal, [weighted_shingles(x) for x in normal]


def _packed(shingles: np.ndarray) -> bytes:
    """Differences of sorted hashes by byte places, since the high ones are zero and compress."""
    return np.diff(shingles, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _runs(parts: int):
    """Distinct shingles of a block, cut into `parts` ranges of the hash, and the documents that have each."""
    starts = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)

    def run(table: pa.Table) -> pa.Table:
        _, found = _block_shingles(table["__text"])
        copies = np.repeat(table["copies"].to_numpy(), [len(x) for x, _ in found])
        shingles, place = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
        counts = np.bincount(place, copies, len(shingles)).astype(np.int64)
        at = np.searchsorted(shingles, starts)
        cut = [(p, x, n) for p, (x, n) in enumerate(zip(np.split(shingles, at), np.split(counts, at))) if len(x)]
        return pa.table({
            "block": pa.array([table["block"][0].as_py()] * len(cut), pa.int64()), "part": pa.array([p for p, _, _ in cut], pa.int64()),
            "shingles": pa.array([_packed(x) for _, x, _ in cut], pa.binary()), "counts": pa.array([n.tobytes() for _, _, n in cut], pa.binary()),
        })

    return run


def _summed(table: pa.Table) -> pa.Table:
    """The runs of one range of hashes with the counts of the whole corpus."""
    runs = [_unpacked(x.as_buffer()) for x in table["shingles"]]
    counts = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table["counts"]])
    every = np.concatenate(runs)
    order = np.argsort(every)
    every = every[order]
    starts = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    counts = counts[order]
    total = np.empty_like(counts)
    total[order] = np.repeat(np.add.reduceat(counts, starts), np.diff(np.append(starts, len(counts))))
    sums = np.split(total, np.cumsum([len(x) for x in runs])[:-1])
    return pa.table({"block": table["block"], "part": table["part"], "counts": pa.array([x.tobytes() for x in sums], pa.binary())})


def own_copies(frequency: np.ndarray, counts: np.ndarray, similarity: float) -> int:
    """The largest number of documents that each shingle in a share of `similarity` of the text stands in."""
    rest = (1 - similarity + 1e-6) * frequency.sum()
    if frequency[counts == 1].sum() >= rest:  # most texts
        return 1
    order = np.argsort(counts)
    at = np.searchsorted(np.cumsum(frequency[order]), rest, side="right")
    return int(counts[order[min(at, len(order) - 1)]])


def weights(frequency: np.ndarray, counts: np.ndarray, documents: int, similarity: float | None = None) -> np.ndarray:
    """Term frequency x idf of shingles that `counts` of the documents have; with `similarity` the text's copies count once."""
    copies = 1 if similarity is None else own_copies(frequency, counts, similarity)
    return frequency * (1 - np.log(np.maximum(np.maximum(counts / copies, 1) / documents, COMMON_SHARE)))


# --- signatures ------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, 1 / r and ln c at the mid-points of 65,536 quantiles of Gamma(2, 1)."""
    p = (np.arange(65536) + 0.5) / 65536
    low, high = np.zeros(65536), np.full(65536, 40.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(below, x, low), np.where(below, high, x)
    return low.astype(np.float32), (1 / low).astype(np.float32), np.log(low).astype(np.float32)


@lru_cache(maxsize=1)
def _multipliers(samples: int) -> np.ndarray:
    return (mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))[:, None]


def samples(shingles: np.ndarray, weight: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """The consistent weighted samples of one document as 64-bit codes of (shingle, t)."""
    r, inverse, log_c = _tables()
    multipliers = _multipliers(count)
    log_w = np.log(weight).astype(np.float32)
    best, code = np.full(count, np.inf, np.float32), np.zeros(count, np.uint64)
    rows = np.arange(count)
    for at in range(0, len(shingles), BLOCK):
        s, w = shingles[at : at + BLOCK], log_w[at : at + BLOCK]
        x = s * multipliers
        x ^= x >> np.uint64(32)
        first = (x >> np.uint64(48)).view(np.int64)
        second = ((x >> np.uint64(32)) & np.uint64(0xFFFF)).view(np.int64)
        beta = (x & np.uint64(0xFFFFFFFF)).astype(np.uint32).astype(np.float32)
        beta *= np.float32(2.0**-32)
        t = inverse[first]
        t *= w
        t += beta
        np.floor(t, out=t)
        value = t - beta
        value += np.float32(1)
        value *= r[first]
        np.subtract(log_c[second], value, out=value)
        least = value.argmin(1)
        smallest = value[rows, least]
        better = smallest < best
        best[better] = smallest[better]
        chosen = mix(s[least] + t[rows, least].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        code[better] = chosen[better]
    return code


def band_codes(sampled: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One bucket code for each band; the band's number is part of it."""
    rows = sampled.reshape(bands, -1)
    total = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return total


def fingerprint(normal: str) -> bytes:
    return hashlib.blake2b(normal.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _signatures(documents: int, similarity: float | None):
    def sign(table: pa.Table, sums: pa.Table) -> pa.Table:
        normal, found = _block_shingles(table["__text"])
        counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x.as_buffer(), np.int64) for x in sums.sort_by("part")["counts"])])
        _, place = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
        own = np.split(counts[place], np.cumsum([len(x) for x, _ in found])[:-1])
        bands, totals = [], []
        for (shingles, frequency), n in zip(found, own):
            weighed = weights(frequency, n, documents, similarity)
            totals.append(float(weighed.sum()))
            bands.append(band_codes(samples(shingles, weighed)).view(np.int64) if len(shingles) else [])
        return pa.table({
            "__id": table["__id"], "__hash": table["__hash"], "copies": table["copies"], "print": pa.array([fingerprint(x) for x in normal], pa.binary()),
            "bands": pa.array(bands, pa.list_(pa.int64())), "weight": pa.array(totals, pa.float64()),
            "counts": pa.array([pa.compress(n.tobytes(), "zstd", asbytes=True) for n in own], pa.binary()),
        })

    return sign


def signatures(rows: DataFrame, similarity: float | None = None) -> tuple[DataFrame, int]:
    """__id, __hash, copies, print, bands, weight and counts (documents of each shingle) of the distinct rows (__id, __hash, __text); and the number of documents that have shingles. With `similarity` a text's copies count once in its weights."""
    size = rows.agg(F.sum(F.octet_length("__text")), F.count(F.when(F.col("__text").rlike(NOT_BLANK), 1))).first()
    blocks, parts = (max(1, -(-(size[0] or 0) // n)) for n in (BLOCK_BYTES, RANGE_BYTES))
    documents = max(1, size[1])
    dealt = small_texts(rows).withColumn("block", F.pmod(F.xxhash64("__id", "__hash"), F.lit(blocks)).cast("long")).repartition("block")
    # Repeated rows are dealt to one block and are one row there.
    blocked = dealt.groupBy("block", "__id", "__hash", "__text").agg(F.count(F.lit(1)).alias("copies"))
    runs = blocked.groupBy("block").applyInArrow(_runs(parts), "block long, part long, shingles binary, counts binary")
    sums = runs.groupBy("part").applyInArrow(_summed, "block long, part long, counts binary")
    schema = f"__id {rows.schema['__id'].dataType.simpleString()}, __hash long, copies long, print binary, bands array<long>, weight double, counts binary"
    return stage(blocked.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(_signatures(documents, similarity), schema), "signatures"), documents


def _vectors(documents: int, similarity: float):
    def vector(batches):
        for batch in slices(batches):
            hashes, weighed = [], []
            for normal, counts in zip(map(normalised, map(text_of, batch.column("__text"))), batch.column("counts")):
                shingles, frequency = weighted_shingles(normal)
                counts = np.frombuffer(pa.decompress(counts.as_buffer(), 8 * len(shingles), "zstd"), np.int64)
                hashes.append(shingles.tobytes())
                weighed.append(weights(frequency, counts, documents, similarity).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("print"), pa.array(hashes, pa.binary()), pa.array(weighed, pa.binary())], ["print", "shingles", "weights"])

    return vector


# --- verification ----------------------------------------------------------------------------


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Of two weighted sets with sorted keys."""
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = b[at] == a
    shared = np.minimum(wa[both], wb[at[both]]).sum(dtype=np.float64)
    return shared / (wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - shared)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several runs, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class _Vectors:
    """The weighted sets of a table's rows, with shingles numbered within it; one row meets many at once."""

    def __init__(self, table: pa.Table):
        shingles = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        self.weights = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in table["weights"]]).astype(np.float64)
        self.sizes = np.array([len(x) for x in shingles])
        self.starts = np.cumsum(self.sizes) - self.sizes
        known, self.numbers = np.unique(np.concatenate(shingles), return_inverse=True)
        self.own = np.zeros(len(known))
        self.sums = np.add.reduceat(self.weights, self.starts)

    def similarities(self, row: int, others: np.ndarray) -> np.ndarray:
        mine = slice(self.starts[row], self.starts[row] + self.sizes[row])
        self.own[self.numbers[mine]] = self.weights[mine]
        at = _spans(self.starts[others], self.sizes[others])
        shared = np.add.reduceat(np.minimum(self.weights[at], self.own[self.numbers[at]]), np.cumsum(self.sizes[others]) - self.sizes[others])
        self.own[self.numbers[mine]] = 0
        return shared / (self.sums[others] + self.sums[row] - shared)


def _to_meet(table: pa.Table, similarity: float, bucket: int | None):
    """For each pivot row: the member rows it may be linked with, and both sides' class numbers.

    Pairs of one class, pairs whose weights are too unlike and, in a bucket, pairs with an earlier common
    bucket are left out. The numbers are of an array which the caller may change between two pivots.
    """
    pivot = table["pivot"].to_numpy()
    members, pivots = np.flatnonzero(~pivot), np.flatnonzero(pivot)
    classes = table["label"].combine_chunks().dictionary_encode().indices.to_numpy().copy()
    weight = table["weight"].to_numpy()
    earlier = np.zeros((len(pivot), 0), np.int64)
    if bucket is not None and len(pivot):
        bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(pivot), -1)
        earlier = bands[:, : np.flatnonzero(bands[0] == bucket)[0]]
    before, heavy = earlier[members], weight[members]
    for j in pivots:
        here = classes[members] != classes[j]
        here &= np.minimum(heavy, weight[j]) >= (similarity - 1e-6) * np.maximum(heavy, weight[j])
        here &= ~(before == earlier[j]).any(1)
        yield j, members[here], classes


LIGHT = "group long, part long, pivot boolean, print binary, label binary, bands array<long>, weight double"


def _needed(similarity: float):
    """The rows of one part of a bucket that have a pair to verify."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        needed = np.zeros(table.num_rows, bool)
        for j, members, _ in _to_meet(table, similarity, key[0].as_py()):
            needed[members] = True
            needed[j] |= len(members) > 0
        return table.filter(pa.array(needed))

    return run


def _compare(similarity: float, in_bucket: bool):
    """Links between the members and the pivots of one part of a group."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        prints, found = table["print"].to_pylist(), []
        vectors = _Vectors(table)
        for j, members, classes in _to_meet(table, similarity, key[0].as_py() if in_bucket else None):
            if not len(members):
                continue
            alike = members[vectors.similarities(j, members) >= similarity - 1e-6]
            # One link to each class is enough.
            for number, i in zip(*np.unique(classes[alike], return_index=True)):
                found.append((prints[alike[i]], prints[j]))
                classes[classes == number] = classes[j]
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([x for _, x in found], pa.binary())})

    return run


def _parts() -> Column:
    """Parts of a group of members; a shingle weighs one at least, so weights bound the bytes."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / PART_ROWS, F.sum("weight") * SHINGLE_BYTES / PART_BYTES))


def _compared(rows: DataFrame, count: int, vectors: DataFrame, similarity: float, in_bucket: bool) -> tuple[DataFrame, int]:
    """Links found in `rows` (LIGHT), each of which takes its vector along once, and their number."""
    full = vectors.join(F.broadcast(rows) if count <= BROADCAST_ROWS else rows, "print")
    return stage_counted(full.groupBy("group", "part").applyInArrow(_compare(similarity, in_bucket), "a binary, b binary"), "verified")


def _dealt(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """Members in their parts, and every pivot in all parts of its group."""
    left = members.withColumn("part", F.pmod(F.xxhash64("print"), "parts")).withColumn("pivot", F.lit(False))
    right = pivots.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).withColumn("pivot", F.lit(True))
    columns = ["group", "part", "pivot", "print", "label", "bands", "weight"]
    return left.select(columns).union(right.select(columns))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining the classes that `links` connects."""
    of = lambda side: labels.select(F.col("print").alias(side), F.col("label").alias(f"l{side}"))
    between = links.join(of("a"), "a").join(of("b"), "b").where("la != lb").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    joined = components(between).select(F.col("node").alias("label"), F.col("label").alias("root"))
    return stage(labels.join(joined, "label", "left").select("print", F.coalesce("root", "label").alias("label")), "classes")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """(key, __hash, class_id, keeper) for every row; __hash is xxhash64(text).

    class_id is the smallest key of the class. keeper marks the row that stays of each class: the
    one with the smallest (key, __hash); rows equal in both are all marked.
    """
    rows = docs.select(F.col(key).alias("__id"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__text"))
    signed, documents = signatures(rows, similarity)
    texts = (
        signed.where(F.size("bands") > 0).groupBy("print")
        .agg(F.first("bands").alias("bands"), F.first("weight").alias("weight"), F.first("counts").alias("counts"), F.min(F.struct("__id", "__hash")).alias("at"))
    )
    members = texts.select("print", F.explode("bands").alias("bucket"), "bands", "weight")
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members, left = stage_counted(members.join(crowded, "bucket", "left_semi"), "members")
    labels = stage(members.select("print").distinct().withColumn("label", F.col("print")), "classes")
    if left:
        named = texts.join(labels.select("print"), "print", "left_semi").select("print", "counts", "at.*")
        sent = small_texts(rows)
        held = sent.join(named, sent["__id"].eqNullSafe(named["__id"]) & (sent["__hash"] == named["__hash"]))
        vectors = stage(held.select("print", "counts", "__text").dropDuplicates(["print"]).mapInArrow(_vectors(documents, similarity), "print binary, shingles binary, weights binary"), "vectors")
        # First every text meets one pivot only, the one of most common bands, which settles large groups
        # of close copies.
        pivots = members.groupBy("bucket").agg(F.min(F.struct("print", "bands", "weight")).alias("p"))
        alike = F.least("weight", "p.weight") >= (similarity - 1e-6) * F.greatest("weight", "p.weight")
        shared = F.size(F.array_intersect("bands", "p.bands"))
        pairs = (
            members.join(pivots, (members["bucket"] == pivots["bucket"]) & (F.col("print") != F.col("p.print")) & alike)
            .groupBy("print").agg(F.max(F.struct(shared.alias("shared"), F.col("p.print"), F.col("p.weight"))).alias("p"), F.first("weight").alias("weight"))
            .withColumns({"group": F.xxhash64("p.print"), "label": F.col("print"), "bands": F.array().cast("array<long>")})
        )
        pairs = stage(pairs, "pairs")
        parts = pairs.groupBy("group").agg(_parts().alias("parts"), F.collect_set(F.struct("p.print", "p.weight")).alias("p"))
        pivots = parts.select("group", "parts", F.inline("p")).withColumns({"label": F.col("print"), "bands": F.array().cast("array<long>")})
        rows_met, count = stage_counted(_dealt(pairs.join(parts.select("group", "parts"), "group"), pivots), "meetings")
        links, found = _compared(rows_met, count, vectors, similarity, False)
        if found:
            labels = _merged(labels, links)
        slots = F.least(F.lit(PIVOTS), F.greatest(F.lit(1), F.floor(PIVOT_BYTES / (F.avg("weight") * SHINGLE_BYTES))))
        # A bucket that fits makes all its members pivots and is done after this round.
        slots = F.when(F.count(F.lit(1)) > slots, slots)
        while True:
            placed = members.select("print", "bucket", "bands", "weight").join(labels, "print")
            mixed = (
                placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), _parts().alias("parts"), slots.alias("slots"))
                .where("low != high").select("bucket", "parts", "slots")
            )
            members, left = stage_counted(placed.join(mixed, "bucket"), "members")
            if not left:
                break
            grouped = members.withColumn("group", F.col("bucket"))
            pivots = grouped.groupBy("group", F.coalesce(F.pmod(F.xxhash64("print"), "slots"), F.xxhash64("print")).alias("slot")).agg(
                F.min(F.struct("print", "label", "bands", "weight", "parts")).alias("p")
            )
            pivots = stage(pivots.select("group", "p.*"), "pivots")
            needed = _dealt(grouped, pivots).groupBy("group", "part").applyInArrow(_needed(similarity), LIGHT)
            rows_met, count = stage_counted(needed, "meetings")
            links, found = _compared(rows_met, count, vectors, similarity, True) if count else (None, 0)
            if found:
                labels = _merged(labels, links)
            members = members.join(pivots.select(F.col("group").alias("bucket"), "print"), ["bucket", "print"], "left_anti")
    # A text without shingles is a class of its own row; others are named by their print or label.
    named = signed.join(labels, "print", "left").withColumn(
        "class", F.when(F.size("bands") > 0, F.coalesce("label", "print")).otherwise(F.unhex(F.sha2(F.concat_ws(":", F.coalesce(F.col("__id").cast("string"), F.lit("null")), "__hash"), 256)))
    )
    firsts = named.groupBy("class").agg(F.min(F.struct("__id", "__hash")).alias("first"))
    # Repeated rows come back as often as they came.
    return named.join(firsts, "class").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        F.col("__id").alias(key), "__hash", F.col("first.__id").alias("class_id"), F.struct("__id", "__hash").eqNullSafe(F.col("first")).alias("keeper")
    )
