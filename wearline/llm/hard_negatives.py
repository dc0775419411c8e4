"""Hard negatives by shared lists: anchors of a cluster walk one list of candidates, sorted once.

Anchors are clustered by direction (k-means on a bounded sample of anchors, SAMPLE; every anchor gets its
nearest centre). For a cluster whose members lie within the angle `spread` of its centre, a candidate at
angle t to the centre scores at most |anchor| * |candidate| * cos(max(0, t - spread)). Each shard of
candidates is sorted once by that bound without |anchor|; all members walk the same list in steps, and a
member leaves it as soon as its last wanted score is certainly above the next bound. So results are exact
for any clustering; only the length of the walks depends on it.

Two walks are made: over the candidates of the anchor's own label for its positives, then over the others
for the negatives of each positive's window. Work is laid out as a grid of cells, (anchors of a block) x
(candidates of a shard): blocks hold about BLOCK anchors of one cluster (of one cluster and label for
positives), shards about SHARD candidates dealt by row number, so that one hot label, vector or id
fills many cells. A cell returns at most the wanted number of rows for each anchor and window; a window per
anchor picks the best of all cells.

Vectors become integers, floor(scale * x); scores are exact integer products. Equal vectors of a shard
that have the same label are walked as one, with as many of their smallest ids as can be wanted.

Defined cases: rows with a null label, id or vector, a null or non-finite component, or another number of
components than the most frequent one take no part, nor do those whose integers do not fit 53 bits in a
product (the largest component times itself times their number); zero vectors take part with score 0. An
anchor excludes its own row only: other rows with the same id are candidates like any other. Ties go to
the smaller id, then to equal results. An anchor without positives or negatives gives no row. Without
anchors or candidates the result is empty. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.session import stage, stage_counted

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
SAMPLE = 4096
SHARD = 1 << 15
BLOCK = 4096
STEP = 512
ANCHORS_PER_CLUSTER = 128
MOST_CLUSTERS = 256

POSITIVE_ROWS = "anchor long, anchor_id long, candidate_id long, score long"
NEGATIVE_ROWS = "anchor long, place int, candidate_id long, score long"


# --- walking one list ------------------------------------------------------------------------


def merged(vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, keep: int):
    """Equal (vector, label) as one: the places of one row each, and up to `keep` rows of each group by smallest id."""
    keys = np.column_stack([vectors.astype(np.int64), labels]).view([("", np.int64)] * (vectors.shape[1] + 1)).ravel()
    _, one, group = np.unique(keys, return_index=True, return_inverse=True)
    order = np.lexsort((rows, ids, group))
    place = np.arange(len(order)) - np.searchsorted(group[order], group[order], "left")
    kept = order[place < keep]
    return one, group[kept], kept


class Best:
    """The best `k` hits of each window, by score and then smaller id."""

    def __init__(self, windows: int, k: int):
        self.k = k
        self.window, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.last = np.full(windows, -np.inf)

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        window, score, ids = np.append(self.window, window), np.append(self.score, score), np.append(self.id, ids)
        order = np.lexsort((ids, -score, window))
        window = window[order]
        place = np.arange(len(order)) - np.searchsorted(window, window, "left")
        kept = order[place < self.k]
        self.window, self.score, self.id = window[place < self.k], score[kept], ids[kept]
        full = place == self.k - 1
        self.last[window[full]] = score[order[full]]


def walk(
    anchors: np.ndarray, tops: np.ndarray, floors: np.ndarray, labels: np.ndarray, own_rows: np.ndarray, own_label: bool,
    centre: np.ndarray, vectors: np.ndarray, ids: np.ndarray, candidate_labels: np.ndarray, rows: np.ndarray, k: int,
) -> Best:
    """Best candidates for every window (anchor, top, floor): scores within floor..top, by score and smaller id.

    `tops` and `floors` have a row for each anchor and a column for each of its windows.
    """
    windows = tops.shape[1]
    best = Best(len(anchors) * windows, k)
    one, group, kept = merged(vectors, ids, candidate_labels, rows, k + 1)
    of_group = np.searchsorted(group, np.arange(len(one) + 1))
    vectors, candidate_labels = vectors[one].astype(np.float64), candidate_labels[one]
    ids, rows = ids[kept], rows[kept]
    lengths, own = np.linalg.norm(vectors, axis=1), np.linalg.norm(anchors, axis=1)
    unit = np.divide(anchors, own[:, None], out=np.zeros(anchors.shape), where=own[:, None] > 0)
    spread = np.arccos(np.clip(unit[own > 0] @ centre, -1, 1)).max(initial=0.0)
    angle = np.arccos(np.clip(np.divide(vectors @ centre, lengths, out=np.zeros(len(vectors)), where=lengths > 0), -1, 1))
    # A little wider than the angles say, for their rounding.
    bound = lengths * np.cos(np.maximum(0.0, angle - spread - 1e-6)) + 1e-9 * lengths
    order = np.argsort(-bound, kind="stable")
    bound = np.append(bound[order], -np.inf)
    active = np.arange(len(anchors))
    for at in range(0, len(order), STEP):
        # What a member still wants: its worst kept score while the window is full, else the window's floor.
        wanted = np.maximum(best.last.reshape(-1, windows), floors).min(axis=1)
        reach = np.where(own > 0, own * bound[at] + 0.5, 0.0)  # scores are integers
        active = active[reach[active] >= wanted[active]]
        if not len(active):
            break
        some = order[at : at + STEP]
        scores = anchors[active] @ vectors[some].T
        fits = (labels[active][:, None] == candidate_labels[some][None, :]) == own_label
        for w in range(windows):
            least = np.maximum(best.last.reshape(-1, windows)[active, w], floors[active, w])
            open_to = fits & (scores <= tops[active, w][:, None]) & (scores >= least[:, None])
            if len(some) > k + 1:  # at least k rows of others reach the k + 1st best of this step
                shown = np.where(open_to, scores, -np.inf)
                open_to &= scores >= np.partition(shown, -(k + 1), axis=1)[:, -(k + 1)][:, None]
            a, c = np.nonzero(open_to)
            if not len(a):
                continue
            score = scores[a, c].astype(np.int64)
            size = of_group[some[c] + 1] - of_group[some[c]]
            member = np.repeat(of_group[some[c]] - np.cumsum(size) + size, size) + np.arange(size.sum())
            a, score = np.repeat(active[a], size), np.repeat(score, size)
            other = rows[member] != own_rows[a]
            best.add(a[other] * windows + w, score[other], ids[member][other])
    return best


# --- Spark ------------------------------------------------------------------------------------


def _numbers(column) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def integers(vectors: DataFrame, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label") -> DataFrame:
    """Rows that take part, staged: row (a number of its own), id, label and the integer vector `v`."""
    v = F.col("vector")
    plain = vectors.select(
        F.col(key).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    plain = plain.where(F.col("id").isNotNull() & F.col("label").isNotNull() & fine & (F.size(v) > 0))
    limit = F.sqrt(F.lit(2.0**53) / F.size(v))
    plain = plain.where(F.forall(v, lambda x: F.abs(x * scale) < limit - 1))
    # The usual length; the lengths of vectors are few.
    usual = plain.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = plain.where(F.size(v) == F.lit(usual["n"] if usual else 0))
    whole = rows.select("id", "label", F.transform(v, lambda x: F.floor(x * scale).cast("int")).alias("v"))
    return stage(whole.withColumn("row", F.monotonically_increasing_id()), "vectors")


def centres(anchors: DataFrame, count: int) -> np.ndarray:
    """Unit centres of the anchors' directions, from at most SAMPLE anchors chosen by a hash of their row."""
    sample = anchors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").toArrow()["v"]
    x = _numbers(sample).astype(np.float64)
    norms = np.linalg.norm(x, axis=1)
    x = x[norms > 0] / norms[norms > 0][:, None]
    if not len(x):
        return np.zeros((1, _numbers(sample).shape[1]))
    k = max(1, min(MOST_CLUSTERS, count // ANCHORS_PER_CLUSTER, len(x)))
    found = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(8):
        nearest = (x @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, x)
        norms = np.linalg.norm(sums, axis=1)
        found = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-300)[:, None], found)
    return found


def _clustered(anchors: DataFrame, found: np.ndarray) -> DataFrame:
    """Anchors with their cluster; `found` is at most MOST_CLUSTERS vectors."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _numbers(batch.column("v")).astype(np.float64)
            yield batch.append_column("cluster", pa.array((x @ found.T).argmax(axis=1) if len(x) else np.zeros(0, np.int64), pa.int64()))

    return anchors.mapInArrow(assign, "id long, label long, v array<int>, row long, cluster long")


def _in_blocks(anchors: DataFrame, by: list[str]) -> DataFrame:
    """Anchors with `part`, of their (by) group's parts of about BLOCK anchors."""
    parts = anchors.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    return anchors.join(parts, by).withColumn("part", F.pmod(F.xxhash64("row"), "parts")).drop("parts")


def _shards(n: int) -> int:
    return max(1, -(-n // SHARD))


def _cells(blocks: DataFrame, dealt: DataFrame, shards: int) -> DataFrame:
    """One row per anchor or candidate and cell. `dealt` are candidates, each with the `blocks` (cluster, part) it meets."""
    every = F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))
    tops = F.col("tops") if "tops" in blocks.columns else F.lit(None).cast("array<long>")
    left = blocks.select("cluster", "part", F.explode(every).alias("shard"), "row", "id", "label", "v", F.lit(True).alias("is_anchor"), tops.alias("tops"))
    met = dealt.select(F.explode("blocks").alias("_b"), F.pmod("row", F.lit(shards)).alias("shard"), "row", "id", "label", "v")
    right = met.select("_b.cluster", "_b.part", "shard", "row", "id", "label", "v", F.lit(False).alias("is_anchor"), F.lit(None).cast("array<long>").alias("tops"))
    return left.unionByName(right)


def _cell(table: pa.Table, found: np.ndarray):
    mine = table["is_anchor"].to_numpy(zero_copy_only=False).astype(bool)
    left, right = table.filter(pa.array(mine)), table.filter(pa.array(~mine))
    column = lambda t, c: t[c].to_numpy()
    if not left.num_rows or not right.num_rows:
        return None
    return left, (column(left, "row"), column(left, "label"), _numbers(left["v"]).astype(np.float64)), (
        _numbers(right["v"]), column(right, "id"), column(right, "label"), column(right, "row"),
    ), found[int(column(left, "cluster")[0])]


def positives(anchors: DataFrame, candidates: DataFrame, found: np.ndarray, shards: int, k: int = POSITIVES) -> DataFrame:
    """The k best other rows of each anchor's label: anchor (its row), anchor_id, candidate_id, score."""

    def walk_cell(table: pa.Table) -> pa.Table:
        cell = _cell(table, found)
        rows = [[], [], [], []]
        if cell:
            left, (own_rows, labels, x), (vectors, ids, their, numbers), centre = cell
            top, floor = np.full((len(x), 1), np.inf), np.full((len(x), 1), -np.inf)
            best = walk(x, top, floor, labels, own_rows, True, centre, vectors, ids, their, numbers, k)
            rows = [own_rows[best.window], left["id"].to_numpy()[best.window], best.id, best.score]
        return pa.table([pa.array(r, pa.int64()) for r in rows], names=["anchor", "anchor_id", "candidate_id", "score"])

    blocks = _in_blocks(anchors, ["cluster", "label"])
    # A label's blocks; adaptive execution broadcasts so short a table or splits a hot label's rows.
    met = blocks.groupBy("label").agg(F.collect_set(F.struct("cluster", "part")).alias("blocks"))
    cells = _cells(blocks, candidates.join(met, "label"), shards)
    hits = cells.groupBy("label", "cluster", "part", "shard").applyInArrow(walk_cell, POSITIVE_ROWS)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "candidate_id")
    return hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def negatives(anchors: DataFrame, candidates: DataFrame, found: np.ndarray, shards: int, k: int, share: tuple[int, int]) -> DataFrame:
    """For each anchor and place of a positive (`tops` has the positives' scores), the k best rows of other labels within the window."""
    low, high = share

    def walk_cell(table: pa.Table) -> pa.Table:
        cell = _cell(table, found)
        rows = [[], [], [], []]
        if cell:
            left, (own_rows, labels, x), (vectors, ids, their, numbers), centre = cell
            given = left["tops"].to_pylist()
            width = max(map(len, given))
            tops = np.full((len(given), width), -np.inf)
            for a, scores in enumerate(given):
                tops[a, : len(scores)] = scores
            floors = np.where(np.isfinite(tops), np.ceil(np.where(np.isfinite(tops), tops, 0) * low / high), np.inf)
            best = walk(x, tops, floors, labels, own_rows, False, centre, vectors, ids, their, numbers, k)
            anchor, place = best.window // width, best.window % width
            fine = high * best.score >= low * tops[anchor, place].astype(np.int64)
            rows = [own_rows[anchor][fine], (place + 1)[fine], best.id[fine], best.score[fine]]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table([pa.array(r, t) for r, t in zip(rows, kinds)], names=["anchor", "place", "candidate_id", "score"])

    blocks = _in_blocks(anchors, ["cluster"])
    # One row per cluster, at most MOST_CLUSTERS; a candidate meets each part of each.
    parts = [(r["cluster"], r["parts"]) for r in anchors.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts")).collect()]
    each = [f"transform(sequence(0L, {n - 1}L), p -> named_struct('cluster', {c}L, 'part', p))" for c, n in parts]
    every = F.expr(f"concat({', '.join(each)})") if each else F.array().cast("array<struct<cluster:bigint,part:bigint>>")
    cells = _cells(blocks, candidates.withColumn("blocks", every), shards)
    hits = cells.groupBy("cluster", "part", "shard").applyInArrow(walk_cell, NEGATIVE_ROWS)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "candidate_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchor: str = "vec_id % 100 = 0", label: Column | str = "label", key: str = "vec_id", vector: str = "embedding",
    positive_count: int = POSITIVES, negative_count: int = NEGATIVES, share: tuple[int, int] = (80, 100), scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchor` is a condition on `key`. A negative's score lies between low/high of `share` times the
    positive's score and that score.
    """
    rows = integers(vectors, scale, key, vector, label)
    anchors, count = stage_counted(rows.withColumnRenamed("id", key).where(anchor).withColumnRenamed(key, "id"), "anchors")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not count:
        return vectors.sparkSession.createDataFrame([], schema)
    found = centres(anchors, count)
    anchors = stage(_clustered(anchors.select("id", "label", "v", "row"), found), "anchors")
    shards = _shards(rows.count())
    near = stage(positives(anchors, rows, found, shards, positive_count), "positives")
    tops = near.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda p: p["score"]).alias("tops"))
    hits = negatives(anchors.join(tops.withColumnRenamed("anchor", "row"), "row"), rows, found, shards, negative_count, share)
    return near.join(hits.withColumnRenamed("candidate_id", "negative_id").withColumnRenamed("score", "negative_score"), ["anchor", "place"]).select(
        "anchor_id", F.col("candidate_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )


ORACLE_SQL = """
WITH clean AS (
  SELECT row_number() OVER () AS place, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.place AS anchor, a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM clean a JOIN clean c ON a.place <> c.place WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) AS place FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) <= 5),
pairs AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.other_id) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM pairs WHERE rank <= 5
"""
