"""Nearest neighbours by vantage-point trees, one per shard of vectors.

Each task turns its rows into shards of SHARD vectors and builds one tree per shard. A node has a
vantage point and two halves, ordered by their distance to it, with the smallest and largest
distance of each half. A query with distance d to the vantage point and k-th best distance t needs a
half only if the interval [d - t, d + t] meets the half's (triangle inequality). The search relaxes
this to t / factor: larger factors skip more and may miss neighbours; factor 1 is exact, ties
included. Queries come in blocks, each block meets every shard, and a block moves through a tree
together. The best of all shards are then ranked per query. A search takes one neighbour more than asked
for, and of those the query's own row goes.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows
without an id, take no part; vectors of different lengths are not compared; ties go to the smaller
id; one row equal to a query in id and vector is its own and no candidate, every other row is one, whatever
its id; equal (id, vector) rows are one query; many equal vectors split by rank, so trees stay balanced; empty tables give no
rows. Other columns are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.session import stage

SHARD = 4096
LEAF = 32
BLOCK = 256
FACTOR = 3.0


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distances(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(vectors - point).sum(-1))


class Tree:
    """Vectors in tree order; nodes are (first, last, vantage, bounds) ranges of that order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.lexsort((ids,))
        self.ids, self.vectors = ids[order], vectors[order].astype(np.float64)
        self.nodes: list[tuple] = []
        self._split(0, len(ids), leaf)

    def _split(self, first: int, last: int, leaf: int) -> int:
        number = len(self.nodes)
        self.nodes.append(())
        if last - first <= leaf:
            # Within a leaf ids ascend, which settles ties.
            order = first + np.argsort(self.ids[first:last], kind="stable")
            self.ids[first:last], self.vectors[first:last] = self.ids[order], self.vectors[order]
            self.nodes[number] = (first, last, -1, -1, None)
            return number
        # The point farthest from the middle splits better than a random one.
        middle = self.vectors[first:last].mean(0)
        far = first + int(distances(self.vectors[first:last], middle).argmax())
        point = self.vectors[far].copy()
        d = distances(self.vectors[first:last], point)
        order = np.argsort(d, kind="stable")
        self.ids[first:last], self.vectors[first:last], d = self.ids[first:last][order], self.vectors[first:last][order], d[order]
        half = (last - first) // 2
        bounds = (point, d[0], d[half - 1], d[half], d[-1])
        near = self._split(first, first + half, leaf)
        rest = self._split(first + half, last, leaf)
        self.nodes[number] = (first, last, near, rest, bounds)
        return number

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest found of each query; missing ones are infinitely far."""
        self.best_d = np.full((len(queries), k), np.inf)
        self.best_i = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.queries, self.factor = queries, factor
        # Each query's own path to a leaf gives a first bound; then all queries pass the tree together.
        self.home = np.zeros(len(queries), np.int64)
        self._descend(0, np.arange(len(queries)))
        self._visit(0, np.arange(len(queries)))
        return self.best_i, self.best_d

    def _descend(self, number: int, rows: np.ndarray) -> None:
        near, rest, bounds = self.nodes[number][2:]
        if bounds is None:
            self.home[rows] = number
            self._scan(number, rows)
            return
        inside = distances(self.queries[rows], bounds[0]) < (bounds[2] + bounds[3]) / 2
        for half, group in ((near, rows[inside]), (rest, rows[~inside])):
            if len(group):
                self._descend(half, group)

    def _visit(self, number: int, rows: np.ndarray) -> None:
        near, rest, bounds = self.nodes[number][2:]
        if bounds is None:
            rows = rows[self.home[rows] != number]
            if len(rows):
                self._scan(number, rows)
            return
        d = distances(self.queries[rows], bounds[0])
        for half, low, high in ((near, *bounds[1:3]), (rest, *bounds[3:])):
            reach = self.best_d[rows, -1] / self.factor * (1 + 1e-12) + 1e-12
            meets = (d - reach <= high) & (d + reach >= low)
            if meets.any():
                self._visit(half, rows[meets])

    def _scan(self, number: int, rows: np.ndarray) -> None:
        """Merge a leaf's vectors into the best of some queries."""
        first, last = self.nodes[number][:2]
        # Products tell which pairs can matter; only those are measured exactly.
        own, asked = self.vectors[first:last], self.queries[rows]
        size = np.square(own).sum(1) + np.square(asked).sum(1)[:, None]
        rough = size - 2 * (asked @ own.T)
        r, c = np.nonzero(rough <= np.square(self.best_d[rows, -1])[:, None] + 1e-9 * size)
        if not len(r):
            return
        d = np.full(rough.shape, np.inf)
        d[r, c] = distances(own[c], asked[r])
        closer = np.unique(r)
        rows, d, ids = rows[closer], d[closer], np.broadcast_to(self.ids[first:last], (len(closer), last - first))
        d, ids = np.concatenate([self.best_d[rows], d], 1), np.concatenate([self.best_i[rows], ids], 1)
        order = np.lexsort((ids, d), axis=-1)[:, : self.best_d.shape[1]]
        self.best_d[rows], self.best_i[rows] = np.take_along_axis(d, order, 1), np.take_along_axis(ids, order, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all lists of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Written (dim, number, ids, vectors): blobs of up to `size` rows (float64) of one vector length."""

    def pack(batches):
        held: dict[int, list] = {}
        number = TaskContext.get().partitionId() << 32

        def out(dim, n):
            nonlocal number
            ids, vectors = (np.concatenate(x) for x in zip(*held[dim]))
            held[dim] = [(ids[n:], vectors[n:])]
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([dim]), pa.array([number - 1]), pa.array([ids[:n].tobytes()]), pa.array([vectors[:n].tobytes()])], ["dim", "number", "ids", "vectors"]
            )

        for batch in batches:
            sizes = np.array(batch.column("dim"))
            for dim in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dim))
                held.setdefault(dim, []).append((np.array(part.column("id")), _matrix(part.column("vector"))))
                while sum(len(i) for i, _ in held[dim]) >= size:
                    yield out(dim, size)
        for dim in held:
            if n := sum(len(i) for i, _ in held[dim]):
                yield out(dim, n)

    return stage(rows.mapInArrow(pack, "dim long, number long, ids binary, vectors binary"), name)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", factor: float = FACTOR, shard: int = SHARD
) -> DataFrame:
    """(query_id, rank, id, score): each query's k nearest found among `vectors`, by Euclidean distance."""
    form = lambda df: df.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.size(vector).cast("long").alias("dim"), F.col(vector).cast("array<double>").alias("vector")
    )
    index = _packed(form(vectors), shard, "shards")
    blocks = _packed(form(queries).dropDuplicates(), BLOCK, "queries")
    # Every block of queries against every shard of its vector length.
    shards = index.select("dim", F.col("number").alias("shard"), F.col("ids").alias("own_ids"), F.col("vectors").alias("own"))
    pairs = shards.join(blocks.select("dim", "number", "ids", "vectors"), "dim")

    def search(batches):
        made, tree = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                dim, number, own_ids, own, block, ids, asked = (batch.column(i)[row] for i in range(7))
                dim = dim.as_py()
                if made != (dim, number.as_py()):
                    made = (dim, number.as_py())
                    tree = Tree(np.frombuffer(own_ids.as_buffer(), np.int64), np.frombuffer(own.as_buffer(), np.float64).reshape(-1, dim))
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                got, d = tree.search(np.frombuffer(asked.as_buffer(), np.float64).reshape(-1, dim), k + 1, factor)
                keep = np.isfinite(d)
                place = np.broadcast_to(np.arange(len(ids))[:, None], d.shape)[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(block.as_py(), len(place))), pa.array(place), pa.array(ids[place]), pa.array(got[keep]), pa.array(d[keep])],
                    ["block", "place", "query_id", "id", "score"],
                )

    found = pairs.select("dim", "shard", "own_ids", "own", "number", "ids", "vectors").mapInArrow(
        search, "block long, place long, query_id long, id long, score double"
    )
    # A row number with a bound is cut to k rows per query before the shuffle, too.
    best = Window.partitionBy("block", "place").orderBy("score", "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
    own = F.when((F.col("id") == F.col("query_id")) & (F.col("score") == 0), F.col("rank"))
    before = Window.partitionBy("block", "place").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The first row of the query's id at distance 0 is its own; later ranks move up by one.
    ranked = ranked.withColumn("own", F.min(own).over(before)).where(F.col("own").isNull() | (F.col("own") != F.col("rank")))
    ranked = ranked.withColumn("rank", F.col("rank") - F.col("own").isNotNull().cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
