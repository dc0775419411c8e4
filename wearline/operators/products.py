"""Products of many columns and of matrices, cut into tiles and cells of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.operators.joins import attach
from wearline.session import stage, stage_counted

# Up to this many column pairs are summed as SQL expressions of one aggregation.
PAIR_EXPRESSIONS = 400
TILE = 256
FAN = 32
# A cell of a matrix product has at most this many entries of either side.
CELL_ENTRIES = 2_048
# A matrix of at most this many entries is sent to all tasks; a task then makes about ROW_PRODUCTS products.
SMALL_ENTRIES = 100_000
ROW_PRODUCTS = 2_000_000

SUMS = ["n", "a", "b", "aa", "bb", "ab"]


def pair_count(columns: list[str]) -> int:
    return len(columns) * (len(columns) + 1) // 2


def tiled_pair_sums(df: DataFrame, columns: list[str], pivots: list[float], tile: int | None = None) -> DataFrame:
    """For every pair i <= j of columns, over rows where both are present: n and the sums a, b, aa, bb, ab of the values less their pivots.

    Each task multiplies its rows as matrices and keeps one block of sums per pair of tiles; blocks of
    several tasks are added in levels of FAN, so that no task holds more. Columns: i, j and the sums.
    """
    k, tile = len(columns), tile or TILE
    centre = np.array(pivots, float)
    cuts = [(at, min(at + tile, k)) for at in range(0, k, tile)]
    schema = "ti int, tj int, part long, sums binary"

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, k) - centre
            there = np.isfinite(x)
            x, there = np.where(there, x, 0.0), there.astype(float)
            squares = x * x
            for ti, (a, b) in enumerate(cuts):
                for tj, (c, d) in enumerate(cuts[ti:], ti):
                    left, right = slice(a, b), slice(c, d)
                    own = np.stack([there[:, left].T @ there[:, right], x[:, left].T @ there[:, right], there[:, left].T @ x[:, right],
                                    squares[:, left].T @ there[:, right], there[:, left].T @ squares[:, right], x[:, left].T @ x[:, right]])
                    blocks[ti, tj] = blocks[ti, tj] + own if (ti, tj) in blocks else own
        part = TaskContext.get().partitionId()
        for (ti, tj), own in blocks.items():
            yield pa.record_batch([pa.array([ti], pa.int32()), pa.array([tj], pa.int32()), pa.array([part], pa.int64()), pa.array([own.tobytes()], pa.binary())], names=["ti", "tj", "part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s.as_buffer(), float) for s in table["sums"])
        return pa.table({"ti": table["ti"][:1], "tj": table["tj"][:1], "part": table["part"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ti, tj, own in zip(batch["ti"].to_pylist(), batch["tj"].to_pylist(), batch["sums"]):
                (a, b), (c, d) = cuts[ti], cuts[tj]
                own = np.frombuffer(own.as_buffer(), float).reshape(len(SUMS), b - a, d - c)
                i, j = np.meshgrid(np.arange(a, b), np.arange(c, d), indexing="ij")
                upper = i <= j
                yield pa.record_batch([pa.array(i[upper], pa.int32()), pa.array(j[upper], pa.int32()), *(pa.array(s[upper]) for s in own)], names=["i", "j", *SUMS])

    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    whole, found = stage_counted(df.select(values.alias("x")).mapInArrow(multiply, schema), "blocks")
    left = -(-found // (len(cuts) * (len(cuts) + 1) // 2))  # blocks per pair of tiles
    while left > 1:
        left = -(-left // FAN)
        dealt = whole.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(left)))
        whole = stage(dealt.groupBy("ti", "tj", "part").applyInArrow(add, schema), "blocks")
    return whole.mapInArrow(rows, "i int, j int, " + ", ".join(f"{s} double" for s in SUMS))


def pivots_of(df: DataFrame, columns: list[str]) -> list[float]:
    """A value near each column's values, which keeps sums of squares small: the mean of the finite ones."""
    row = df.agg(*[F.avg(F.when(F.abs(F.col(f"`{c}`").cast("double")) < float("inf"), F.col(f"`{c}`").cast("double"))).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return [row[i] or 0.0 for i in range(len(columns))]


def tiled_correlations(df: DataFrame, columns: list[str], tile: int | None = None) -> DataFrame:
    """(a, b, r) for every ordered pair, over rows where both are present; missing where a column is constant there."""
    sums = tiled_pair_sums(df, columns, pivots_of(df, columns), tile)
    n = F.col("n")
    own_a, own_b = F.col("aa") - F.col("a") * F.col("a") / n, F.col("bb") - F.col("b") * F.col("b") / n
    fine = (n > 0) & (own_a > F.col("aa") * 1e-14) & (own_b > F.col("bb") * 1e-14)
    r = F.when(fine, (F.col("ab") - F.col("a") * F.col("b") / n) / F.sqrt(own_a) / F.sqrt(own_b))
    names = F.array(*[F.lit(c) for c in columns])
    half = sums.select("i", "j", F.when((F.col("i") == F.col("j")) & r.isNotNull(), 1.0).otherwise(r).alias("r"))
    both = half.select(F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))).alias("p"), "r")
    return both.select(F.get(names, F.col("p.i")).alias("a"), F.get(names, F.col("p.j")).alias("b"), "r")


def tiled_gram(df: DataFrame, columns: list[str], tile: int | None = None) -> np.ndarray:
    """Sums of products of all pairs of complete columns, on the driver: (number of columns) ** 2 numbers."""
    pivots = np.array(pivots_of(df, columns))
    found = tiled_pair_sums(df, columns, list(pivots), tile).toArrow()
    i, j, n, a, b, ab = (found[c].to_numpy() for c in ("i", "j", "n", "a", "b", "ab"))
    gram = np.zeros((len(columns), len(columns)))
    gram[i, j] = gram[j, i] = ab + pivots[i] * b + pivots[j] * a + n * pivots[i] * pivots[j]
    return gram


def _by_rows(large: DataFrame, small: DataFrame, row: str) -> DataFrame:
    """The product where `small` fits every task: whole rows of `large` are dealt by `row`, so that all products
    of one place arise in one task and only the entries are shuffled. A row makes one product per entry of `small` at most."""
    each = large.groupBy("k").agg(F.count(F.lit(1)).alias("n")).join(small.groupBy("k").agg(F.count(F.lit(1)).alias("m")), "k")
    made = each.agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0
    dealt = large.repartition(max(1, -(-made // ROW_PRODUCTS)), row)
    return dealt.join(F.broadcast(small), "k").groupBy("i", "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v"))


def multiply(a: DataFrame, b: DataFrame, cell: int | None = None) -> DataFrame:
    """Product of two matrices in coordinate form: a(i, k, v) times b(k, j, v) gives (i, j, v).

    Where one side is small, the other is multiplied row by row and no product is shuffled (`cell` asks for the
    grid all the same).

    An inner index k with n entries in `a` and m in `b` makes n * m products. Where n or m is above `cell`,
    the entries of k are dealt to a grid of parts by i and by j, and each side is copied to the other
    side's parts; so a heavy k fills many cells of at most about cell ** 2 products each, by design and
    not by what the engine finds out later. Products are summed before the shuffle on (i, j).
    """
    left, right = a.select("i", "k", F.col("v").alias("_a")), b.select("k", "j", F.col("v").alias("_b"))
    if cell is None:
        (left, n), (right, m) = stage_counted(left, "left"), stage_counted(right, "right")
        if min(n, m) <= SMALL_ENTRIES:
            return _by_rows(left, right, "i") if m <= n else _by_rows(right, left, "j")
    cell = cell or CELL_ENTRIES
    heavy_a, heavy_b = (side.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell) for side in (left, right))
    parts = lambda n: F.ceil(F.coalesce(n, F.lit(1)) / cell)
    # At most one heavy k per `cell` entries of a side.
    grid = heavy_a.withColumnRenamed("n", "_n").join(heavy_b.withColumnRenamed("n", "_m"), "k", "full").select("k", parts(F.col("_n")).alias("_pa"), parts(F.col("_m")).alias("_pb"))
    one = F.lit(1).cast("long")
    pa_, pb_ = F.coalesce("_pa", one), F.coalesce("_pb", one)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    dealt_a = attach(left, grid, ["k"], "left").select("k", "i", "_a", F.pmod(F.xxhash64("i"), pa_).alias("_x"), every(pb_).alias("_y"))
    dealt_b = attach(right, grid, ["k"], "left").select("k", "j", "_b", F.pmod(F.xxhash64("j"), pb_).alias("_y"), every(pa_).alias("_x"))
    return dealt_a.join(dealt_b, ["k", "_x", "_y"]).groupBy("i", "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v"))
