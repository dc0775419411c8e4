"""Mined negatives against a plain double loop, on hostile vectors and cases."""

from __future__ import annotations

import math
import random

import pytest

from wearline.llm import hard_negatives


def brute_force(rows, is_anchor, low=80, high=100, scale=256):
    clean = [
        (n, i, label, [math.floor(scale * x) for x in v])
        for n, (i, v, label) in enumerate(rows)
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for n, i, label, v in clean:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for m, j, other, w in clean if m != n]
        positives = sorted((s, j) for s, j, other in scored if other == label)[:5]
        for s, j in positives:
            window = sorted((t, k) for t, k, other in scored if other != label and low * -s <= high * -t <= high * -s)[:5]
            found += [(i, j, rank + 1, k, -s, -t) for rank, (t, k) in enumerate(window)]
    return sorted(found)


def mined(spark, rows, anchor="vec_id % 10 = 0"):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return sorted(map(tuple, hard_negatives.mine(df, anchor).collect()))


def vectors(seed, n, d=6, values=None):
    draw = random.Random(seed)
    one = lambda: draw.choice(values) if values else round(draw.gauss(0, 1) * 64) / 64
    return [(k, [one() for _ in range(d)], draw.randrange(3)) for k in range(n)]


@pytest.fixture
def small_cells(monkeypatch):
    for name, value in {"SHARD": 37, "BLOCK": 4, "STEP": 8, "ANCHORS_PER_CLUSTER": 3}.items():
        monkeypatch.setattr(hard_negatives, name, value)


def test_random_vectors_in_one_cell(spark):
    rows = vectors(1, 300)
    assert mined(spark, rows) == brute_force(rows, lambda i: i % 10 == 0) != []


def test_random_vectors_in_many_cells(spark, small_cells):
    rows = vectors(2, 240)
    assert mined(spark, rows) == brute_force(rows, lambda i: i % 10 == 0) != []


def test_ties_copies_and_zeros(spark, small_cells):
    rows = vectors(3, 150, 3, [0.0, 1.0, -1.0]) + [(k, [1.0, 1.0, 0.0], 1) for k in range(150, 230)] + [(k, [0.0, 0.0, 0.0], k % 2) for k in range(230, 250)]
    assert mined(spark, rows) == brute_force(rows, lambda i: i % 10 == 0) != []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = vectors(4, 60)
    rows += [(0, v, label) for _, v, label in rows[:5]] + rows[10:20]
    assert mined(spark, rows) == brute_force(rows, lambda i: i % 10 == 0)


def test_rows_that_take_no_part(spark):
    rows = vectors(5, 40)
    odd = [(100, None, 1), (110, [], 1), (120, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (130, [float("nan")] * 6, 2), (140, [float("inf")] * 6, 2),
           (150, [1.0] * 6, None), (None, [1.0] * 6, 1), (160, [1.0, 2.0], 1), (170, [3e38] * 6, 0)]
    assert mined(spark, rows + odd) == brute_force(rows, lambda i: i % 10 == 0)


def test_nothing_to_find(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)]) == []  # no anchor
    assert mined(spark, [(10, [1.0, 2.0], 1)]) == []  # alone
    assert mined(spark, [(10, [1.0, 0.0], 1), (11, [-1.0, 0.0], 1), (12, [1.0, 0.0], 2)]) == []  # a negative window is empty


def test_clashing_columns(spark):
    rows = [(k, v, label, 1, "x", 2.0) for k, v, label in vectors(6, 50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score int, row string, cluster double")
    got = sorted(map(tuple, hard_negatives.mine(df, "vec_id % 10 = 0").collect()))
    assert got == brute_force([r[:3] for r in rows], lambda i: i % 10 == 0)


def test_members_leave_the_list_early():
    import numpy as np

    rng = np.random.default_rng(7)
    base = rng.normal(size=8) * 100
    near = np.floor(base + rng.normal(size=(64, 8)))
    far = np.floor(rng.normal(size=(6_000, 8)) * 5)
    everything = np.vstack([near, far]).astype(np.int64)
    ids = np.arange(len(everything))
    anchors = np.floor(base + rng.normal(size=(4, 8)))
    steps = []
    add = hard_negatives.Best.add

    class Counting(hard_negatives.Best):
        def add(self, *given):
            steps.append(1)
            add(self, *given)

    plain = hard_negatives.Best
    hard_negatives.Best = Counting
    try:
        labels = np.zeros(len(ids), np.int64)
        best = hard_negatives.walk(
            anchors, np.full((4, 1), np.inf), np.full((4, 1), -np.inf), np.zeros(4, np.int64), np.full(4, -1), True,
            base / np.linalg.norm(base), everything, ids, labels, ids, 5,
        )
    finally:
        hard_negatives.Best = plain
    scores = anchors @ everything.T
    for a in range(4):
        assert sorted(best.score[best.window == a], reverse=True) == sorted(scores[a], reverse=True)[:5]
    assert len(steps) == 1  # of twelve
