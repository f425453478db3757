"""Branch and bound over columnar blocks against scoring every pair."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spineloom.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, is_anchor, positives=5, negatives=5, window=(80, 100), scale=256):
    used = []
    for k, (own, label, vector) in enumerate(rows):
        if own is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        used.append((k, own, label, [math.floor(scale * float(np.float32(x))) for x in vector]))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for k, own, label, vector in used:
        if not is_anchor(own):
            continue
        scored = [(-score(vector, v), i, lab, j) for j, i, lab, v in used if j != k]
        for s, i, _, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            inside = sorted(x for x in scored if x[2] != label and -s * window[0] <= -x[0] * 100 <= -s * window[1])
            out += [(own, i, rank, n[1], -s, -n[0]) for rank, n in enumerate(inside[:negatives], 1)]
    return sorted(out)


def vectors(seed, n=240, dims=12, clusters=6):
    pick = random.Random(seed)
    centres = [[pick.gauss(0, 1) for _ in range(dims)] for _ in range(clusters)]
    rows = []
    for k in range(n):
        label = 0 if k % 3 == 0 else pick.randint(0, 4)
        centre = centres[(label + pick.randint(0, 1)) % clusters]
        rows.append((k, label, [c + pick.gauss(0, 0.3) for c in centre]))
    return rows


def found(spark, rows, anchors, parts=3, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in hn.hard_negatives(df, anchors, **options).collect())


@pytest.mark.parametrize(("block", "anchor_rows", "step", "few"), [(8192, 256, 8, 64), (17, 5, 2, 3)])
def test_equals_scoring_every_pair(spark, monkeypatch, block, anchor_rows, step, few):
    for name, value in (("BLOCK_ROWS", block), ("ANCHOR_ROWS", anchor_rows)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(1)
    assert found(spark, rows, F.col("id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        *vectors(2, 60, 5),
        (None, 1, [1.0] * 5), (100, None, [1.0] * 5), (101, 1, None), (102, 1, [1.0, None, 0.0, 0.0, 0.0]),
        (103, 1, [nan] * 5), (104, 1, [inf, 0.0, 0.0, 0.0, 0.0]), (105, 1, [1.0, 2.0]), (106, 2, []), (110, 3, []),
        (200, 1, [0.0] * 5), (210, 9, [1.0] * 5),
    ]
    rows += [(300 + k, k % 2, [0.5, 0.25, -0.125, 1.0, 2.0]) for k in range(30)]  # ties
    rows += [(10, 0, rows[10][2]), (7, 1, rows[7][2]), (7, 1, rows[7][2])]  # repeated rows
    anchors = lambda i: i % 10 == 0
    assert found(spark, rows, F.col("id") % 10 == 0) == brute(rows, anchors)
    assert found(spark, rows, F.lit(False)) == []
    assert found(spark, rows[:0], F.lit(True)) == []


def test_parameters_and_other_columns(spark):
    rows = vectors(3, 90, 7)
    df = spark.createDataFrame([(i, lab, v, "x", 1, 2) for i, lab, v in rows], "`my id` bigint, kind int, `v``1` array<float>, id string, row int, score int")
    ours = hn.hard_negatives(df, F.col("id") < 9, "my id", "kind", "v`1", scale=1000, positives=2, negatives=3, window=(50, 90))
    assert sorted(tuple(r) for r in ours.collect()) == brute(rows, lambda i: i < 9, 2, 3, (50, 90), 1000)


def test_bounds_never_lose_a_result_and_spare_work():
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 300, (8, 48))
    labels = rng.integers(0, 8, 4000)
    cells = (centres[labels] + rng.normal(0, 20, (4000, 48))).astype(np.int64).T.copy()
    block = hn.Block(np.arange(4000), labels, np.arange(4000), cells)
    left = []
    for a in range(0, 4000, 400):
        anchor = cells[:, a]
        exact = anchor @ cells
        places, score = hn.best_positives(anchor, labels[a], a, block, 5)
        assert (exact[places] == score).all()
        mine = np.flatnonzero((labels == labels[a]) & (np.arange(4000) != a))
        best = mine[np.lexsort((mine, -exact[mine]))[:5]]
        assert set(best) <= set(places)
        highs = np.sort(exact[best])
        lows = -(-highs * 80 // 100)
        places, score = hn.best_negatives(anchor, labels[a], lows, highs, block, 5)
        assert (exact[places] == score).all()
        others = np.flatnonzero(labels != labels[a])
        for low, high in zip(lows, highs, strict=True):
            inside = others[(exact[others] >= low) & (exact[others] <= high)]
            assert set(inside[np.lexsort((inside, -exact[inside]))[:5]]) <= set(places)
        left.append(len(places))
    assert max(left) < 2000


def test_the_scan_stops_reading_once_few_are_left(monkeypatch):
    """Dimensions are read for the candidates that are left only."""
    cells = np.zeros((64, 1000), np.int64)
    cells[0] = np.arange(1000)
    block = hn.Block(np.arange(1000), np.zeros(1000, np.int64), np.arange(1000), cells)
    anchor = np.ones(64, np.int64)
    anchor[0] = 50
    seen = []

    def cut(candidates, least, most):
        seen.append(len(candidates))
        return most >= np.partition(least, len(least) - 5)[len(least) - 5]

    places, score = hn.scan(anchor, block, np.arange(1000), cut)
    assert places.tolist() == [995, 996, 997, 998, 999] and score.tolist() == [50 * k for k in places]
    assert seen == [1000, 5]
