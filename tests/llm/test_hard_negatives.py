"""Hard negatives: against brute force, with ties, copies, odd rows and small cells; what the bounds leave out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.llm import hard_negatives as hn

DDL = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100, positives=5, negatives=10):
    own, seen = [], set()
    for i, vec, label in rows:
        if i is None or vec is None or label is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        row = (i, tuple(math.floor(256 * x) for x in vec), label)
        if row not in seen:
            seen.add(row)
            own.append(row)
    out = []
    for a, va, la in own:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in own if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:positives]:
            found = [x for x in scored if x[2] != la and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i, _) in enumerate(found)]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS place", "'x' AS positives", "2 AS cell_group", "3 AS anchor_id")
    return sorted(map(tuple, hn.mine(df, is_anchor=F.col("vec_id") % 100 == 0, **how).collect()))


def _mix(n, dims, spread, seed, scale=1.0):
    """Clusters of vectors, some of them equal, labels that partly follow the clusters."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    at = rng.integers(6, size=n)
    x = (centres[at] + spread * rng.normal(size=(n, dims))) * scale
    x[rng.random(n) < 0.2] = x[0]
    return [(int(i), [float(v) for v in np.round(row, 3)], int(c if rng.random() < 0.6 else rng.integers(5)))
            for i, (row, c) in enumerate(zip(x, at))]


@pytest.mark.parametrize("n, dims, spread, scale, how", [
    (700, 4, 0.05, 0.02, {}),                                           # few different scores: ties everywhere
    (900, 8, 0.1, 1.0, {"groups": 9, "anchors_at_once": 2}),      # many cells
    (600, 16, 1.5, 1.0, {"groups": 7, "anchors_at_once": 3}),      # no structure
    (500, 4, 0.3, 2.0 ** 19, {"groups": 8})])                      # scores beyond what doubles hold exactly
def test_equal_to_brute_force(spark, n, dims, spread, scale, how):
    rows = _mix(n, dims, spread, n, scale)
    want = brute(rows)
    assert want and mined(spark, rows, **how) == want


def test_odd_rows(spark):
    rows = _mix(240, 4, 0.3, 1)
    odd = [(None, [1.0] * 4, 1), (300, None, 1), (301, [1.0] * 4, None), (302, [1.0, None, 1.0, 1.0], 1),
           (303, [float("nan")] * 4, 2), (400, [float("inf")] * 4, 2), (304, [0.0] * 4, 2), (500, [0.0] * 4, 3)]
    assert mined(spark, rows + odd + rows[:30]) == brute(rows + odd)
    other = [(600, [1.0], 1), (601, [], 1), (602, [1e30] * 4, 1), (700, [5e8] * 4, 2)]  # another size, or too long
    assert mined(spark, rows + other) == brute(rows)


def test_few_rows_and_none(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [-1.0], 2)]) == [(0, 1, 1, 2, 65536, 32768)]
    assert mined(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []  # a negative score has no window


def test_bounds_leave_rows_out_and_hold():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16)) * 256
    x = np.floor(centres[rng.integers(20, size=4000)] + rng.normal(size=(4000, 16)) * 4).astype(np.int64)
    anchors = x[:60]
    tree, seen, scored = hn.spanning_tree(anchors), set(), 0
    assert sorted(a for a, _, _ in tree) == list(range(60))

    def wanted(a, low, high):
        exact = x @ anchors[a]
        assert (low <= exact).all() and (exact <= high).all()
        return high >= np.partition(low, 3990)[3990]

    for a, places, scores in hn.walk(tree, anchors, x, wanted):
        exact = x @ anchors[a]
        assert (scores == exact[places]).all() and set(np.argsort(-exact)[:10]) <= set(places) | set(np.flatnonzero(exact == np.sort(exact)[-10]))
        seen.add(a)
        scored += len(places)
    assert len(seen) == 60 and scored < 0.5 * 60 * 4000
