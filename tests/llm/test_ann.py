"""Nearest neighbours: recall against brute force, ties, odd vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.llm import ann


def brute(vectors, queries, k):
    """Best ids of each query, ties to the smaller id."""
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], float)
    out = {}
    for own, q in queries:
        s = ann.cosines(np.array(q, float), x)
        order = sorted(zip(-s, ids.tolist()))
        out[own] = [(i, -v) for v, i in order if i != own][:k]
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in want[q]} & {r.vec_id for r in rows}) for q, rows in got.items())
    return hits / sum(map(len, want.values()))


def by_query(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r)
    return out


@pytest.mark.parametrize("kind", ["clustered", "random"])
def test_recall(spark, kind):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 24)) if kind == "clustered" else rng.normal(size=(4000, 24))
    vectors = [(int(i), v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4)
    got = by_query(ann.search(frame, is_query=F.col("vec_id") % 50 == 0, sample_rows=1500, leaf_rows=64))
    want = brute(vectors, [v for v in vectors if v[0] % 50 == 0], 5)
    assert set(got) == set(want) and all(len(rows) == 5 for rows in got.values())
    assert recall(got, want) >= 0.9
    assert all(abs(dict(want[q]).get(r.vec_id, r.score) - r.score) < 1e-12 for q, rows in got.items() for r in rows)


def test_the_query_on_its_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = by_query(ann.op3_ann(spark, "/root/testdata/sf0.01"))
    want = brute(vectors, [v for v in vectors if v[0] % 50 == 0], 5)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    assert all([r.rank for r in rows] == [1, 2, 3, 4, 5] for rows in got.values())


def test_queries_in_tiny_leaves_find_enough(spark):
    """Outliers that sit in leaves of one or two rows."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12)) * 5
    x = centres[rng.integers(0, 6, 1500)] + 0.01 * rng.normal(size=(1500, 12))
    x[:12] = rng.normal(size=(12, 12)) * 50
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = by_query(ann.search(frame, is_query=F.col("vec_id") < 12, leaf_rows=16, recall=0.05, calibration_queries=4))
    assert len(got) == 12 and all(len(rows) == 5 for rows in got.values())


def test_ties_copies_and_odd_vectors(spark):
    same = [(i, [1.0, 2.0, 2.0]) for i in range(300, 0, -1)]
    odd = [(1000, None), (1001, []), (1002, [0.0, 0.0, 0.0]), (1003, [1.0, None, 1.0]), (1004, [1.0, math.nan, 0.0]),
           (1005, [math.inf, 1.0, 1.0]), (1006, [1.0, 1.0]), (None, [1.0, 2.0, 2.0])]
    rows = same + same[:20] + odd + [(400, [-1.0, 0.0, 0.0]), (450, [2.0, 4.0, 4.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, leaf int")
    got = by_query(ann.search(frame, is_query=F.col("vec_id") % 50 == 0, leaf_rows=8))
    assert sorted(got) == [50, 100, 150, 200, 250, 300, 400, 450]
    assert [r.vec_id for r in got[50]] == [1, 2, 3, 4, 5] == [r.vec_id for r in got[450]]
    assert all(r.score == got[50][0].score for r in got[50]) and [r.rank for r in got[50]] == [1, 2, 3, 4, 5]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (0, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.vec_id) for r in ann.search(few, is_query=F.col("vec_id") % 50 == 0).collect()] == [(0, 1)]
    assert ann.search(few.limit(0), is_query=F.col("vec_id") % 50 == 0).count() == 0


def test_best_bin_first_takes_nearer_bins_first():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 8))
    tree = ann.fit(x, len(x), leaf_rows=50, branch=4)
    q = ann.unit(x[:1])[0]
    path = tree.visit(q, tree.leaves())
    assert len(path) == len(set(path)) == tree.leaves() and path[0] == tree.assign(ann.unit(x[:1]))[0]
    assert tree.visit(q, 5) == path[:5]
