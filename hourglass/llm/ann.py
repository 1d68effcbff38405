"""Approximate nearest neighbours by a hierarchical k-means tree with
best-bin-first traversal.

The tree is fitted on a bounded sample of the different vectors, scaled to
length one: each node's vectors are split by k-means until a leaf is expected
to hold about ``leaf_rows`` of all rows or its sample is small.  Every vector
is then filed under one leaf.  A query walks the tree through a priority queue
of nodes, the nearest centre first, and takes leaves as they come out.  How
many leaves are visited is calibrated: for a bounded number of queries the
true neighbours are found by brute force over all rows, and the visits are
widened, doubling, until the wanted share of them lies in visited leaves.  A
query goes on beyond that while its leaves hold fewer than ``k + 1`` ids, so each has ``k``
neighbours if there are that many candidates.

Scores are cosines in double precision on the original vectors.  Equal
vectors have equal scores, so each different vector is filed once with its
``k + 1`` smallest ids, which are all that any result can hold of them.

Skew.  Equal vectors are cut to their smallest ids before the shuffle.  Leaves that
are neighbours in the tree share a block of bounded rows, a leaf with more has
several, and a block's queries come in slices of bounded size; each block and
slice is scored as one group, which hands on ``k`` rows a query.

Edge cases: vectors that are null, empty or zero, or hold null or non-finite
components, take no part, nor do rows with a null id or another dimension than
the most common one; repeated rows count once, rows with the query's own id
are never its neighbours; ties go to the smaller id; fewer candidates than
``k`` are all returned; an empty table gives an empty result.  Only the id and
vector columns are read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.llm.common import saved, table

K = 5
SAMPLE_ROWS, LEAF_ROWS, BRANCH, ROUNDS = 20_000, 256, 16, 8
CALIBRATION_QUERIES, RECALL = 128, 0.98
BLOCK_ROWS, BLOCK_QUERIES, QUERIES_AT_ONCE = 8192, 2048, 64
NOT_VISITED = -9.0
TIE = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in column])


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of one vector with each row; the same for equal rows wherever they stand."""
    return (rows * query).sum(axis=1) / (np.sqrt((query * query).sum()) * np.sqrt((rows * rows).sum(axis=1)))


@dataclass
class Tree:
    """Node 0 is the root; a node without children is a leaf."""

    centres: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)])
    children: list[list[int]] = field(default_factory=lambda: [[]])

    def leaves(self) -> int:
        return sum(not c for c in self.children)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: the nearest child, again and again."""
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node] or not len(rows):
                out[rows] = node
                continue
            near = (x[rows] @ np.array([self.centres[c] for c in self.children[node]]).T).argmax(axis=1)
            todo += [(c, rows[near == k]) for k, c in enumerate(self.children[node])]
        return out

    def visit(self, query: np.ndarray, leaves: int, held: dict[int, int] | None = None, least: int = 0) -> list[int]:
        """The first ``leaves`` leaves, best bin first, and more of them while
        those hold fewer than ``least`` ids (``held``: ids in each leaf)."""
        out, queue, ids = [], [(0.0, 0)], 0
        while queue and (len(out) < leaves or held is not None and ids < least):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                out.append(node)
                ids += held.get(node, 0) if held else 0
                continue
            for c, near in zip(kids, np.array([self.centres[c] for c in kids]) @ query):
                heapq.heappush(queue, (-near, c))
        return out


def _split(x: np.ndarray, branch: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """K-means on the sphere, started from spread-out rows."""
    centres = [x[rng.integers(len(x))]]
    for _ in range(1, branch):
        away = np.maximum(1 - (x @ np.array(centres).T).max(axis=1), 0)
        if away.sum() <= 1e-12:
            break
        centres.append(x[rng.choice(len(x), p=away / away.sum())])
    centres = np.array(centres)
    for _ in range(ROUNDS):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centres)
    return centres, (x @ centres.T).argmax(axis=1)


def fit(sample: np.ndarray, rows: int, *, leaf_rows: int = LEAF_ROWS, branch: int = BRANCH, seed: int = 7) -> Tree:
    tree, rng = Tree(), np.random.default_rng(seed)
    if not len(sample):
        return tree
    x, each = unit(sample), rows / len(sample)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, own = todo.pop()
        if len(own) * each <= leaf_rows or len(own) < 2 * branch:
            continue
        centres, near = _split(x[own], min(branch, max(2, round(len(own) * each / leaf_rows))), rng)
        used = [k for k in range(len(centres)) if (near == k).any()]
        if len(used) < 2:
            continue
        for k in used:
            tree.children[node].append(len(tree.centres))
            tree.centres.append(centres[k])
            tree.children.append([])
            todo.append((tree.children[node][-1], own[near == k]))
    return tree


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and vec, an array of doubles, of the rows that take part."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    found = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    found = found.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    found = found.where(F.forall("vec", finite) & F.exists("vec", lambda x: x != 0)).distinct()
    sizes = found.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return found.where(F.size("vec") == (sizes[0]["size"] if sizes else 0))


def _filed(distinct: DataFrame, held) -> DataFrame:
    def run(batches):
        for pdf in batches:
            if len(pdf):
                pdf["leaf"] = held.value.assign(unit(matrix(pdf["vec"])))
                yield pdf

    return distinct.mapInPandas(run, "vec array<double>, ids array<long>, leaf long")


def _nearest(query: np.ndarray, own: int, rows: np.ndarray, near: np.ndarray, ids, k: int) -> list[tuple[int, float, int]]:
    """(id, score, row) of the ``k`` best other ids, from rough scores ``near``."""
    least = np.partition(near, len(near) - k - 1)[len(near) - k - 1] if len(near) > k + 1 else NOT_VISITED
    at = np.flatnonzero((near >= least - TIE) & (near > NOT_VISITED))
    found = [(-s, int(i), r) for s, r in zip(cosines(query, rows[at]), at.tolist()) for i in ids[r] if i != own]
    return [(i, -s, r) for s, i, r in heapq.nsmallest(k, found)]


def _truth(filed: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> dict[int, list[int]]:
    """The leaves of the true neighbours of a few queries, from all rows."""
    held = filed.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        queries = held.value
        for pdf in batches:
            if len(pdf):
                rows = matrix(pdf["vec"])
                near = unit(np.array([q for _, q in queries])) @ unit(rows).T
                found = [(n, i, s, int(pdf["leaf"].iloc[r])) for n, (own, q) in enumerate(queries)
                         for i, s, r in _nearest(q, own, rows, near[n], pdf["ids"].tolist(), k)]
                yield pd.DataFrame(found, columns=["query", "id", "score", "leaf"])

    found = filed.mapInPandas(run, "query long, id long, score double, leaf long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).collect()
    out: dict[int, list[int]] = {n: [] for n in range(len(queries))}
    for r in best:
        out[r["query"]].append(r["leaf"])
    return out


def calibrate(tree: Tree, queries: list[tuple[int, np.ndarray]], truth: dict[int, list[int]], recall: float) -> int:
    """Leaf visits, doubled until the wanted share of true neighbours is in visited leaves."""
    every, visits = tree.leaves(), 1
    paths = [tree.visit(q, every) for q in unit(np.array([q for _, q in queries]))]
    while visits < every:
        hits = [leaf in seen for n, path in enumerate(paths) for seen in [set(path[:visits])] for leaf in truth[n]]
        if not hits or sum(hits) / len(hits) >= recall:
            break
        visits *= 2
    return min(visits, every)


def _ids_in_leaves(filed: DataFrame) -> dict[int, int]:
    """Leaf -> ids filed there: a row per leaf, so bounded by the sample that the tree was fitted on."""
    return {r["leaf"]: r["n"] for r in filed.groupBy("leaf").agg(F.sum(F.size("ids")).alias("n")).collect()}


def _blocks(filed: DataFrame) -> DataFrame:
    """leaf, first, parts: leaves next to each other in the tree share a block
    of about ``BLOCK_ROWS`` rows; a leaf with more rows has ``parts`` blocks of
    its own, numbered from ``first``."""
    rows, block, held = [], 0, 0
    for leaf, n in filed.groupBy("leaf").count().orderBy("leaf").collect():
        parts = -(-n // BLOCK_ROWS)
        if held and held + n > BLOCK_ROWS:
            block, held = block + 1, 0
        if held and parts > 1:
            block, held = block + 1, 0
        rows.append((leaf, block, parts))
        block, held = (block, held + n) if parts == 1 else (block + parts, 0)
    return filed.sparkSession.createDataFrame(rows, "leaf long, first long, parts long")


def search(rows: DataFrame, *, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS, recall: float = RECALL,
           calibration_queries: int = CALIBRATION_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``is_query`` (a condition
    on column vec_id) its ``k`` nearest found."""
    spark = rows.sparkSession
    valid = saved(usable(rows, id_col, vec_col), "vectors")
    first = Window.partitionBy("vec").orderBy("vec_id")
    few = valid.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    distinct = saved(few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "distinct")
    n, place = distinct.count(), F.xxhash64("vec")
    sample = matrix(r["vec"] for r in distinct.orderBy(place).limit(sample_rows).collect())
    tree = fit(sample, n, leaf_rows=leaf_rows)
    held = spark.sparkContext.broadcast(tree)
    filed = saved(_filed(distinct, held), "filed")
    queries = valid.where(is_query)
    tried = [(r["vec_id"], np.array(r["vec"])) for r in queries.orderBy(F.xxhash64("vec", "vec_id")).limit(calibration_queries).collect()]
    visits = calibrate(tree, tried, _truth(filed, tried, k), recall) if tried else 1

    sizes = spark.sparkContext.broadcast(_ids_in_leaves(filed))

    def walk(batches):
        for pdf in batches:
            if len(pdf):
                # The query's own id may be among the ids held, so one more than wanted.
                pdf["leaf"] = [held.value.visit(q, visits, sizes.value, k + 1) for q in unit(matrix(pdf["vec"]))]
                yield pdf

    asked = queries.mapInPandas(walk, "vec_id long, vec array<double>, leaf array<long>")
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query"), F.explode("leaf").alias("leaf"))
    blocks = F.broadcast(_blocks(filed))  # a row per leaf: bounded by the sample that the tree was fitted on
    left = filed.join(blocks, "leaf").select((F.col("first") + F.pmod(place, F.col("parts"))).alias("block"), "leaf", "vec", "ids")
    # A query goes to a block once, with all leaves that it visits there.
    own = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1)).alias("block")
    asked = asked.join(blocks, "leaf").select("query_id", "query", "leaf", own)
    right = saved(asked.groupBy("block", "query_id", "query").agg(F.collect_set("leaf").alias("leaves")), "asked")
    slices = saved(right.groupBy("block").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("slices")), "slices")
    left = left.join(slices, "block").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), "leaf", "vec", "ids")
    right = right.join(slices.withColumnsRenamed({"block": "of_block", "slices": "n"}), F.col("block") == F.col("of_block")).select(
        "block", F.pmod(F.xxhash64("query_id"), F.col("n")).alias("slice"), "query_id", "query", "leaves")

    def score(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(data) and len(asked):
            data = data.sort_values("leaf", kind="stable")
            rows, ids, leaf = matrix(data["vec"]), data["ids"].tolist(), data["leaf"].to_numpy()
            scaled = unit(rows)
            for at in range(0, len(asked), QUERIES_AT_ONCE):
                part = asked.iloc[at:at + QUERIES_AT_ONCE]
                queries, visited = matrix(part["query"]), [set(v) for v in part["leaves"]]
                near = np.full((len(part), len(rows)), NOT_VISITED)
                for node in sorted(set(leaf.tolist())):
                    a, b = np.searchsorted(leaf, [node, node + 1])
                    own = [k for k, v in enumerate(visited) if node in v]
                    near[own, a:b] = unit(queries[own]) @ scaled[a:b].T if own else 0
                for own, q, s in zip(part["query_id"].tolist(), queries, near):
                    found += [(own, q, i, score) for i, score, _ in _nearest(q, own, rows, s, ids, k)]
        return pd.DataFrame(found, columns=["query_id", "query", "vec_id", "score"])

    keys = ["block", "slice"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        score, "query_id long, query array<double>, vec_id long, score double")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_ann(spark, sf_dir):
    """Per query (vec_id divisible by 50) its five nearest vectors."""
    return search(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 50 == 0)
