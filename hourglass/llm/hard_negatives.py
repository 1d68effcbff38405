"""Hard-negative mining with bounds along a spanning tree of the anchors.

Vectors become integers, so every score is an exact inner product.  Anchors
are dealt to blocks, candidates to groups, and each block meets each group in
one cell of bounded size.  In a cell a minimum spanning tree joins the block's
anchors.  The root is scored against all candidates.  Along an edge the score
of a candidate x changes by at most the length of the edge times the norm of
x, so a parent's score, or its bounds, plus or minus that product bound the
child's.  Only candidates whose bounds overlap a window that the child still
asks for are scored anew; the others pass their bounds on.

Two such walks are made.  The first asks for each anchor's best rows of the
same label, its positives: the window begins at the ``positives``-th best
lower bound.  The second asks, for each positive, for the best rows of other
labels whose score lies between ``low`` and ``high`` percent of the positive's
score: of that window only the part from the ``negatives``-th best lower bound
found inside it.  Each cell hands on that many rows, and a window over them
gives the best of all.

Scale.  Every row meets every anchor, as the task asks, in blocks: candidates
travel once per block of ``ANCHORS`` anchors.  A cell holds its anchors and
streams its candidates past them, ``ROWS_AT_ONCE`` at a time, so its memory is
bounded however many there are.  There are ``GROUPS`` groups, so what the cells
hand on grows with the anchors alone, and more only where a group would pass
``MOST_ROWS`` rows, which bounds the work that a lost task repeats.  Rows are
dealt by a hash over the whole row, so neither a common label nor a common
vector makes a cell larger.  On vectors without any structure the bounds
exclude little, and nearly all candidates are scored.

Edge cases: rows with a null id, label or vector, or a null or non-finite
component, take no part, nor do rows of another dimension than the most common
one, nor vectors so long that a score would not fit a long (squared integer
norm of 2^61 or more).  Repeated rows count once; a row with the anchor's own id is
neither its positive nor its negative; ties go to the smaller id; anchors
without positives, and positives without a window (a negative score has none),
give no rows; an empty table gives an empty result.  Only the id, vector and
label columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from hourglass.llm.common import saved, struct, table

SCALE = 256
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
ANCHORS = 512
GROUPS, LEAST_ROWS, MOST_ROWS = 16, 512, 1 << 22
ROWS_AT_ONCE = 8192
EXACT = 1 << 53
SLACK = 1e-9


def usable(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """vec_id, label, vec (integers) and place (a hash of the row) of the rows that take part."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    own = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                      F.col(vec_col).cast("array<double>").alias("vec"))
    own = own.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull())
    own = own.where(F.forall("vec", finite)).withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("double")))
    square = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    own = own.where(square < float(1 << 61)).withColumn("vec", F.col("vec").cast("array<int>"))
    own = own.withColumn("place", F.xxhash64("vec_id", "label", "vec"))
    first = own.groupBy("place", "vec_id", "label", "vec").agg(F.lit(0).alias("one")).drop("one")  # repeated rows once
    return first


def _of_common_size(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows of the most common dimension (of equally common ones the largest), and their number."""
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return rows, 0
    return rows.where(F.size("vec") == sizes[0]["size"]), sizes[0]["count"]


def spanning_tree(anchors: np.ndarray) -> list[tuple[int, int, float]]:
    """(anchor, parent, length of the edge), parents first; the root's parent is -1.

    Grown from anchor 0 by the shortest edge out of the tree."""
    x = anchors.astype(np.float64)
    square = (x * x).sum(axis=1)
    near, parent, out = np.full(len(x), np.inf), np.full(len(x), -1), []
    todo = np.ones(len(x), bool)
    at = 0
    for _ in range(len(x)):
        todo[at] = False
        out.append((at, int(parent[at]), float(np.sqrt(near[at])) if out else 0.0))
        away = np.maximum(square + square[at] - 2 * (x @ x[at]), 0)
        closer = todo & (away < near)
        near[closer], parent[closer] = away[closer], at
        at = int(np.where(todo, near, np.inf).argmin())
    return out


def walk(tree: list[tuple[int, int, float]], anchors: np.ndarray, rows: np.ndarray,
         wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, places, scores) for each anchor: the rows that ``wanted``
    chooses by their bounds, with their exact scores."""
    norms, of = (np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) for x in (rows, anchors))
    rounded = SLACK
    if norms.max(initial=0) * of.max(initial=0) < EXACT:  # then doubles add these products exactly
        rows, anchors, rounded = rows.astype(np.float64), anchors.astype(np.float64), 0.0
    children = np.bincount([p for _, p, _ in tree if p >= 0], minlength=len(tree))
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for at, parent, length in tree:
        if parent < 0:
            exact = rows @ anchors[at]
            low, high = exact - rounded * np.abs(exact), exact + rounded * np.abs(exact)
            places = np.flatnonzero(wanted(at, low, high))
            scores = exact[places]
        else:
            spread, most = norms * length, norms * of[at]
            spread += SLACK * (most + spread + 1)
            low, high = held[parent][0] - spread, held[parent][1] + spread
            np.maximum(low, -most * (1 + SLACK) - SLACK, out=low)
            np.minimum(high, most * (1 + SLACK) + SLACK, out=high)
            places = np.flatnonzero(wanted(at, low, high))
            scores = (rows @ anchors[at])[places] if 4 * len(places) > len(rows) else rows[places] @ anchors[at]
            low[places], high[places] = scores - rounded * np.abs(scores), scores + rounded * np.abs(scores)
            children[parent] -= 1
            if not children[parent]:
                del held[parent]
        if children[at]:
            held[at] = low, high
        yield at, places, scores.astype(np.int64)


class Best:
    """The first ``k`` (score, id) of those given, by descending score and then by id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self, floor: float) -> float:
        """The score from which a further row can still matter."""
        return max(floor, float(self.scores[-1])) if len(self.scores) == self.k else floor

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 4 * self.k:
            cut = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[scores >= cut], ids[scores >= cut]
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[first], ids[first]


def _kth(low: np.ndarray, inside: np.ndarray, k: int) -> float:
    """The k-th best of the lower bounds ``inside``: so many rows reach it for certain."""
    some = low[inside]
    return float(np.partition(some, len(some) - k)[len(some) - k]) if len(some) >= k else -np.inf


def positives_in(anchors: dict, rows: Iterator[dict], k: int) -> Iterator[tuple]:
    """(anchor, id, score): each anchor's best rows of its label."""
    tree, best = spanning_tree(anchors["vec"]), [Best(k) for _ in anchors["id"]]
    for part in rows:
        able = lambda a: (part["label"] == anchors["label"][a]) & (part["id"] != anchors["id"][a])  # noqa: B023, E731

        def wanted(a, low, high):
            own = able(a)  # noqa: B023
            return own & (high >= best[a].least(_kth(low, own, k)))

        for a, places, scores in walk(tree, anchors["vec"], part["vec"], wanted):
            best[a].add(scores, part["id"][places])
    yield from ((a, i, s) for a, found in enumerate(best) for i, s in zip(found.ids.tolist(), found.scores.tolist()))


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest integer score with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def negatives_in(anchors: dict, rows: Iterator[dict], k: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor, number of the positive, id, score): the best rows of other labels in each window."""
    tree = spanning_tree(anchors["vec"])
    asked = [[(*window_of(s, low, high), Best(k)) for s in scores] for scores in anchors["positives"]]
    for part in rows:
        def wanted(a, below, above):
            able = (part["label"] != anchors["label"][a]) & (part["id"] != anchors["id"][a])  # noqa: B023
            out = np.zeros(len(able), bool)
            for first, last, best in asked[a]:
                if first <= last:
                    sure = able & (below >= first) & (above <= last)
                    out |= able & (below <= last) & (above >= best.least(max(first, _kth(below, sure, k))))
            return out

        for a, places, scores in walk(tree, anchors["vec"], part["vec"], wanted):
            other = part["label"][places] != anchors["label"][a]
            for first, last, best in asked[a]:
                own = other & (scores >= first) & (scores <= last)
                best.add(scores[own], part["id"][places][own])
    for a, windows in enumerate(asked):
        for number, (_, _, best) in enumerate(windows):
            yield from ((a, number, i, s) for i, s in zip(best.ids.tolist(), best.scores.tolist()))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The batches, cut where (cell_block, cell_group, kind) changes, under that key."""
    names = ("cell_block", "cell_group", "kind")
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in names])
        ends = [*(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for at, end in zip([0, *ends], ends):
            for start in range(at, end, ROWS_AT_ONCE):
                yield tuple(keys[:, start].tolist()), batch.slice(start, min(ROWS_AT_ONCE, end - start))


def _columns(batch: pa.RecordBatch, labels: dict) -> dict:
    """id, label (as a number) and vec of some rows as arrays."""
    vec = batch.column("vec").flatten()
    return {"id": batch.column("vec_id").to_numpy(),
            "label": np.array([labels.setdefault(x, len(labels)) for x in batch.column("label").to_pylist()], np.int64),
            "vec": vec.to_numpy().reshape(batch.num_rows, len(vec) // max(batch.num_rows, 1)).astype(np.int64)}


def _each_cell(rows: DataFrame, anchors: DataFrame, groups: int, blocks: int, ddl: str, found_in: Callable) -> DataFrame:
    """Every block of anchors against every group of rows: what ``found_in``
    gives, behind the anchor's id and place.  A cell's anchors come first and
    are held; its rows stream by."""
    schema = struct(f"anchor_id long, anchor_place long, {ddl}")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    scores = "positives.positive_score" if "positives" in anchors.columns else F.lit(None).cast("array<long>")
    common = ["vec_id", "label", "vec", "place"]
    left = rows.select(*common, F.lit(None).cast("array<long>").alias("positives"), F.lit(1).alias("kind"),
                       F.pmod("place", F.lit(groups)).cast("int").alias("cell_group"), every(blocks).alias("cell_block"))
    right = anchors.select(*common, (F.col(scores) if isinstance(scores, str) else scores).alias("positives"), F.lit(0).alias("kind"),
                           every(groups).alias("cell_group"), F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int").alias("cell_block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        for _, cell in groupby(_slices(batches), lambda x: x[0][:2]):
            labels: dict = {}
            kinds = groupby(cell, lambda x: x[0][2])
            kind, own = next(kinds)
            if kind:
                continue  # rows that meet no anchor
            asked = pa.Table.from_batches([batch for _, batch in own]).combine_chunks().to_batches()[0]
            held = _columns(asked, labels) | {"positives": asked.column("positives").to_pylist()}
            ids, place = held["id"].tolist(), asked.column("place").to_pylist()
            parts = (_columns(batch, labels) for _, stream in kinds for _, batch in stream)  # noqa: B031
            found = [(ids[a], place[a], *rest) for a, *rest in found_in(held, parts)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), out)], schema=out)

    cells = left.unionByName(right).repartition("cell_block", "cell_group")
    return cells.sortWithinPartitions("cell_block", "cell_group", "kind").mapInArrow(run, schema)


def mine(rows: DataFrame, *, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         anchors_at_once: int = ANCHORS, groups: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score, for the rows of ``is_anchor`` (a condition on vec_id)."""
    own = saved(usable(rows, id_col, vec_col, label_col, scale), "integers")
    own, n = _of_common_size(own)
    anchors = own.where(is_anchor)
    blocks = max(1, -(-anchors.count() // anchors_at_once))
    groups = groups or max(1, min(GROUPS, n // LEAST_ROWS), n // MOST_ROWS)

    found = _each_cell(own, anchors, groups, blocks, "positive_id long, positive_score long",
                       lambda asked, parts: positives_in(asked, parts, positives))
    order = Window.partitionBy("anchor_id", "anchor_place").orderBy(F.desc("positive_score"), "positive_id")
    best = saved(found.withColumn("number", F.row_number().over(order) - 1).where(F.col("number") < positives), "positives")
    listed = best.groupBy("anchor_id", "anchor_place").agg(
        F.sort_array(F.collect_list(F.struct("number", "positive_id", "positive_score"))).alias("positives"))
    asked = anchors.join(listed, (anchors["vec_id"] == listed["anchor_id"]) & (anchors["place"] == listed["anchor_place"]))
    asked = saved(asked.select("vec_id", "label", "vec", "place", "positives"), "asked")

    found = _each_cell(own, asked, groups, blocks, "number int, negative_id long, negative_score long",
                       lambda asked, parts: negatives_in(asked, parts, negatives, low, high))
    order = Window.partitionBy("anchor_id", "anchor_place", "number").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.join(best, ["anchor_id", "anchor_place", "number"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir):
    """Per anchor (vec_id divisible by 100) and each of its five positives, the ten hardest negatives."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", label.alias("label")), is_anchor=F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH own AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, x.vec_id AS other_id, a.label = x.label AS same,
         CAST(list_dot_product(a.vec, x.vec) AS BIGINT) AS score
  FROM own a JOIN own x ON a.vec_id % 100 = 0 AND a.vec_id <> x.vec_id),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n
  ON p.anchor_id = n.anchor_id AND NOT n.same AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) <= 10
"""
