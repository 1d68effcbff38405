"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints.  Words are separated by ASCII white space, A-Z in lower case.
Each ``width`` consecutive words, joined by spaces and counted as often as
they occur, are a shingle (a shorter text is one shingle, a text without words
has fingerprint zero).  A bit is set if it is set in over half the shingles'
XXH64 (seed 42).

Links.  Two fingerprints link at ``distance`` or fewer differing bits.  The 64
bits are grouped into ``parts`` so that correlated bits stand together.  If
each fingerprint is given thresholds, one per part, that add up to
``distance - parts + 1`` (-1: the part is not probed), then any fingerprint
that it links to is within the threshold in at least one part.  Each
fingerprint takes the thresholds that make its estimated candidates fewest,
found by dynamic programming over the parts; the estimates come from counts of
the values of each part's two blocks, over all distinct fingerprints.  It
probes the index of part values at every value within its thresholds, and
each candidate is verified on all 64 bits.

Skew.  Copies share a fingerprint, so the index holds distinct fingerprints
only.  A part value with more than ``crowd`` fingerprints is not joined: all
fingerprints that stand there or probe it look for partners through the
values within half the distance of their own instead, of which linked
fingerprints share at least one.  Groups of equal such values are small by
construction, and rows grow in proportion to the fingerprints, never with the
square of a group.

Components are found on the distinct fingerprints by ``components.connect``.

Edge cases: a null or empty text has fingerprint zero; repeated rows and ids
give repeated rows; rows with a null id take part, and a component all of
whose ids are null has a null ``component_id``; an empty table gives an empty
result.  Only the id and text columns are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import map_rows, saved, table
from hourglass.llm.components import connect

BITS = 64
WIDTH, DISTANCE = 3, 2
PARTS, CROWD = 3, 64
SHINGLES_AT_ONCE = 1 << 16

_LOWER = bytes(range(256)).lower()


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[:len(words) - width + 1], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    hash_of, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        hashes = np.array([hash_of(line[a:b], 42) for a, b in zip(starts[part].tolist(), ends[part].tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                 keep: list[str] | None = None) -> DataFrame:
    """``doc_id``, the columns ``keep`` and ``fp``, the 64 bits as a signed long."""

    def make():
        return lambda text: (fingerprint(text, width),)

    return map_rows(docs, [text_col], make, "fp bigint", [id_col, *(keep or [])]).withColumnRenamed(id_col, "doc_id")


# --- what the plan of the parts is made from: counts of fixed size over all fingerprints
def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _pair_counts(fps: DataFrame) -> np.ndarray:
    """64 x 64: in how many fingerprints both bits are set."""

    def count(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy()).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        yield pd.DataFrame({"cell": np.arange(BITS * BITS), "n": total.ravel()})

    rows = fps.select("fp").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS)
    for cell, n in rows:
        out[cell] = n
    return out.reshape(BITS, BITS)


def group_bits(pairs: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size.  Each group starts with
    the free bit most correlated to others and takes the bit most correlated
    to what it holds."""
    p = np.diag(pairs) / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    cov = pairs / max(n, 1) - np.outer(p, p)
    corr = np.abs(np.divide(cov, spread, out=np.zeros_like(cov), where=spread > 0))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = -(-len(free) // (parts - k))
        left = sorted(free)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        while len(group) < size:
            left = [b for b in left if b not in group]
            group.append(max(left, key=lambda b: (corr[b, group].sum(), -b)))
        free -= set(group)
        groups.append(sorted(group))
    return groups


def _value(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.int64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.int64(b)) & 1) << np.int64(k)
    return out


def _blocks(groups: list[list[int]]) -> list[list[int]]:
    """Each part's bits in two blocks, whose values can be counted in tables of fixed size."""
    return [half for g in groups for half in (g[:len(g) // 2], g[len(g) // 2:])]


def _block_counts(fps: DataFrame, blocks: list[list[int]]) -> list[np.ndarray]:
    def count(batches):
        total = [np.zeros(1 << len(b), np.int64) for b in blocks]
        for batch in batches:
            fp = batch["fp"].to_numpy()
            for t, b in zip(total, blocks):
                t += np.bincount(_value(fp, b), minlength=len(t))
        for k, t in enumerate(total):
            at = np.flatnonzero(t)
            yield pd.DataFrame({"block": np.int32(k), "value": at.astype(np.int32), "n": t[at]})

    out = [np.zeros(1 << len(b)) for b in blocks]
    rows = fps.select("fp").mapInPandas(count, "block int, value int, n long")
    for block, value, n in rows.groupBy("block", "value").agg(F.sum("n").alias("n")).collect():
        out[block][value] = n
    return out


def _rings(counts: np.ndarray, distance: int) -> list[np.ndarray]:
    """For each value, how many have a value at exactly 0, 1, ... ``distance`` differing bits."""
    at, width = np.arange(len(counts)), int(len(counts)).bit_length() - 1
    return [sum((counts[at ^ sum(1 << b for b in flips)] for flips in combinations(range(width), d)),
                np.zeros(len(counts))) for d in range(distance + 1)]


class Plan:
    """The parts and, for any fingerprints, their thresholds."""

    def __init__(self, groups: list[list[int]], counts: list[np.ndarray], n: int, distance: int):
        self.groups, self.blocks, self.n, self.distance = groups, _blocks(groups), max(n, 1), distance
        self.rings = [_rings(c, distance) for c in counts]
        self.flips = [[sum(1 << b for b in f) for d in range(distance + 1) for f in combinations(range(len(g)), d)]
                      for g in groups]
        self.balls = [[sum(1 for _ in combinations(range(len(g)), d)) for d in range(distance + 1)] for g in groups]

    def costs(self, fp: np.ndarray, part: int) -> np.ndarray:
        """Rows: thresholds -1, 0, ... ``distance``; probes plus estimated candidates."""
        a, b = ([ring[_value(fp, self.blocks[2 * part + k])] for ring in self.rings[2 * part + k]] for k in (0, 1))
        out, total = [np.zeros(len(fp))], np.zeros(len(fp))
        for d in range(self.distance + 1):
            total = total + sum(a[i] * b[d - i] for i in range(d + 1)) / self.n + self.balls[part][d]
            out.append(total)
        return np.array(out)

    def thresholds(self, fp: np.ndarray) -> np.ndarray:
        """One row per part: the thresholds of least cost whose sum is
        ``distance - parts + 1``, by dynamic programming over the parts."""
        m, t = len(self.groups), self.distance
        steps = t + 2  # thresholds + 1: 0 ... distance + 1; their sum is distance + 1
        best, picked = np.full((steps, len(fp)), np.inf), []
        best[0] = 0
        for part in range(m):
            cost, new = self.costs(fp, part), np.full((steps, len(fp)), np.inf)
            pick = np.zeros((steps, len(fp)), np.int8)
            for total in range(steps):
                for own in range(total + 1):
                    found = best[total - own] + cost[own]
                    less = found < new[total]
                    new[total][less], pick[total][less] = found[less], own
            best = new
            picked.append(pick)
        total, out = np.full(len(fp), t + 1), np.zeros((m, len(fp)), np.int64)
        for part in reversed(range(m)):
            out[part] = picked[part][total, np.arange(len(fp))]
            total = total - out[part]
        return out - 1

    def index(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = [_value(fp, g) | (np.int64(k) << np.int64(40)) for k, g in enumerate(self.groups)]
        return np.concatenate(keys), np.tile(fp, len(keys))

    def probes(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, own = [], []
        for k, (group, chosen) in enumerate(zip(self.groups, self.thresholds(fp))):
            flips, ball = np.array(self.flips[k], np.int64), np.cumsum(self.balls[k])
            value = _value(fp, group) | (np.int64(k) << np.int64(40))
            for t in range(self.distance + 1):
                at = np.flatnonzero(chosen == t)
                keys.append((value[at][:, None] ^ flips[None, :ball[t]]).ravel())
                own.append(np.repeat(fp[at], ball[t]))
        return np.concatenate(keys), np.concatenate(own)


ROWS = 4096


def _keys(fps: DataFrame, plan: Plan, kind: str) -> DataFrame:
    held = fps.sparkSession.sparkContext.broadcast(plan)

    def run(batches):
        make = getattr(held.value, kind)
        for batch in batches:
            fp = batch["fp"].to_numpy()
            for at in range(0, len(fp), ROWS):
                key, own = make(fp[at:at + ROWS])
                yield pd.DataFrame({"key": key, "fp": own})

    return fps.select("fp").mapInPandas(run, "key long, fp long")


def _near(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def links(fps: DataFrame, n: int, *, distance: int = DISTANCE, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fps``; of a crowded
    value's links, enough to connect the same fingerprints."""
    groups = group_bits(_pair_counts(fps), n, parts)
    plan = Plan(groups, _block_counts(fps, _blocks(groups)), n, distance)
    index, probes = saved(_keys(fps, plan, "index"), "index"), saved(_keys(fps, plan, "probes"), "probes")
    crowded = saved(index.groupBy("key").count().where(F.col("count") > crowd).select("key"), "crowded")
    rest = index.join(crowded, "key", "left_anti").withColumnRenamed("fp", "a")
    asked = probes.join(crowded, "key", "left_anti").withColumnRenamed("fp", "b")
    found = (rest.join(asked, (rest["key"] == asked["key"]) & (F.col("a") != F.col("b")) & _near("a", "b", distance))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    there = index.union(probes).join(crowded, "key", "left_semi").select("fp").distinct()
    return found.union(_by_halves(there, distance)).distinct()


def _by_halves(fps: DataFrame, distance: int) -> DataFrame:
    """Fingerprints within ``distance`` share a value that lies within half of
    it, rounded down, of one and half of it, rounded up, of the other: each is
    grouped under all values within the larger half.  Under one value the
    smallest fingerprint within the smaller half, if there is any, is close
    enough to all the others, so a star from it links what is linked there.
    The distinct fingerprints under one value are at most as many as the values."""
    low, half = distance // 2, -(-distance // 2)
    flips = [(sum(1 << b for b in f), d > low) for d in range(half + 1) for f in combinations(range(BITS), d)]
    signed = F.array(*(F.struct(F.lit(f - (1 << 64) if f >= 1 << 63 else f).alias("flip"), F.lit(far).alias("far")) for f, far in flips))
    values = F.explode(F.transform(signed, lambda x: F.struct(x["flip"].bitwiseXOR(F.col("fp")).alias("value"), x["far"].alias("far")))).alias("at")
    met = fps.select("fp", values).groupBy("at.value").agg(F.sort_array(F.collect_set("fp")).alias("fps"),
                                                           F.min(F.struct("at.far", "fp")).alias("first")).where(F.size("fps") > 1)
    pairs = met.where(~F.col("first.far")).select(F.col("first.fp").alias("a"), F.explode("fps").alias("b")).where(F.col("a") != F.col("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    distance: int = DISTANCE, parts: int = PARTS, crowd: int = CROWD,
                    keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``fp``, ``component_id``, the
    component's ``root`` (its smallest fingerprint) and the columns ``keep``."""
    marked = saved(fingerprints(docs, id_col=id_col, text_col=text_col, width=width, keep=keep), "fingerprints")
    distinct = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    found = saved(links(distinct, distinct.count(), distance=distance, parts=parts, crowd=crowd), "links")
    roots = connect(found)
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = saved(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(rooted.join(ids, "root").select("fp", "component_id", "root"), "fp").select(
        "doc_id", "fp", "component_id", "root", *(keep or []))


def op1_simhash(spark, sf_dir):
    """Per document: fingerprint in hexadecimal, smallest doc_id it is linked to."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
