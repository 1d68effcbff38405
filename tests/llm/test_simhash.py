"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hourglass.llm import simhash
from hourglass.llm.components import connect


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    every = sorted(root)
    for i, a in enumerate(every):
        for b in every[i + 1:]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in every}


def test_fingerprint():
    rng = random.Random(1)
    words = ["Ab", "c", "É", "d e", "\x1c", "zz", "the", "漢"]
    texts = [None, "", " \t\n", "One", "one two", "a\x0bb\x0cc d"] + [
        "".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\r\t"]) for _ in range(rng.randint(1, 50))) for _ in range(200)]
    for text in texts:
        got = simhash.fingerprint(None if text is None else text.encode())
        assert got & (1 << 64) - 1 == plain_fingerprint(text)


def crowd_of_fingerprints(seed):
    rng = random.Random(seed)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(12):  # chains, and crowds around one value
        f = rng.getrandbits(64)
        for _ in range(25):
            fps.append(f)
            f ^= 1 << rng.randrange(64)
            if rng.random() < 0.6:
                f ^= 1 << rng.randrange(64)
    centre = rng.getrandbits(64)
    fps += [centre ^ 1 << rng.randrange(20) ^ 1 << rng.randrange(20) ^ 1 << rng.randrange(20) for _ in range(150)]
    return [f - (1 << 64) if f >> 63 else f for f in fps]


@pytest.mark.parametrize("crowd", [8, 10_000])
@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_connect_what_all_pairs_connect(spark, crowd, distance):
    fps = sorted(set(crowd_of_fingerprints(crowd)))
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = simhash.links(frame, len(fps), distance=distance, crowd=crowd)
    got = {r.node: r.root for r in connect(found).collect()}
    want = plain_components(fps, distance)
    assert {f: got.get(f, f) for f in fps} == want
    bad = [1 for r in found.collect() if bin((r.a ^ r.b) & (1 << 64) - 1).count("1") > distance]
    assert not bad


def test_thresholds_add_up_and_use_the_estimates():
    rng = np.random.default_rng(1)
    fps = rng.integers(-2**63, 2**63 - 1, 2000)
    fps[:1500] = (fps[:1500] & ~np.int64(0x1FFFFF)) | np.int64(77)  # one common value in the low bits
    groups = [list(range(21)), list(range(21, 42)), list(range(42, 64))]
    counts = [np.bincount(simhash._value(fps, b), minlength=1 << len(b)).astype(float) for b in simhash._blocks(groups)]
    chosen = simhash.Plan(groups, counts, len(fps), 2).thresholds(fps)
    assert (chosen.sum(axis=0) == 0).all() and chosen.min() >= -1
    assert (chosen[0][:1500] == -1).mean() > 0.9 and (chosen[:, 1500:] == 0).mean() > 0.9


def test_correlated_bits_stand_together():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 2, (500, 8))
    bits = np.repeat(shared, 8, axis=1) ^ (rng.random((500, 64)) < 0.02)
    bits = bits[:, np.argsort(np.tile(np.arange(8), 8), kind="stable")]
    groups = simhash.group_bits((bits.T @ bits).astype(float), 500, 4)
    families = [{b % 8 for b in g} for g in groups]
    assert sorted(b for g in groups for b in g) == list(range(64)) and all(len(f) == 2 for f in families)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    rng = random.Random(4)
    pairs = [p if rng.random() < 0.5 else p[::-1] for p in chain + star]
    got = {r.node: r.root for r in connect(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)}


def test_frame(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base, "x"), (3, base + " extra", "x"), (9, base.upper(), "y"), (9, base, "y"), (None, base, "z"),
            (7, None, "f"), (8, "", "g"), (6, " \n", "h"), (2, "quite another text of seven words", "h"), (None, "no id at all here", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.component_id)
    close = bin((plain_fingerprint(base) ^ plain_fingerprint(base + " extra"))).count("1") <= 2
    assert by_id[9] == {3 if close else 5} and by_id[7] == by_id[8] == by_id[6] == {6} and by_id[2] == {2}
    assert by_id[None] == {3 if close else 5, None}
    assert simhash.near_duplicates(docs.where(F.lit(False))).count() == 0


def test_a_chain_through_crowded_values_at_an_odd_distance(spark):
    """Neighbours that are neither's smallest one: a-b, b-c, c-d differ in one bit each."""
    a, b, c, d = 0b0001, 0b0011, 0b0111, 0b0110
    far = [1 << 40 | 1 << k for k in range(41, 60)]
    frame = spark.createDataFrame([(f,) for f in (a, b, c, d, *far)], "fp long")
    got = {r.node: r.root for r in connect(simhash.links(frame, 23, distance=1, crowd=0)).collect()}
    assert {got.get(f) for f in (a, b, c, d)} == {a} and not any(f in got for f in far)
