"""Removal of repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hourglass.llm import suffix_dedup as S


def brute(texts, length):
    """(removed bytes, spans, digest of the rest) of each text."""
    seen = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        out.append((int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def texts(seed, length):
    rng = random.Random(seed)
    word = lambda n, of="abcdefghij é\n": "".join(rng.choices(of, k=n))
    passages = [word(rng.randint(length - 3, 3 * length)) for _ in range(6)]
    out = [word(rng.randint(0, 4 * length)) for _ in range(15)]
    for _ in range(60):
        p = rng.choice(passages)
        a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
        out.append(word(rng.randint(0, 30)) + (p if rng.random() < 0.4 else p[a:b]) + word(rng.randint(0, 30)))
    out += [out[20], out[20], "ab" * (2 * length), "a" * (length + 5), "a" * (length - 1), word(50) + "ab" * length, "", None]
    base = word(6 * length)
    for _ in range(12):  # near copies
        at = rng.randint(0, len(base))
        out.append(base[:at] + word(3) + base[at:])
    return out


@pytest.mark.parametrize(("length", "crowd"), [(20, 1 << 20), (20, 200), (37, 1 << 20)])
def test_against_brute_force(spark, length, crowd):
    data = texts(length, length)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(data)], "doc_id long, text string, h string").repartition(5)
    got = {r.doc_id: r for r in S.remove_repeats(docs, length=length, shard_bytes=2000, crowd_bytes=crowd, keep_text=True).collect()}
    want = brute([(t or "").encode() for t in data], length)
    assert len(got) == len(data) and sum(n for n, _, _ in want) > 1000
    for i, (n, spans, digest) in enumerate(want):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len((data[i] or "").encode()), n, spans, digest), i
        assert n == 0 or hashlib.sha256(got[i].kept).hexdigest() == digest


def test_production_length(spark):
    data = texts(1, 400)
    docs = spark.createDataFrame([(None if i == 3 else i // 2, t) for i, t in enumerate(data)], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(docs).collect())
    assert got == Counter((None if i == 3 else i // 2, *w) for i, w in enumerate(brute([(t or "").encode() for t in data], 400)))
    assert S.remove_repeats(docs.limit(0)).count() == 0


def test_the_query_on_its_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    raw = [(r.doc_id, (r.text or "").encode()) for r in rows]
    seen = Counter(hash(t[p:p + 400]) for _, t in raw for p in range(len(t) - 399))
    want = []
    for doc_id, t in raw:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 399):
            if seen[hash(t[p:p + 400])] > 1:
                gone[p:p + 400] = True
        want.append((doc_id, len(t), int(gone.sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in S.op7_suffix_dedup(spark, sf).collect()]
    assert sorted(got) == sorted(want) and sum(w[2] for w in want) > 10_000


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(4)
    for _ in range(30):
        sizes = rng.integers(1, 60, 8)
        parts = [np.append(rng.integers(97, 99, n), 256 + k) for k, n in enumerate(sizes)]
        codes = np.concatenate(parts).astype(np.uint16)
        order, rank = S.suffix_array(codes)
        whole = codes.tolist()
        assert order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:]) and (rank[order] == np.arange(len(whole))).all()
        starts = np.cumsum(sizes + 1) - sizes - 1
        for here, before, size in S.common_prefixes(codes, order, rank, starts, sizes):
            for a, b, n in zip(here.tolist(), before.tolist(), size.tolist()):
                same = 0
                while b < len(whole) and a + same < len(whole) and b + same < len(whole) and whole[a + same] == whole[b + same]:
                    same += 1
                assert same == n


def test_runs_follow_the_content():
    rng = random.Random(9)
    for length in (20, 400):
        middle = rng.randbytes(3 * length)
        found = []
        for lead in (0, 7, 500):
            text = rng.randbytes(lead) + middle + rng.randbytes(100)
            h, first, last = S.runs(text, length)
            assert first[0] == 0 and last[-1] == len(text) - length and (first[1:] == last[:-1] + 1).all()
            at = np.arange(lead, lead + 2 * length + 1)
            found.append(h[np.searchsorted(first, at, "right") - 1].tolist())
        assert found[0] == found[1] == found[2]
