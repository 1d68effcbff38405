"""Encoding and counting against the public libraries."""

import hashlib
import json
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from hourglass.llm import bpe, token_count, units

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
ODD = ["", " ", "  ", "a", " a", "a  b", "a \n b\n\n", "\n", "don't we'll 'twas ''s'rex", "x" * 300, "ab" * 200, "aaaa" * 77 + "b",
       "12 345  6\t7", "éa ñ ß 漢字かな交じり 🙂🙂 ﷽", "a b  c", "a\x1cb \x1d c", "՘࢏౜ Ᲊx", "<|endoftext|>",
       "a <|endoftext|> b<|endoftext|><|endoftext|>", "  <|endoftext|>  ", "=" * 1000 + " " * 50, "\x00\x7f\u0085 ﻿", "a" * 5000,
       "".join(chr(0x558 + k * 97) for k in range(400))]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    alphabet = ["a", "the", " ", "  ", "\n", "'s", "'", "ll", "é", "ing", "9", "…", "　", "Z", "ou", "-", "_", "🙂", "tion"]
    return ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(1500)]


def test_encoding_is_the_librarys(texts):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    held = type("Held", (), {"value": ("p", P.PATTERN, RANKS)})
    encode = bpe._coder(held)[1]
    for text in texts:
        ids = b"".join(encode(text))
        assert [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] == library.encode_ordinary(text)


def test_tree_equals_plain_merging_wherever_it_is_cut():
    coder, rng = bpe.Bpe(RANKS), random.Random(3)
    for _ in range(300):
        data = bytes(rng.choices(b"aaaabcn \xc3\xa9e", k=rng.randint(2, 200)))
        whole = coder.plain(data)
        cut = rng.randint(1, len(data) - 1)
        assert coder.tree(data) == whole == coder.join(coder.tree(data[:cut]), coder.tree(data[cut:]))
        assert b"".join(coder.bytes_of[i] for i in whole) == data


def test_counts_are_the_librarys(texts):
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    counter = token_count.Counter(json.load(open(path, encoding="utf-8")), token_count.newer_characters())
    for text in texts:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_state_maps_compose():
    path = P.path("byte_bpe_50k.json")
    machine = token_count.Counter(json.load(open(path, encoding="utf-8")), "").machine
    data = "internationalisation".encode() * 3
    whole = machine.run(data)
    for cut in range(len(data)):
        state, n = machine.run(data[:cut])
        after, m = machine.run(data[cut:], state)
        assert (after, n + m) == whole


def test_whether_tokens_stay_apart():
    """The walk along two edges gives what merging anew gives."""
    machine, rng = token_count.Counter(json.load(open(P.path("byte_bpe_50k.json"), encoding="utf-8")), "").machine, random.Random(4)
    tokens = sorted(machine.tokens)
    short = [t for t in tokens if len(t) < 4]
    assert machine.ordered
    for _ in range(20_000):
        a, b = (rng.choice(rng.choice((tokens, short))) for _ in "ab")
        assert machine._apart(a, b) == (machine.plain(a + b) == [a, b])


def test_memo_keeps_what_is_asked_for(monkeypatch):
    monkeypatch.setattr(units, "MEMO_ENTRIES", 8)
    made = []
    memo = units.Memo(lambda x: made.append(x) or len(x), "")
    for k in range(100):
        assert memo["often"] == 5 and memo[f"once{k}"] == len(f"once{k}")
    assert made.count("often") == 1 and len(memo) + len(memo.older) <= 16


def test_queries_are_the_librarys(spark):
    """Both registered queries on their whole table."""
    at = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").collect())
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    got = bpe.op4_bpe(spark, at).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest())
    other = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = token_count.op10_token_count(spark, at).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(other.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 512)


def test_frames(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "hello  world\n", "z"), (3, "hello  world\n", "z"), (None, "a" * 70000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.digests(bpe.decode(bpe.encode(docs))).collect()
    assert sorted((r.doc_id or 0, r.decoded_sha256) for r in got) == sorted(
        (a or 0, hashlib.sha256((t or "").encode()).hexdigest()) for a, t, _ in rows)
    assert sorted(map(str, bpe.digests(bpe.round_trip(docs)).collect())) == sorted(map(str, got))
    counts = token_count.count_tokens(docs).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in counts) == sorted(
        (r.doc_id or 0, len((t or "").encode()), r.n_tokens) for r, (_, t, _) in zip(got, rows))
    assert bpe.encode(docs.limit(0)).count() == 0 == token_count.count_tokens(docs.limit(0)).count()
