"""Decontamination against brute force, in one and in several automata."""

import random
import re

import pytest

from hourglass.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items, window):
    words, hit, found = WORD.findall(low(text)), set(), set()
    for item_id, item in items:
        own = WORD.findall(low(item))
        for at in range(max(1, len(own) - window + 1) if own else 0):
            gram = own[at:at + window]
            for p in range(len(words) - len(gram) + 1):
                if words[p:p + len(gram)] == gram:
                    hit |= set(range(p, p + len(gram)))
                    found.add(item_id)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_against_brute_force(spark, limit):
    rng = random.Random(2)
    vocabulary = ["a", "B", "ça", "Éa", "x1", "zz", "漢字"]
    line = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "-", "\n\x00"]) for _ in range(n))
    items = [(i, line(rng.choice([2, 3, 5, 9]))) for i in range(12)] + [(90, None), (91, " ?! "), (3, "a a a"), (3, "a a a")]
    docs = [(i, line(rng.randint(0, 60)), "w") for i in range(60)] + [(100, None, "w"), (101, "", "w"), (102, "a " * 30000, "w"), (None, "a a a a", "w")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, found string")
    held = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in D.decontaminate(frame, held, window=4, max_automaton_bytes=limit).collect()}
    assert len(got) == len(docs)
    for doc_id, text, _ in docs:
        r = got[doc_id]
        n_words, n_hit, ids = brute(text[:400] if doc_id == 102 else text, items, 4)
        if doc_id == 102:
            n_words, n_hit = 30000, 30000
        assert (r.n_words, r.n_hit, r.item_ids) == (n_words, n_hit, ids)
        assert sum(len(WORD.findall(low(text[s.start:s.end]))) for s in r.spans) == n_hit
    assert D.decontaminate(frame, held.limit(0)).where("n_hit > 0").count() == 0
    assert D.decontaminate(frame.limit(0), held).count() == 0
