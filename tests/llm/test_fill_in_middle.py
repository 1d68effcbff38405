"""Fill-in-the-middle: the boundary set, forms and cuts against a plain version, restoring."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hourglass.llm import fill_in_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, seed=42, units=UNIT.findall, rate=50, spm=80):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    parts = units(text)
    n = len(parts)
    if not text or any(x in text for x in fim.SENTINELS) or h3 % 100 >= rate:
        return n, "plain", text, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h4 % 100 < spm:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


@pytest.mark.parametrize("offsets, kind", [
    (np.arange(5, 9000, 7), fim.ArrayContainer),
    (np.arange(0, 60000, 3), fim.BitmapContainer),
    (np.r_[0:30000, 40000:65536], fim.RunContainer)])
def test_each_kind_of_container_selects(offsets, kind):
    held = fim.container(offsets)
    assert isinstance(held, kind)
    assert [held.select(k) for k in range(0, len(offsets), 97)] == offsets[::97].tolist()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 400_000), st.sampled_from([0.0001, 0.02, 0.3, 0.9, 1.0]), st.integers(0, 1000))
def test_set_selects_every_offset(size, share, seed):
    offsets = np.flatnonzero(np.random.default_rng(seed).random(size) < share)
    held = fim.BoundarySet(offsets)
    assert len(held) == len(offsets)
    for k in {*range(0, len(offsets), max(1, len(offsets) // 50)), *([len(offsets) - 1] if len(offsets) else [])}:
        assert held.select(k) == offsets[k]


@given(st.text(alphabet="ab <PSM>\t\n  é😀", max_size=40))
def test_word_ends_are_those_of_the_units(text):
    ends, at = [], 0
    for unit in UNIT.findall(text):
        at += len(unit)
        ends.append(at)
    assert fim.word_ends(text).tolist() == ends


def _rows():
    rng = random.Random(3)
    texts = [None, "", " ", "\n\t ", "word", " word ", "a<P>b", "x <", "S> < P> <M", "<S", "é😀 ü b", "word " * 40_000, "x" * 200_000]
    texts += ["".join(rng.choice(["ab", " ", "\n", "<", "S>", "é", "😀", "<M"]) for _ in range(rng.randint(0, 60))) for _ in range(250)]
    return [(k if k % 50 else None, t) for k, t in enumerate(texts * 2)] + [(7, "again and again")] * 3


def test_forms_cuts_and_restored_texts(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS form", "2 AS output")
    got = fim.restore(fim.transform(docs)).collect()
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in got), key=key) == \
        sorted(((d, *plain(d, t)) for d, t in rows), key=key)
    assert sorted(r.restored for r in got) == sorted(t or "" for _, t in rows)
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_units_of_characters_other_seed_and_sentinels(spark):
    rows = [(k, f"one two {k} é😀" * k) for k in range(60)]
    docs = spark.createDataFrame(rows, "id long, body string")
    marks = ("[[pre]]", "[[suf]]", "[[mid]]")
    made = fim.transform(docs, id_col="id", text_col="body", seed=7, units="chars", fim_percent=100, spm_percent=30, sentinels=marks)
    got = {r.id: r for r in fim.restore(made, sentinels=marks).collect()}
    for k, text in rows:
        want = plain(k, text, 7, list, 100, 30)
        output = want[2] if want[1] == "plain" else want[2].replace("<P>", marks[0]).replace("<S>", marks[1]).replace("<M>", marks[2])
        assert (got[k].n, got[k].form, got[k].output, got[k].restored) == (want[0], want[1], output, text)


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("ab", "bc", "x"), ("a", "xay", "z"), ("", "b", "c"), ("aba", "x", "y")])
def test_sentinels_that_overlap_are_refused(marks):
    with pytest.raises(ValueError):
        fim.checked(marks)
