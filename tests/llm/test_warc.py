"""WARC round trips, magic inside payloads, broken chains."""

import base64
import hashlib
import random

import numpy as np
import pytest

from hourglass.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def rows():
    rng = random.Random(6)
    parts = ["<p>", "é🙂", "\r\n\r\n", FAKE, "WARC/1.0\r\n", "\n", "x" * 50, "Content-Length: 9\r\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 8))) for _ in range(80)]
    out = [(i, "u\r\n" if i % 3 else None, rng.choice(texts), i) for i in range(300)]
    return out + [(400, "u", None, 1), (401, "u", "", 1), (5, "u", out[5][2], 1), (500, "u", "big " * 200000, 1), (501, "u", FAKE * 50, 1)]


@pytest.mark.parametrize("limit", [0, 100_000])
def test_round_trip(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", limit)
    data = rows()
    pages = spark.createDataFrame(data, "page_id long, url string, html string, sha1 long").repartition(3)
    path = str(tmp_path / "w")
    warc.write(pages, path, file_bytes=3000)
    got = warc.read(spark, path, payload=True).collect()
    assert len(got) == len(data)
    largest = {}
    for i, _, text, _ in data:
        largest[text or ""] = max(largest.get(text or "", -1), i)
    text_of = {i: text or "" for i, _, text, _ in data}
    for r in got:
        page_id = int(r.record_id[10:-1])
        body = text_of[page_id].encode()
        assert r.payload_bytes == len(body) and r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = largest[text_of[page_id]]
        if page_id == first:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, body)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("revisit", f"<urn:page:{first}>", b"")


def test_least_length_and_null_ids(spark, tmp_path):
    pages = spark.createDataFrame([(1, None, "aa"), (2, None, "aa"), (None, None, "aaaa"), (3, None, "aaaa"), (None, None, "b"), (None, None, "b")],
                                  "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"), min_bytes=3)
    got = sorted((r.record_id, r.record_type, r.refers_to or "") for r in warc.read(spark, str(tmp_path / "w")).collect())
    assert got == [("<urn:page:1>", "response", ""), ("<urn:page:2>", "response", ""), ("<urn:page:3>", "response", ""),
                   ("<urn:page:None>", "response", ""), ("<urn:page:None>", "response", ""), ("<urn:page:None>", "revisit", "<urn:page:3>")]
    warc.write(pages.limit(0), str(tmp_path / "e"))
    assert warc.read(spark, str(tmp_path / "e")).count() == 0


def test_pointer_jumping_is_walking():
    rng = np.random.default_rng(3)
    for _ in range(200):
        starts = np.unique(np.append(rng.integers(0, 400, 60), 0))
        after = np.where(rng.random(len(starts)) < 0.1, -1, [rng.choice([*starts[starts > s], 400, 500]) for s in starts])
        last, leaves = warc.leave(starts, after)
        for k in range(len(starts)):
            at = k
            while after[at] in starts:
                at = int(np.searchsorted(starts, after[at]))
            assert last[k] == at and leaves[k] == after[at]


@pytest.mark.parametrize("range_bytes", [37, 150, 1000, 20_000])
def test_ranges_cut_anywhere(spark, tmp_path, monkeypatch, range_bytes):
    """Borders inside headers, end marks and magic; the plan sent in several turns."""
    monkeypatch.setattr(warc, "RANGES_SENT", 40)
    data = rows()[:40] + [(900, "u" * 200, FAKE * 5, 1), (901, None, "", 1)]
    warc.write(spark.createDataFrame(data, "page_id long, url string, html string, sha1 long").coalesce(1), str(tmp_path / "w"), file_bytes=6000 if range_bytes < 100 else 1 << 30)
    text = {f"<urn:page:{i}>": (t or "").encode() for i, _, t, _ in data}
    got = warc.read(spark, str(tmp_path / "w"), payload=True, range_bytes=range_bytes).collect()
    assert sorted(r.record_id for r in got) == sorted(text)
    for r in got:
        assert r.payload_digest == base64.b32encode(hashlib.sha1(text[r.record_id]).digest()).decode()
        assert bytes(r.payload) == (text[r.record_id] if r.record_type == "response" else b"")


def test_headers_of_any_length(spark, tmp_path):
    """A URL of 300 KB, and a payload of many magics without the end of a header."""
    data = [(1, "https://x/" + "a" * 300_000, "one"), (2, "u", "WARC/1.1\r\nContent-Length: 3\r\n" * 40_000), (3, "WARC/1.0", "three" + FAKE)]
    warc.write(spark.createDataFrame(data, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    got = {r.record_id: r for r in warc.read(spark, str(tmp_path / "w"), payload=True).collect()}
    assert len(got) == 3
    for page_id, url, text in data:
        r = got[f"<urn:page:{page_id}>"]
        assert (r.target_uri, bytes(r.payload).decode(), r.payload_bytes) == (url, text, len(text))


def _read(spark, folder, data, **how):
    folder.mkdir()
    (folder / "part-0").write_bytes(data)
    return warc.read(spark, str(folder), **how).count()


def test_broken_archives(spark, tmp_path):
    good = FAKE.encode()
    assert _read(spark, tmp_path / "good", good * 5, range_bytes=50) == 5
    for k, bad in enumerate((good + good[:-1], b"x" + good, good + b"junk", good.replace(b"Length: 3", b"Length: 99999"))):
        with pytest.raises(ValueError):
            _read(spark, tmp_path / f"bad{k}", bad, range_bytes=50)
    assert _read(spark, tmp_path / "cut", good + good[:-1], strict=False) == 1
    assert _read(spark, tmp_path / "cut50", good * 3 + good[:-1], strict=False, range_bytes=50) == 3
    assert _read(spark, tmp_path / "junk", good + b"junk" + good, strict=False, range_bytes=50) == 1
    assert _read(spark, tmp_path / "none", b"") == 0
