"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``length`` bytes that covers it starts anywhere
else too, in the same document or in another, judged on the input.

Shards.  Every window of ``length`` bytes is filed under its anchor: of the
grams of ``gram`` bytes inside it, the one with the least hash (the rightmost
of equals).  Equal windows have equal anchors at equal places, so they meet
under one anchor hash whatever stands around them, and no suffix has to be
looked for in more than one shard.  Neighbouring windows with one anchor form
a run; a run's segment is the text that its windows cover.  Anchors that occur
once are dropped.  A run whose segment occurs again as a whole is repeated as
a whole, and only one of equal segments enters a shard.

Suffix arrays.  A shard's different segments, each closed by a code of its
own, are sorted by Larsson-Sadakane refinement: suffixes are ranked by their
first codes, and groups of equal rank are split by the rank that lies as far
on as they are already sorted, doubling.  Kasai's common prefixes follow, in
step over all segments: a prefix shared with the predecessor in the array
shrinks by one at most from a position to the next.  Windows that share
``length`` bytes with a neighbour in the array are repeated.

An anchor with more than ``crowd_bytes`` of different segments is not put
into one shard.  Its sorted windows are merged across tasks by their 128-bit
digests instead, with the same result.

Edge cases: a null text is an empty one; texts shorter than ``length`` lose
nothing; repeated rows are copies of each other; null and repeated ids give
their own rows; an empty table gives an empty result.  Only the id and text
columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from hourglass.llm.common import map_rows, saved, struct, table

LENGTH = 400
SHARD_BYTES, CROWD_BYTES = 2 << 20, 32 << 20
STARTS_AT_ONCE = 1 << 18
PLACE = np.uint64((1 << 20) - 1)
CODES = 60_000
KEY = ["k1", "k2"]


def gram_of(length: int) -> int:
    """A power of two of about a third of the length."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def text_key(text: bytes) -> tuple[int, int]:
    digest = hashlib.md5(text, usedforsecurity=False).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position, by doubling."""
    out, width = _BYTES[data], 1
    while width < gram:
        out = out[:-width] * np.uint64(0xD6E8FEB86659FD93 + 2 * width) + out[width:]
        width *= 2
    return _mixed(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:len(values) - (width - done)], values[width - done:]) if width > done else values


def runs(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and last window start of each run."""
    gram, n = gram_of(length), len(text) - length + 1
    hashes, firsts = [], []
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(n, 0), STARTS_AT_ONCE):
        count = min(STARTS_AT_ONCE, n - at)
        grams = gram_hashes(data[at:at + count + length - 1], gram)
        place = np.arange(len(grams), dtype=np.uint64)
        least = _least((grams & ~PLACE) | (PLACE - place), length - gram + 1)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        hashes.append(grams[(PLACE - (least[first] & PLACE)).astype(np.int64)].view(np.int64))
        firsts.append(first + at)
    if not firsts:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    first = np.concatenate(firsts)
    return np.concatenate(hashes), first, np.append(first[1:] - 1, n - 1)


def _marked(docs: DataFrame, length: int) -> DataFrame:
    """Per row its text's key, size, digest and runs (with the segments' hashes)."""

    def row(text):
        text = text or b""
        h, first, last = runs(text, length)
        view, digest = memoryview(text), xxhash.xxh3_64_intdigest
        r = np.array([digest(view[a:b + length]) for a, b in zip(first.tolist(), last.tolist())], np.uint64).view(np.int64)
        return (*text_key(text), len(text), hashlib.sha256(text).hexdigest(), h, r, first, last)

    return map_rows(docs, ["text"], lambda: row, "k1 bigint, k2 bigint, n_bytes bigint, sha256 string, h array<bigint>, "
                    "r array<bigint>, first array<int>, last array<int>", ["doc_id"])


def _texts(docs: DataFrame) -> DataFrame:
    """k1, k2 and text; of copies that one task reads, one."""
    schema = struct("k1 bigint, k2 bigint, text binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                kept = []
                for text in batch.column(0).slice(at, 256).cast(pa.binary()).to_pylist():
                    key = text_key(text or b"")
                    if text and key not in seen:
                        seen.add(key)
                        kept.append((*key, text))
                if kept:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*kept), to_arrow_schema(schema))],
                                                     schema=to_arrow_schema(schema))

    return docs.select("text").mapInArrow(run, schema)


SEGMENT = "h bigint, r bigint, n bigint, k1 bigint, k2 bigint, first int, segment binary"


def _segments(wanted: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted runs."""
    by_text = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("h", "r", "n", "first", "last")).alias("runs"))
    schema = struct(SEGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                for at in range(0, len(found), 4096):
                    rows = [(x["h"], x["r"], x["n"], k1, k2, x["first"], text[x["first"]:x["last"] + length]) for x in found[at:at + 4096]]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), to_arrow_schema(schema))],
                                                     schema=to_arrow_schema(schema))

    joined = texts.join(by_text.hint("shuffle_hash"), KEY).select(*KEY, "text", "runs")
    return joined.mapInArrow(run, schema)


# --- one shard
def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of ``codes`` (uint16), whose segments end in
    codes that occur once: Larsson-Sadakane refinement in numpy."""
    n = len(codes)
    padded = np.concatenate((codes, np.zeros(3, np.uint16))).astype(np.uint64)
    key = padded[:n] << np.uint64(48) | padded[1:n + 1] << np.uint64(32) | padded[2:n + 2] << np.uint64(16) | padded[3:n + 3]
    order = np.argsort(key, kind="stable")
    fresh = np.append(True, key[order][1:] != key[order][:-1])
    rank = np.empty(n, np.int64)
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = start
    depth = 4
    while True:
        single = fresh & np.append(fresh[1:], True)
        at = np.flatnonzero(~single)  # places whose group is not yet one suffix
        if not len(at):
            return order, rank
        suffixes = order[at]
        further = suffixes + depth
        second = np.where(further < n, rank[np.minimum(further, n - 1)] + 1, 0)
        pair = rank[suffixes] * np.int64(n + 1) + second
        by = np.argsort(pair, kind="stable")
        order[at], pair = suffixes[by], pair[by]
        split = np.append(True, pair[1:] != pair[:-1])
        fresh[at] = split
        rank[order[at]] = at[np.maximum.accumulate(np.where(split, np.arange(len(at)), 0))]
        depth *= 2


def common_prefixes(codes: np.ndarray, order: np.ndarray, rank: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
    """Kasai's lengths in step over all segments: for offset 0, 1, ... the
    positions there, their predecessors in the suffix array, and what they share."""
    padded = np.append(codes, np.uint16(0))
    n, shared, lanes = len(codes), np.zeros(len(starts), np.int64), np.arange(len(starts))
    for offset in range(int(counts.max(initial=0))):
        lanes = lanes[counts[lanes] > offset]
        here = starts[lanes] + offset
        place = rank[here]
        before = np.where(place > 0, order[np.maximum(place - 1, 0)], n)
        size = np.where(place > 0, np.maximum(shared[lanes] - 1, 0), 0)
        going = np.flatnonzero(place > 0)
        while len(going):
            same = padded[here[going] + size[going]] == padded[np.minimum(before[going] + size[going], n)]
            going = going[same]
            size[going] += 1
        shared[lanes] = size
        yield here, before, size


def repeated_starts(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each of different segments, the window starts that occur elsewhere in them."""
    sizes = np.array([len(s) for s in segments])
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    codes = np.empty(int(ends[-1]), np.uint16)
    body = np.ones(len(codes), bool)
    body[ends - 1] = False
    codes[body] = np.frombuffer(b"".join(segments), np.uint8)
    codes[ends - 1] = 256 + np.arange(len(segments))
    order, rank = suffix_array(codes)
    hit = np.zeros(len(codes) + 1, bool)
    for here, before, size in common_prefixes(codes, order, rank, starts, sizes - length + 1):
        long = size >= length
        hit[here[long]] = True
        hit[before[long]] = True
    return [np.flatnonzero(hit[a:a + n - length + 1]) for a, n in zip(starts.tolist(), sizes.tolist())]


def _intervals(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(starts):
        cuts = np.flatnonzero(np.diff(starts) != 1)
        yield from zip(starts[np.append(0, cuts + 1)].tolist(), starts[np.append(cuts, len(starts) - 1)].tolist())


FOUND = "k1 bigint, k2 bigint, first int, last int"


def _by_shard(segments: DataFrame, shards: int, length: int) -> DataFrame:
    schema = struct(FOUND)

    def one(shard: pa.Table) -> pa.Table:
        columns = {c: shard.column(c).to_numpy() for c in ("h", "r", "n", "k1", "k2", "first")}
        by = np.lexsort((columns["r"], columns["h"]))
        h, r = columns["h"][by], columns["r"][by]
        by = by[np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]))] if len(by) else by
        h, found = columns["h"][by], []
        bounds = np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h)).tolist()
        at = 0
        while at < len(bounds) - 1:  # whole anchors, as many as there are codes for
            to = at + 1
            while to < len(bounds) - 1 and bounds[to + 1] - bounds[at] <= CODES:
                to += 1
            rows = by[bounds[at]:bounds[to]]
            texts = shard.column("segment").take(pa.array(rows)).to_pylist()
            for row, starts in zip(rows.tolist(), repeated_starts(texts, length)):
                first = int(columns["first"][row])
                found += [(int(columns["k1"][row]), int(columns["k2"][row]), first + a, first + b) for a, b in _intervals(starts)]
            at = to
        columns = list(zip(*found)) or [[]] * 4
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, to_arrow_schema(schema))], schema=to_arrow_schema(schema))

    shard = F.pmod(F.xxhash64("h"), F.lit(shards))
    return segments.withColumn("shard", shard).groupBy("shard").applyInArrow(one, schema)


def _by_digest(segments: DataFrame, length: int) -> DataFrame:
    """Crowded anchors: equal windows meet by their digests."""
    schema = struct("d1 bigint, d2 bigint, n bigint, k1 bigint, k2 bigint, first int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("n", "k1", "k2", "first", "segment"))):
                n, k1, k2, first, segment = row
                view = memoryview(segment)
                digests = b"".join(xxhash.xxh3_128_digest(view[a:a + length]) for a in range(len(segment) - length + 1))
                pairs = np.frombuffer(digests, "<i8").reshape(-1, 2)
                size = len(pairs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1])), pa.array(np.full(size, n)),
                     pa.array(np.full(size, k1)), pa.array(np.full(size, k2)), pa.array(np.arange(first, first + size, dtype=np.int32))],
                    schema=to_arrow_schema(schema))

    windows = segments.mapInArrow(run, schema)
    where = F.struct("k1", "k2", "first")
    met = windows.groupBy("d1", "d2").agg(F.min(where).alias("a"), F.max(where).alias("b"), F.max("n").alias("n"))
    met = met.where((F.col("a") != F.col("b")) | (F.col("n") > 1)).select("d1", "d2")
    return windows.join(met, ["d1", "d2"], "left_semi").select(*KEY, "first", F.col("first").alias("last"))


def repeats(docs: DataFrame, *, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, crowd_bytes: int = CROWD_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, k1, k2, n_bytes, sha256; found: k1, k2 and ``starts``,
    the intervals of repeated window starts of that text)."""
    marked = saved(_marked(docs, length), "marked")
    each = marked.select(*KEY, F.inline(F.arrays_zip("h", "r", "first", "last")))
    # Written first, so that the join below has a plain shuffle on either side, whose hot anchors Spark can split.
    met = saved(each.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "met")
    again = saved(each.join(met, "h", "left_semi"), "again")
    where = F.struct(*KEY, "first", "last")
    equal = saved(again.groupBy("h", "r").agg(F.count("*").alias("n"), F.min(where).alias("at")), "equal")
    size = F.col("at.last") - F.col("at.first") + length
    mixed = equal.groupBy("h").agg(F.count("*").alias("different"), F.sum(size).alias("bytes")).where("different > 1")
    wanted = equal.join(mixed.select("h"), "h", "left_semi").select("h", "r", "n", "at.*")
    segments = saved(_segments(wanted, _texts(docs), length), "segments")
    crowded = saved(mixed.where(F.col("bytes") > crowd_bytes).select("h"), "crowded")
    total = segments.agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    whole = again.join(equal.where("n > 1").select("h", "r"), ["h", "r"], "left_semi").select(*KEY, "first", "last")
    shared = _by_shard(segments.join(crowded, "h", "left_anti"), max(1, -(-total // shard_bytes)), length)
    found = whole.union(shared)
    if not crowded.isEmpty():
        found = found.union(_by_digest(segments.join(crowded, "h", "left_semi"), length))
    found = found.distinct().groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("starts"))
    return marked.select("doc_id", *KEY, "n_bytes", "sha256"), saved(found, "found")


def spans_of(starts: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal covered spans (end exclusive) of intervals of window starts."""
    spans: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in starts):
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], last + length)
        else:
            spans.append([first, last + length])
    return [(a, b) for a, b in spans]


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   shard_bytes: int = SHARD_BYTES, crowd_bytes: int = CROWD_BYTES, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row;
    ``keep_text`` adds the remaining bytes as ``kept``, null where nothing was removed."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows, found = repeats(docs, length=length, shard_bytes=shard_bytes, crowd_bytes=crowd_bytes)

    def row(text, starts):
        spans = spans_of(starts, length)
        kept = b"".join(text[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(text)]))
        return sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest(), kept if keep_text else None

    touched = _texts(docs).join(found.hint("shuffle_hash"), KEY)
    made = map_rows(touched, ["text", "starts"], lambda: row, "n_removed bigint, n_spans bigint, kept_sha256 string, kept binary", KEY)
    made = saved(made.dropDuplicates(KEY), "removed")
    none = F.lit(0).cast("long")
    out = rows.join(made, KEY, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"), "kept")
    return out if keep_text else out.drop("kept")


def op7_suffix_dedup(spark, sf_dir):
    """Per document: bytes, bytes and spans removed, digest of what remains."""
    return remove_repeats(table(spark, sf_dir, "documents"))
