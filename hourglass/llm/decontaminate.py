"""Benchmark decontamination: one Aho-Corasick automaton over the normalised
test items, each text scanned once, offsets mapped back to the original.

Normalised words are maximal runs of ASCII letters and digits and of all
non-ASCII characters, with A-Z in lower case.  Each ``window`` consecutive
words of an item form one pattern; an item with fewer words is one pattern.
The automaton's alphabet is the vocabulary of the items: a word that no item
has is one common symbol that no pattern holds.

The automaton is sent to the executors, so its size is bounded: items are
dealt to automata of at most ``max_automaton_bytes`` of item text, and the
texts are scanned once by each (one pass where the items fit).

Edge cases: a null or empty text has no words, no hits, and is not
contaminated; items without words match nothing; repeated items count once by
``item_id``, repeated documents give repeated rows; empty tables give empty
or clean results.  Only the id and text columns are read, so other columns
cannot clash.
"""

from __future__ import annotations

import re
import uuid
from itertools import repeat

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import map_rows, table

WINDOW = 10
MAX_AUTOMATON_BYTES = 16 << 20

_KEEP = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_KEEP).split()


class Automaton:
    """Patterns of word numbers; each knows its length and its items."""

    def __init__(self, items: list[tuple[int, bytes]], window: int):
        self.number: dict[bytes, int] = {}
        patterns: dict[tuple[int, ...], set[int]] = {}
        for item_id, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                patterns.setdefault(tuple(ids[at:at + window]), set()).add(item_id)
        self.machine = None
        if patterns:
            self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for pattern, ids in patterns.items():
                self.machine.add_word(pattern, (len(pattern), tuple(ids)))
            self.machine.make_automaton()

    def scan(self, words: list[bytes]) -> list[tuple[int, int, tuple[int, ...]]]:
        """(first word, last word, items) of every occurrence."""
        if not self.machine or not words:
            return []
        ids = tuple(map(self.number.get, words, repeat(0)))
        return [(last - n + 1, last, items) for last, (n, items) in self.machine.iter(ids)]


def _runs(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of hit words; runs that touch are joined."""
    runs: list[list[int]] = []
    for first, last in sorted(found):
        if runs and first <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    return [(a, b) for a, b in runs]


def _shards(items: DataFrame, id_col: str, text_col: str, limit: int) -> list[DataFrame]:
    """The items in parts of about ``limit`` bytes of text at most (one item at least)."""
    items = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("item_text"))
    items = items.where("item_text is not null")
    size = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    n = -(-size // limit) or 1
    if n == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_text"), F.lit(2 * n)) == k) for k in range(2 * n)]


def decontaminate(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  max_automaton_bytes: int = MAX_AUTOMATON_BYTES,
                  keep_all: bool = False) -> DataFrame:
    """One row per document: its id (``keep_all``: all its columns), ``n_words``, ``n_hit``, ``item_ids`` (sorted)
    and ``spans``, the hit passages as character offsets (end exclusive) of
    the original text."""
    none = "array<struct<first:int,last:int,items:array<bigint>>>"
    scanned = docs.select(*docs.columns if keep_all else [id_col, text_col], F.lit(None).cast(none).alias("found"))
    *more, rest = [_sent(shard, window) for shard in _shards(items, item_id_col, item_text_col, max_automaton_bytes)]
    for held in more:

        def one(held=held):
            machine = _automaton(held)
            return lambda text, found: ([*(found or []), *({"first": a, "last": b, "items": i} for a, b, i in machine.scan(words_of(text)))],)

        scanned = map_rows(scanned, [text_col, "found"], one, f"again {none}", [c for c in scanned.columns if c != "found"])
        scanned = scanned.withColumnRenamed("again", "found")

    def last():
        machine = _automaton(rest)

        def row(text, found):
            words = words_of(text)
            found = [tuple(x.values()) for x in found or []] + machine.scan(words)
            if not found:
                return len(words), 0, [], []
            runs = _runs([(a, b) for a, b, _ in found])
            at = [m.span() for m in _WORD.finditer(text.decode())]
            spans = [{"start": at[a][0], "end": at[b][1]} for a, b in runs]
            return len(words), sum(b - a + 1 for a, b in runs), sorted({i for x in found for i in x[2]}), spans

        return row

    return map_rows(scanned, [text_col, "found"], last, "n_words bigint, n_hit bigint, item_ids array<bigint>, "
                    "spans array<struct<start:int,end:int>>", docs.columns if keep_all else [id_col])


_MACHINES: dict[str, Automaton] = {}


def _sent(items: DataFrame, window: int):
    """The items of one automaton, broadcast under a name of their own."""
    rows = [(r[0], r[1].encode()) for r in items.distinct().collect()]
    return items.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, rows, window))


def _automaton(held) -> Automaton:
    """Built once in each Python worker."""
    name, items, window = held.value
    if name not in _MACHINES:
        _MACHINES.clear()
        _MACHINES[name] = Automaton(items, window)
    return _MACHINES[name]


def op2_decontaminate(spark, sf_dir):
    """Per document: words, hit words, items with occurring windows."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, len(w[p:p+9]) AS n, array_to_string(w[p:p+9], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
hits AS (
  SELECT g.r, g.p, g.n, x.item_id
  FROM (SELECT r, n, p, array_to_string(w[p:p+n-1], ' ') AS gram
        FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM doc_words, sizes WHERE len(w) >= n)) g
  JOIN windows x ON x.n = g.n AND x.gram = g.gram),
hit_words AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""
