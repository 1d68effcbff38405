"""Fill-in-the-middle examples, cut at the boundaries of a compressed set.

The ends of a text's units (words with the white space before them, or single
characters) form a boundary set laid out in containers of 65,536 offsets: a
sorted array where few offsets are set, a bitmap where many are, runs where
they are consecutive, whichever is smallest.  Cumulative cardinalities over
the containers find the one that holds the k-th boundary; a select inside it
gives the offset.  Both cuts of a text come from two such selects, so only the
set and the text are held, never a list of units.

Which texts are rewritten, in which form, and where they are cut follows from
a digest of a seed and the id: a repeated or recomputed task gives the same
rows.  ``restore`` rebuilds every text from output and form alone.

Edge cases: a null text is an empty one; empty texts, and texts that hold a
sentinel, stay plain; white space alone is one unit; a null id is written as
nothing in the digest's input; repeated rows give repeated rows; an empty
table gives an empty one.  Only the id and text columns are read.  Sentinels
must not overlap one another, so that none can arise where two parts meet;
others are refused.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import map_rows, table

SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
SENTINELS = ("<P>", "<S>", "<M>")
SPACE = (32, 9, 10, 11, 12, 13)
UNITS = ("words", "chars")
CONTAINER = 1 << 16
ARRAY_ROWS = 4096  # two bytes each: beyond this, a bitmap of 8 KB is smaller


class ArrayContainer:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(CONTAINER, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right"))
        word = int(self.words[at])
        for _ in range(k - (int(self.before[at - 1]) if at else 0)):
            word &= word - 1  # drops the lowest set bit
        return at * 64 + (word & -word).bit_length() - 1


class RunContainer:
    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.before = np.cumsum(lengths, dtype=np.int64)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right"))
        return int(self.starts[at]) + k - (int(self.before[at - 1]) if at else 0)


def container(low: np.ndarray):
    """The smallest container of ascending offsets below 65,536."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(first) < min(2 * len(low), CONTAINER // 8):
        return RunContainer(low[first], np.diff(first, append=len(low)))
    return ArrayContainer(low) if len(low) <= ARRAY_ROWS else BitmapContainer(low)


class BoundarySet:
    """Ascending, different offsets."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        first = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[first].tolist()
        self.containers = [container(part & (CONTAINER - 1)) for part in np.split(offsets, first[1:])] if len(first) else []
        self.before = [*first.tolist(), len(offsets)]  # cardinality before each container, and of all

    def __len__(self) -> int:
        return self.before[-1]

    def select(self, k: int) -> int:
        """The k-th offset, counted from 0."""
        at = bisect_right(self.before, k) - 1
        return (self.keys[at] << 16) + self.containers[at].select(k - self.before[at])


def word_ends(text: str) -> np.ndarray:
    """Where units end, in code points: after each run of other characters, and after closing white space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    space = (codes == 32) | ((codes >= SPACE[1]) & (codes <= SPACE[-1]))
    ends = ~space
    ends[:-1] &= space[1:]
    if len(space):
        ends[-1] = True
    return np.flatnonzero(ends) + 1


def ends_of(text: str, units: str) -> np.ndarray:
    return word_ends(text) if units == "words" else np.arange(1, len(text) + 1)


def _draws(digest: bytes) -> list[int]:
    return [int(digest[at:at + 8], 16) for at in (0, 8, 16, 24)]


def checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """The sentinels, unless a proper end of one begins another, or one lies in another."""
    for a in sentinels:
        for b in sentinels:
            if not a or (a != b and a in b) or any(a.endswith(b[:n]) for n in range(1, len(b))):
                raise ValueError(f"sentinels overlap: {a!r} and {b!r}")
    if len(set(sentinels)) < 3:
        raise ValueError("sentinels must differ")
    return sentinels


def transform(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
              fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, units: str = "words",
              sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``id_col``, ``n`` (units), ``form`` (plain, psm or spm), ``output``,
    and ``prefix_chars`` and ``middle_chars`` (null if plain)."""
    if units not in UNITS:
        raise ValueError(f"units must be one of {UNITS}")
    p, s, m = checked(sentinels)
    marks = [x.encode() for x in (p, s, m)]

    def row(data: bytes | None, digest: bytes) -> tuple:
        data = data or b""
        text = data.decode()
        ends = ends_of(text, units)
        n, (h1, h2, h3, h4) = len(ends), _draws(digest)
        if not n or h3 % 100 >= fim_percent or any(x in data for x in marks):
            return n, "plain", text, None, None
        bounds = BoundarySet(ends)
        first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (bounds.select(k - 1) if k else 0 for k in (first, last))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm_percent:
            return n, "spm", f"{s}{suffix}{p}{prefix}{m}{middle}", a, b - a
        return n, "psm", f"{p}{prefix}{s}{suffix}{m}{middle}", a, b - a

    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    given = docs.select(F.col(id_col).alias("fim_id"), F.col(text_col).cast("string").alias("fim_text"), drawn.alias("fim_digest"))
    made = map_rows(given, ["fim_text", "fim_digest"], lambda: row,
                    "n bigint, form string, output string, prefix_chars bigint, middle_chars bigint", ["fim_id"])
    return made.withColumnRenamed("fim_id", id_col)


def restore(made: DataFrame, *, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``made`` with ``restored``: the text, from ``output`` and ``form`` alone."""
    part = F.split("output", "|".join(map(re.escape, checked(sentinels))), -1)
    of = {form: F.concat(*(F.get(part, F.lit(k)) for k in order)) for form, order in (("psm", (1, 3, 2)), ("spm", (2, 3, 1)))}
    return made.withColumn("restored", F.when(F.col("form") == "psm", of["psm"]).when(F.col("form") == "spm", of["spm"])
                           .otherwise(F.col("output")))


def op12_fill_in_middle(spark, sf_dir):
    """Per document: units, form, lengths of prefix and middle, digests of the output and of the text rebuilt from it."""
    made = restore(transform(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS unit,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(unit) AS n,
         list_transform([1, 9, 17, 25], lambda x: CAST('0x' || substr(h, x, 8) AS BIGINT)) AS r
  FROM cut),
placed AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
         CASE WHEN n = 0 OR r[3] % 100 >= 50 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
              THEN 'plain' WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(unit[1:a], ''), '') AS prefix, coalesce(array_to_string(unit[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(unit[b + 1:], ''), '') AS suffix
  FROM placed)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""
