"""Byte-level BPE encoding and decoding as a tree reduction.

A piece of the split pattern is encoded by halves: each half recursively, a
leaf of at most ``LEAF`` bytes by plain merging, and two encoded neighbours
are joined by encoding a window of tokens around the boundary anew.  A token
sequence is the encoding of its bytes exactly if each two neighbouring tokens
are the encoding of their own bytes.  So once the window's first and last
token form such a pair with the token outside, nothing outside can change;
until then the window doubles.  Joining is associative, so the result does
not depend on how the tree is cut.  Pieces, and units of pieces (see
``units``), concatenate; decoding concatenates the tokens' bytes.

The ranks come from a tiktoken file named by a parameter; the driver reads it
and sends it to the executors (its size is fixed by the vocabulary).

Edge cases: a null text is an empty one, which has no tokens; special tokens
are ordinary text; repeated rows give repeated rows; an empty table gives an
empty one.  Only the id and text columns are read.  A piece of any length
takes memory and time near its length.
"""

from __future__ import annotations

import base64
import heapq
from struct import pack

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import cache, map_rows, table
from hourglass.llm.units import Units

LEAF = 8
LEAVES = 1 << 17
IDS_AT_ONCE = 4096
NAIVE = 64
PAIRS = 1 << 18


class Bpe:
    """Encoder over ``ranks``, the bytes of each token with its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, number in ranks.items():
            self.bytes_of[number] = token
        self.pairs: dict[tuple[int, int], tuple[int, ...]] = {}
        self.leaves: dict[bytes, list[int]] = {}

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token stays whole."""
        number = self.rank.get(piece)
        return self.tree(piece) if number is None else [number]

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            found = self.leaves.get(data)
            if found is None:
                if len(self.leaves) >= LEAVES:
                    self.leaves.clear()
                found = self.leaves[data] = self.plain(data)
            return found
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        width = 1
        while True:
            if width == 1:
                middle = [*self.pair(left[-1], right[0])]
            else:
                middle = self.plain(b"".join(map(self.bytes_of.__getitem__, left[-width:] + right[:width])))
            if ((width >= len(left) or self.stable(left[-width - 1], middle[0]))
                    and (width >= len(right) or self.stable(middle[-1], right[width]))):
                return left[:-width] + middle + right[width:]
            width *= 2

    def pair(self, a: int, b: int) -> tuple[int, ...]:
        """The encoding of two tokens' bytes."""
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[a, b] = tuple(self.plain(self.bytes_of[a] + self.bytes_of[b]))
        return found

    def stable(self, a: int, b: int) -> bool:
        """Whether the two tokens are the encoding of their own bytes."""
        return self.pair(a, b) == (a, b)

    def text(self, ids: np.ndarray) -> bytes:
        """The bytes of token ids: leaves of ``IDS_AT_ONCE``, concatenated up the tree."""
        if len(ids) <= IDS_AT_ONCE:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.text(ids[:half]) + self.text(ids[half:])

    def plain(self, data: bytes) -> list[int]:
        """Merges the neighbours of lowest rank, the leftmost first, until none is left."""
        if len(data) > NAIVE:
            return self._heap(data)
        rank = self.rank.get
        parts = [data[i:i + 1] for i in range(len(data))]
        scores = [rank(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        while scores and (low := min(scores)) < 1 << 60:
            i = scores.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = rank(parts[i] + parts[i + 1], 1 << 60)
            if i:
                scores[i - 1] = rank(parts[i - 1] + parts[i], 1 << 60)
        return [self.rank[p] for p in parts]

    def _heap(self, data: bytes) -> list[int]:
        """The same for long data: a heap of pairs over a linked list."""
        n, rank = len(data), self.rank
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a part is data[i:end[i]]
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        live = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not live[i] or j >= n or not live[j] or end[j] != stop:
                continue
            end[i], live[j] = stop, False
            if stop < n:
                before[stop] = i
                if (r := rank.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := rank.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(rank[data[i:end[i]]])
            i = end[i]
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(number) for token, number in map(bytes.split, lines)}


_CODERS: dict[str, tuple[Bpe, Units]] = cache("bpe")


def _coder(held) -> tuple[Bpe, Units]:
    """Built once in each Python worker."""
    path, pattern, ranks = held.value
    if path + pattern not in _CODERS:
        bpe, split = Bpe(ranks), regex.compile(pattern).findall

        def unit(text: str) -> bytes:
            ids = [i for piece in split(text) for i in bpe.piece(piece.encode())]
            return pack(f"<{len(ids)}I", *ids)

        _CODERS[path + pattern] = bpe, Units(unit)
    return _CODERS[path + pattern]


def _sent(df: DataFrame, path: str | None, pattern: str):
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return df.sparkSession.sparkContext.broadcast((path, pattern, read_ranks(path)))


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``id_col`` and ``ids``: the token ids as little-endian unsigned 32-bit integers."""
    held = _sent(docs, ranks_path, pattern)

    def make():
        units = _coder(held)[1]
        return lambda text: (b"".join(units((text or b"").decode())),)

    return map_rows(docs, [text_col], make, "ids binary", [id_col], "bpe")


def decode(encoded: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """``id_col``, ``ids`` and ``decoded``: the bytes that the ids stand for."""
    held = _sent(encoded, ranks_path, public_tokenizers.PATTERN)

    def make():
        up = _coder(held)[0].text
        return lambda ids: (up(np.frombuffer(ids or b"", "<u4")),)

    return map_rows(encoded, [ids_col], make, "decoded binary", [id_col, ids_col], "bpe")


def round_trip(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass, so that each task
    needs one Python worker instead of two, which both would hold the memos."""
    held = _sent(docs, ranks_path, pattern)

    def make():
        coder, units = _coder(held)

        def row(text: bytes | None) -> tuple[bytes, bytes]:
            ids = b"".join(units((text or b"").decode()))
            return ids, coder.text(np.frombuffer(ids, "<u4"))

        return row

    return map_rows(docs, [text_col], make, "ids binary, decoded binary", [id_col], "bpe")


def op4_bpe(spark, sf_dir):
    """Per document: tokens, digest of the ids, digest of the decoded bytes."""
    return digests(round_trip(table(spark, sf_dir, "documents")))


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return decoded.select(id_col, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
