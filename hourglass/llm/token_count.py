"""Token counts by a compiled finite-state transducer.

The tokenizer file of a byte-level BPE becomes a deterministic transducer
over the bytes of a piece.  After any prefix its state holds

* the longest end of the prefix that a longer token begins with, and
* for each position in that end from which a token can still go on, the last
  token of the encoding up to there, with the count since.

That is all that later bytes can depend on: a token can only end the encoding
of a longer prefix if it starts in that end, and it does so exactly if it and
the token before it are the encoding of their own bytes.  Whether they are
follows from the parts that meet between them while both are merged.  Each transition is
annotated with the change of the token count, which may be negative where
tokens merge.  States are numbered as they are first reached.

A text is cut into chunks where the transducer is back in its start state
whatever came before (see ``units``), so that a chunk's state map is
``start -> (start, count)``.  State maps compose associatively; here their
parallel prefix scan is the running sum of the counts, whose last value is
the text's count.

Special tokens inside texts are found first, as the tokenizers library does
by default, and count one each.  Letters and numbers are those of that
library's Unicode version.

Edge cases: a null text is an empty one, with no bytes and tokens; repeated
rows give repeated rows; an empty table gives an empty one.  Only the id and
text columns are read.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from hourglass.llm.common import cache, map_rows, table
from hourglass.llm.units import Units

LIMIT = 512
STATES = 200_000
PAIRS = 1 << 18
START = 0
NEVER = 1 << 60


def _byte_of() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable
    Latin-1 stands for itself, the other bytes for 256 and up, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Transducer:
    """Over the bytes of one piece; ``merges`` ranks pairs of token bytes."""

    def __init__(self, merges: dict[tuple[bytes, bytes], int]):
        self.merges = merges
        tokens = {a + b for a, b in merges} | {bytes([b]) for b in range(256)}
        made = {t: self._made(t) for t in tokens}
        self.tokens = {t for t, (parts, _) in made.items() if parts == [t]}
        self.opens = {t[:n] for t in self.tokens for n in range(len(t))}
        self.last = {t: made[t][1] for t in self.tokens}  # token -> (left, right, rank) of the merge that makes it
        rank = lambda t: self.last[t][2] if self.last.get(t) else -1
        self.ordered = all(not m or m[0] in self.last and m[1] in self.last and m[2] > max(rank(m[0]), rank(m[1])) for m in self.last.values())
        self.ends: tuple[dict, dict] = {}, {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states = [(b"", ((None, 0),))]
        self.number = {self.states[0]: START}
        self.steps: list[dict[int, tuple[int, int]]] = [{}]

    def plain(self, data: bytes) -> list[bytes]:
        return self._made(data)[0]

    def _made(self, data: bytes) -> tuple[list[bytes], tuple[bytes, bytes, int] | None]:
        """The encoding by plain merging, and the last merge."""
        parts, last = [data[i:i + 1] for i in range(len(data))], None
        while len(parts) > 1:
            ranks = [self.merges.get(p, NEVER) for p in zip(parts, parts[1:])]
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            last = parts[i], parts[i + 1], low
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts, last

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """What stands at the token's left (0) or right (1) edge while it is
        merged, from its byte on, with the rank of the merge that ends it."""
        found = self.ends[side].get(token)
        if found is None:
            found, part, rank = [], token, NEVER
            while True:
                found.append((part, rank))
                if not self.last[part]:
                    break
                part, rank = self.last[part][side], self.last[part][2]
            found.reverse()
            self.ends[side][token] = found
        return found

    def follows(self, a: bytes | None, b: bytes) -> bool:
        """Whether a and b stay apart when a + b is encoded."""
        if a is None:
            return True
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[a, b] = self._apart(a, b) if self.ordered else self.plain(a + b) == [a, b]
        return found

    def _apart(self, a: bytes, b: bytes) -> bool:
        """Follows the two edges that face each other through the merges, in
        the order of their ranks: the pair between them must never come first.
        Of equal ranks the leftmost merge does, which is a's, then the pair, then b's."""
        left, right, i, j = self._edge(a, 1), self._edge(b, 0), 0, 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            rank = self.merges.get((x, y), NEVER)
            if rank < x_ends and rank <= y_ends and rank != NEVER:
                return False
            if x_ends == y_ends == NEVER:
                return True
            i, j = (i + 1, j) if x_ends <= y_ends else (i, j + 1)

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """The transition, compiled when it is first taken: (state, change of the count)."""
        end, tail = self.states[state]
        end += bytes([byte])
        k = next(k for k, held in enumerate(tail) if held and end[k:] in self.tokens and self.follows(held[0], end[k:]))
        emitted = 1 - tail[k][1]
        drop = next(d for d in range(len(end) + 1) if end[d:] in self.opens)
        after = tuple((held[0], held[1] + emitted) if held and end[d:] in self.opens else None for d, held in enumerate(tail[drop:], drop))
        key = (end[drop:], after + ((end[k:], 0),))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        self.steps[state][byte] = found = self.number[key], emitted
        return found

    def run(self, piece: bytes, state: int = START) -> tuple[int, int]:
        """The piece's state map at ``state``: (state after it, tokens)."""
        if len(self.states) > STATES and state == START:
            self.reset()
        count, steps = 0, self.steps
        for byte in piece:
            state, emitted = steps[state].get(byte) or self.step(state, byte)
            count += emitted
        return state, count


@functools.lru_cache(1)
def newer_characters() -> str:
    """A character class of the letters and numbers that ``regex`` knows and
    the tokenizers library does not yet: where ``regex`` and ``unicodedata``
    disagree, the library's own splitter is asked."""
    word, split = regex.compile(r"[\p{L}\p{N}]"), pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    odd = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)])
           if not c.isascii() and bool(word.match(c)) != (unicodedata.category(c)[0] in "LN")]
    found = [ord(c) for c in odd if (0, 2) in [at for _, at in split(f"!{c}a")]]
    starts = [c for c, b in zip(found, [-1, *found]) if c != b + 1]
    ends = [c for c, b in zip(found, [*found[1:], -1]) if c + 1 != b]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


class Counter:
    def __init__(self, model: dict, newer: str):
        byte_of = _byte_of()
        raw = lambda token: bytes(map(byte_of.__getitem__, token))
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"])
        self.machine = Transducer({(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)})
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.newer = regex.compile(f"[{newer}]") if newer else None
        added = sorted((t["content"] for t in model["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.units = Units(self.unit)

    def unit(self, text: str) -> int:
        seen = self.newer.sub("\uffff", text) if self.newer and not text.isascii() else text  # same length
        run = self.machine.run
        return sum(run(text[a:b].encode())[1] for a, b in (m.span() for m in self.split.finditer(seen)))

    def count(self, text: str) -> int:
        parts = self.added.split(text) if self.added else [text]
        return sum(sum(self.units(part)) for part in parts) + len(parts) - 1


_COUNTERS: dict[str, Counter] = cache("token_count")


def _counter(held) -> Counter:
    path, text, newer = held.value
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(json.loads(text), newer)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer_path: str | None = None) -> DataFrame:
    """``id_col``, ``n_bytes`` and ``n_tokens`` of each text by a byte-level BPE tokenizer file (JSON)."""
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast((path, file.read(), newer_characters()))

    def make():
        counter = _counter(held)
        return lambda text: (len(text or b""), counter.count((text or b"").decode()))

    return map_rows(docs, [text_col], make, "n_bytes bigint, n_tokens bigint", [id_col], "token_count")


def op10_token_count(spark, sf_dir):
    """Per document: bytes, tokens, and whether the tokens pass the limit."""
    return count_tokens(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > LIMIT)
