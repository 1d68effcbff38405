"""Language identification by compression.

Each language has a raw-content Zstandard dictionary made of texts in it.  A
whole text, reduced to its lower-case words, is encoded with each dictionary
in blocks of ``BLOCK_BYTES``, each one afresh; the language whose encodings
are smallest in sum is predicted.  All blocks are encoded after the same short
run of spaces, whose gain keeps short blocks from being stored as they are.
Ties go to the language with more rows.

The score is the margin: the share by which the smallest sum is smaller than
the second, both less what the runs alone take.  A text is rejected if its
margin is below ``reject_margin`` or if it has no letter.  Blocks keep the
margin of a long text where that of a block is: encoded in one piece, a text
soon matches itself, and what a dictionary saves is lost in its length.

Learning takes a bounded sample: about ``sample_rows`` different texts for
each language, chosen by a hash of the text over all labelled rows, of each
the first ``sample_chars`` characters, until ``dictionary_bytes`` are full.
Everything else covers all rows, and whole texts are classified.

Edge cases: a null text, or one without letters, is ``und`` with score 0 and
rejected; so is every text if nothing was labelled; with one language learned
the score is 1; repeated rows give repeated rows; rows without a label take
no part in learning; an empty table gives an empty result.  Only the text and,
for learning, label and id columns are read.
"""

from __future__ import annotations

import re
import uuid

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import cache, map_rows, table

DICTIONARY_BYTES, LEVEL = 65536, 6
BLOCK_BYTES = 16384
SAMPLE_ROWS, SAMPLE_CHARS = 1024, 500
REJECT_MARGIN = 0.002
UNKNOWN = "und"

_WORDS = re.compile(r"[^\W\d_]+")
_RUN = b" " * 200


def words_only(text: str) -> bytes:
    return f" {' '.join(_WORDS.findall(text.lower()))} ".encode()


def learn(labelled: DataFrame, *, text_col: str = "text", label_col: str = "lang", sample_rows: int = SAMPLE_ROWS,
          sample_chars: int = SAMPLE_CHARS, dictionary_bytes: int = DICTIONARY_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary), the language with most different texts first.

    Copies count once, so a language whose rows are mostly copies of one text is
    sampled as fully as the others; a text teaches by ``sample_chars``
    characters from a place that its hash gives."""
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(label_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    different = rows.groupBy("lang", "hash").agg(F.lit(1).alias("one"))
    counts = {r["lang"]: r["n"] for r in different.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample_rows / n))))
    place = F.pmod("hash", F.lit(1 << 30)) / float(1 << 30)
    start = F.pmod(F.xxhash64("hash"), F.greatest(F.char_length("text") - sample_chars, F.lit(0)) + 1).cast("int") + 1
    rows = rows.withColumn("place", place).where(F.col("place") < F.element_at(share, F.col("lang")))
    sample = rows.select("lang", "place", F.substring("text", start, F.lit(sample_chars)).alias("text")).distinct()
    texts: dict[str, list[bytes]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r["place"], r["text"])):
        own = texts.setdefault(r["lang"], [])
        if sum(map(len, own)) < dictionary_bytes:
            own.append(words_only(r["text"]))
    return [(lang, b"".join(texts.get(lang, []))[:dictionary_bytes]) for lang in sorted(counts, key=lambda k: (-counts[k], k))]


class Identifier:
    def __init__(self, dictionaries: list[tuple[str, bytes]], level: int, reject_margin: float):
        self.names = [lang for lang, _ in dictionaries]
        self.reject_margin, self.coders = reject_margin, []
        for _, content in dictionaries:
            options = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            if len(content) >= 8:
                own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                own.precompute_compress(level=level)
                options["dict_data"] = own
            self.coders.append(zstandard.ZstdCompressor(**options))
        self.base = min((len(c.compress(_RUN)) for c in self.coders), default=0)

    def __call__(self, raw: bytes | None) -> tuple[str, float, bool]:
        text = (raw or b"").decode()
        if not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        text = words_only(text)
        blocks = [_RUN + text[at:at + BLOCK_BYTES] for at in range(0, len(text), BLOCK_BYTES)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.coders]
        best = sizes.index(min(sizes))
        if len(sizes) == 1:
            return self.names[0], 1.0, False
        second = min(sizes[:best] + sizes[best + 1:])
        margin = (second - sizes[best]) / max(second - self.base * len(blocks), 1)
        margin = min(max(margin, 0.0), 1.0)
        return self.names[best], margin, margin < self.reject_margin


_KNOWN: dict[str, Identifier] = cache("language_id")


def _identifier(held) -> Identifier:
    name, args = held.value
    if name not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[name] = Identifier(*args)
    return _KNOWN[name]


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], *, text_col: str = "text", keep: list[str],
             level: int = LEVEL, reject_margin: float = REJECT_MARGIN) -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``lang_score`` and ``lang_rejected``."""
    held = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, (dictionaries, level, reject_margin)))
    return map_rows(docs, [text_col], lambda: _identifier(held), "lang_pred string, lang_score double, lang_rejected boolean", keep, "language_id")


def held_out(id_col: str):
    """Whether a row is kept out of learning: by its id alone, a null id is."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def op6_language_id(spark, sf_dir):
    """Per document: fold, predicted language, margin."""
    docs = table(spark, sf_dir, "documents")
    learned = learn(docs.where(~held_out("doc_id")))
    return identify(docs, learned, keep=["doc_id"]).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))
