"""The corpus pipeline: five stages, each one operator of ``hourglass.llm``.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents that its
predecessor kept, and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns
of ``documents``.

* ``language_id``: documents that the identifier rejects (no letter, or no
  language ahead) go.  It learns from the stage's own labelled rows outside
  the held-out fold.
* ``simhash_dedup``: of each near-duplicate component one row stays, the one
  with the smallest ``doc_id`` (nulls last), of several the one whose hash over
  all columns is smallest.  Rows of different components all stay, whatever
  their ids.
* ``decontaminate``: documents with any hit word go.
* ``secret_scan``: each secret becomes ``[SECRET]`` and ``n_chars`` follows.
* ``bpe``: ids, their number and digest, and the digest of the bytes that
  decoding the ids gives.

Columns beside ``doc_id``, ``text``, ``lang`` and ``n_chars`` are carried
along whatever their names.  Nulls, empty texts, repeated rows and empty
tables give what the operators say for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm import bpe, decontaminate, language_id, secret_scan, simhash
from hourglass.llm.common import saved, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


class _Renamed:
    """``docs`` under column names that no operator uses."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.of = {name: f"own_{k}" for k, name in enumerate(self.names)}
        self.docs = docs.toDF(*self.of.values())

    def back(self, df: DataFrame) -> DataFrame:
        return df.select(*(F.col(own).alias(name) for name, own in self.of.items()))


def stage_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = _Renamed(docs)
    doc_id, text, lang = (own.of[c] for c in ("doc_id", "text", "lang"))
    learned = language_id.learn(own.docs.where(~language_id.held_out(doc_id)), text_col=text, label_col=lang)
    found = language_id.identify(own.docs, learned, text_col=text, keep=own.docs.columns)
    return own.back(found.where(~F.col("lang_rejected")))


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = _Renamed(docs)
    doc_id, text = own.of["doc_id"], own.of["text"]
    # 128 bits over the whole row: with them an id, null or repeated, names one row and its exact repetitions.
    row = [x for c in own.docs.columns for x in (F.col(c).isNull(), F.col(c).cast("string"))]
    marked = own.docs.withColumns({"hash_a": F.xxhash64(F.lit(0), *row), "hash_b": F.xxhash64(F.lit(1), *row)})
    found = saved(simhash.near_duplicates(marked, id_col=doc_id, text_col=text, keep=["hash_a", "hash_b"]), "near")
    each = found.groupBy("root", "doc_id", "hash_a", "hash_b").agg(F.count("*").alias("rows"))
    first = each.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash_a", "hash_b", "rows")).alias("first"))
    first = saved(first.select("first.doc_id", F.col("first.hash_a").alias("a"), F.col("first.hash_b").alias("b"), "first.rows"), "first")
    same = F.col(doc_id).eqNullSafe(F.col("doc_id")) & (F.col("hash_a") == F.col("a")) & (F.col("hash_b") == F.col("b"))
    kept = marked.join(first.hint("shuffle_hash"), same, "left_semi")
    if not first.where("rows > 1").isEmpty():
        kept = kept.dropDuplicates([doc_id, "hash_a", "hash_b"])
    return own.back(kept)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = _Renamed(docs)
    found = decontaminate.decontaminate(own.docs, table(spark, sf_dir, "benchmark"), id_col=own.of["doc_id"],
                                        text_col=own.of["text"], keep_all=True)
    return own.back(found.where("n_hit = 0"))


def stage_secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = _Renamed(docs)
    clean = own.back(secret_scan.redact(own.docs, text_col=own.of["text"], whole=True))
    return clean.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    decoded = bpe.round_trip(docs)
    return decoded.select("doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", stage_language_id),
    ("simhash_dedup", stage_simhash),
    ("decontaminate", stage_decontaminate),
    ("secret_scan", stage_secret_scan),
    ("bpe", stage_bpe),
]

#: Compression classification and fingerprints are not expressible in SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
