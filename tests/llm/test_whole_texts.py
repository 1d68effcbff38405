"""Language identification of texts of several MB."""

import pytest

import corpus_pipeline
from hourglass.llm import language_id as L


@pytest.fixture(scope="module")
def prose(spark):
    """Different texts by language, and those of the smaller table to learn from."""
    small = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = {r.text for r in small.collect()}
    out = {}
    for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text rlike '[A-Za-z]{2}'").orderBy("doc_id").collect():
        if r.text not in seen:
            out.setdefault(r.lang, dict())[r.text] = None
    return small, {lang: "\n".join(texts) for lang, texts in out.items()}


def test_long_clean_texts_keep_their_margin(spark, prose):
    small, texts = prose
    known = L.Identifier(L.learn(small), L.LEVEL, L.REJECT_MARGIN)
    assert len(texts["en"]) > 3_000_000
    for lang, text in texts.items():
        part, whole = known(text[:50_000].encode()), known(text.encode())
        assert part[0] == whole[0] == lang and not whole[2]
        assert whole[1] > part[1] / 2 > 10 * L.REJECT_MARGIN


def test_the_stage_keeps_a_long_clean_text(spark, prose):
    small, texts = prose
    long = spark.createDataFrame([(-1, texts["en"])], "doc_id long, text string")
    docs = small.unionByName(long, allowMissingColumns=True)
    assert corpus_pipeline.stage_language_id(spark, docs, "").where("doc_id = -1").count() == 1
