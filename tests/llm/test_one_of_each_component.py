"""The pipeline's near-duplicate stage on null, repeated and shared ids."""

import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string"


def words(seed):
    return " ".join(f"w{x}" for x in random.Random(seed).choices(range(10 ** 6), k=60))


def kept(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(((r.doc_id, r.text, r.lang) for r in corpus_pipeline.stage_simhash(spark, docs, "").collect()), key=str)


def test_texts_without_an_id_all_stay(spark):
    rows = [(None, words(k), "en") for k in range(20)]
    assert kept(spark, rows * 2) == sorted(rows, key=str)


def test_texts_that_share_an_id_all_stay(spark):
    rows = [(5, words(1), "en"), (5, words(2), "en"), (None, words(3), "en"), (6, words(3), "en")]
    assert kept(spark, rows) == sorted([rows[0], rows[1], rows[3]], key=str)


def test_one_row_of_a_component(spark):
    # 5 stands on a copy of document 3 and on a text of its own; the copies differ in case and white space only.
    rows = [(3, words(1), "en"), (5, words(1).upper(), "en"), (5, words(2), "en"), (None, f" {words(2)}", "en"),
            (7, words(4), None), (7, words(4), "en"), (7, words(4).upper(), "en")]
    got = kept(spark, rows)
    assert len(got) == 3 and rows[0] in got and rows[2] in got
    assert all(kept(spark, rows[k:] + rows[:k]) == got for k in (2, 5))
