"""Language identification: held-out accuracy and edge cases."""

import zlib

from pyspark.sql import functions as F

from hourglass.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.op6_language_id(spark, SF).join(docs, "doc_id").where("text rlike '[A-Za-z]{2}'").collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    out = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.95
    assert sum(r.rejected for r in out) / len(out) < 0.03


def test_edges(spark):
    rows = [(1, "the cat and the dog were there with the others", "en"), (2, "der Hund und die Katze waren nicht dort", "de"),
            (3, None, "en"), (4, "123 !!", "en"), (5, "", None), (6, "wo ist der Hund und die Katze" * 3000, None),
            (None, "THE DOG WAS THERE", None), (6, "½ ² _", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.identify(docs, L.learn(docs), keep=["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    pred = {(r.doc_id, r.text): r for r in got}
    for key in ((3, None), (4, "123 !!"), (5, ""), (6, "½ ² _")):
        assert (pred[key].lang_pred, pred[key].lang_score, pred[key].lang_rejected) == ("und", 0.0, True)
    assert pred[6, rows[5][1]].lang_pred == "de" and pred[None, "THE DOG WAS THERE"].lang_pred == "en"
    none = L.identify(docs, L.learn(docs.where(F.lit(False))), keep=["doc_id"]).collect()
    assert {r.lang_pred for r in none} == {"und"}
    one = L.identify(docs, L.learn(docs.where("lang = 'de'")), keep=["doc_id"]).where("doc_id = 1").collect()
    assert (one[0].lang_pred, one[0].lang_score, one[0].lang_rejected) == ("de", 1.0, False)
    assert L.identify(docs.limit(0), L.learn(docs), keep=["doc_id"]).count() == 0


def test_a_language_of_copies_is_sampled_fully(spark):
    """40 different texts among 4,000 copies of another: each of them teaches."""
    word = lambda k: "".join(chr(97 + (k * 7 + j * j) % 26) for j in range(6))
    rows = [("xx", "copied copied text")] * 4000 + [("xx", " ".join(word(k * 50 + j) for j in range(20))) for k in range(40)]
    docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    learned = dict(L.learn(docs, sample_rows=50))["xx"].decode()
    assert all(word(k * 50) in learned for k in range(40))
    long = spark.createDataFrame([("first " * 500 + "last " * 500, "xx"), ("a" * 10, "xx")], "text string, lang string")
    assert len(dict(L.learn(long, sample_chars=400))["xx"]) > 300
