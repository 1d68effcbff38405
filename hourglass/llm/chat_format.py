"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

An event has ``conv_id``, ``block``, ``msg``, ``seq``, ``kind``, ``role`` and
``text``.  Messages of a conversation are ordered by ``msg`` (any type that
sorts), events by ``seq``; ``block`` is any column that does not decrease along
``msg``, and splits long conversations.  Kinds:

* ``start``: the message exists, with ``role``;
* ``delta``: ``text`` goes on;
* ``edit``: the message's text so far becomes ``text``;
* ``regenerate``: the message's text so far is dropped, and with it all that
  came before, in ``seq``, in later messages of the conversation.

A message without a ``start`` left does not exist.

``fold`` gives the final messages, ``render`` their text by block:
``<|start|>role<|text|>text<|end|>`` for each turn, with ``%`` written as
``%25`` and ``<|`` as ``%3C|`` inside role and text.  So no marker can come
from a text, and writing and reading are exact inverses.  The loss mask of a
block covers each assistant text (offsets in code points, end exclusive).
``read_back`` takes turns and loss text out of rendered blocks again, and
``assemble`` joins the blocks of a conversation.

Skew.  One shuffle on (conversation, block) serves the fold and the rendering,
so a long conversation is spread over its blocks; only its finished strings
meet in one row.  A conversation's regenerations travel as one row, and only
if there are any.

Edge cases: null roles and texts are empty ones; a null conversation id is a
conversation; a null turn number comes last; turns with equal numbers follow by role and then by a hash of
the text, repeated rows are repeated turns; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import table

START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"
BLOCK_TURNS = 64


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%3C|"), F.lit("<|")), F.lit("%25"), F.lit("%"))


def events_of(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The event log of a table with a row per turn: each turn is started and then written."""
    row = turns.select("conv_id", F.floor(F.col("turn") / block_turns).alias("block"),
                       F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.xxhash64("text").alias("tie"),
                                F.monotonically_increasing_id().alias("copy")).alias("msg"), "role", "text")
    event = lambda kind, seq, role, text: F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"),
                                                   role.alias("role"), text.alias("text"))
    none = F.lit(None).cast("string")
    return row.select("conv_id", "block", "msg", F.inline(F.array(
        event("start", 0, F.col("role"), none), event("delta", 1, none, F.col("text")))))


def _cut(events: DataFrame) -> DataFrame:
    """Without the events that an earlier message's regeneration has dropped."""
    again = events.where(F.col("kind") == "regenerate").select("conv_id", "msg", "seq")
    if again.isEmpty():
        return events
    again = again.groupBy("conv_id", "msg").agg(F.max("seq").alias("seq"))
    again = again.groupBy("conv_id").agg(F.collect_list(F.struct("msg", "seq")).alias("again"))
    again = again.withColumnRenamed("conv_id", "again_id")
    joined = events.join(again, events["conv_id"].eqNullSafe(F.col("again_id")), "left")
    gone = F.exists(F.col("again"), lambda r: (r["msg"] < F.col("msg")) & (r["seq"] > F.col("seq")))
    return joined.where(~F.coalesce(gone, F.lit(False))).select(*events.columns)


def fold(events: DataFrame) -> DataFrame:
    """conv_id, block, msg, role, text of the messages that are left."""
    kind = F.col("kind")
    events = _cut(events).repartition("conv_id", "block")
    messages = events.groupBy("conv_id", "block", "msg").agg(
        F.max_by("role", F.when(kind == "start", F.col("seq"))).alias("role"),
        F.count(F.when(kind == "start", 1)).alias("starts"),
        F.max(F.when(kind.isin("edit", "regenerate"), F.col("seq"))).alias("since"),
        F.array_sort(F.collect_list(F.when(kind.isin("delta", "edit"), F.struct("seq", "text")))).alias("written"))
    kept = F.filter("written", lambda w: F.col("since").isNull() | (w["seq"] >= F.col("since")))
    text = F.array_join(F.transform(kept, lambda w: F.coalesce(w["text"], F.lit(""))), "")
    return messages.where("starts > 0").select("conv_id", "block", "msg", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, block, formatted and loss, the mask's (start, end) within the block."""
    blocks = messages.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("msg", "role", "text"))).alias("turns"))
    parts = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), escape(t["role"]), F.lit(TEXT)).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == LOSS_ROLE).alias("learned")))
    blocks = blocks.select("conv_id", "block", parts.alias("parts"))
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.char_length(p["head"])
        end = start + F.char_length(p["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct((end + len(END)).alias("at"), F.when(p["learned"], F.concat(acc["loss"], F.array(span))).otherwise(acc["loss"]).alias("loss"))

    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("loss"))
    return blocks.select("conv_id", "block", formatted.alias("formatted"), F.aggregate("parts", zero, step, lambda a: a["loss"]).alias("loss"))


def read_back(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``turns`` (role, text) and ``learned``, the text under the loss mask, taken from the formatted text."""
    pieces = F.split("formatted", r"<\|end\|>", -1)
    turn = lambda x: F.struct(
        unescape(F.substring(F.substring_index(x, TEXT, 1), len(START) + 1, 1 << 30)).alias("role"),
        unescape(F.substring_index(x, TEXT, -1)).alias("text"))
    turns = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)
    learned = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    return blocks.withColumn("turns", turns).withColumn("learned", learned)


def assemble(blocks: DataFrame) -> DataFrame:
    """conv_id, formatted and loss of whole conversations."""
    whole = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "formatted", "loss"))).alias("blocks"))

    def step(acc: Column, b: Column) -> Column:
        moved = F.transform(b["loss"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end")))
        return F.struct((acc["at"] + F.char_length(b["formatted"])).alias("at"), F.concat(acc["loss"], moved).alias("loss"))

    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("loss"))
    return whole.select("conv_id", F.array_join(F.col("blocks.formatted"), "").alias("formatted"),
                        F.aggregate("blocks", zero, step, lambda a: a["loss"]).alias("loss"))


def op5_chat_format(spark, sf_dir):
    """Per conversation: turns, text under the loss mask and length, read back from the formatted blocks."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    own = spark.sql("""SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'),
                                            (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)""")
    blocks = read_back(render(fold(events_of(turns.union(own)))))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    found = blocks.select("conv_id", "block", F.size("turns").cast("long").alias("n"), spoken.alias("spoken"), "learned",
                          F.char_length("formatted").cast("long").alias("chars"))
    whole = found.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("block", "spoken", "learned"))).alias("blocks"),
        F.sum(F.char_length("learned").cast("long")).alias("loss_chars"), F.sum("chars").alias("formatted_chars"))
    return whole.select("conv_id", "n_turns", F.sha2(F.array_join("blocks.spoken", ""), 256).alias("turns_sha256"), "loss_chars",
                        F.sha2(F.array_join("blocks.learned", ""), 256).alias("loss_sha256"), "formatted_chars")


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
e AS (
  SELECT *, length('<|start|><|text|><|end|>') + length(replace(replace(role, '%', '%25'), '<|', '%3C|'))
            + length(replace(replace(text, '%', '%25'), '<|', '%3C|')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
