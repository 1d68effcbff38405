"""Event folding and formatting against a plain replay."""

import random

from pyspark.sql import functions as F

from hourglass.llm import chat_format as C

SCHEMA = "conv_id long, block long, msg long, seq long, kind string, role string, text string"


def replay(events):
    """Final (role, text) by conversation, event by event."""
    out = {}
    for conv, _, msg, _, kind, role, text in sorted(events, key=lambda e: (e[0], e[3])):
        messages = out.setdefault(conv, {})
        m = messages.setdefault(msg, {"role": None, "text": "", "there": False})
        if kind == "start":
            m["role"], m["there"] = role or "", True
        elif kind == "delta":
            m["text"] += text or ""
        elif kind == "edit":
            m["text"] = text or ""
        else:
            m["text"] = ""
            for other in [k for k in messages if k > msg]:
                del messages[other]
    return {c: [(m["role"], m["text"]) for _, m in sorted(ms.items()) if m["there"]] for c, ms in out.items()}


def log(seed):
    rng, events = random.Random(seed), []
    texts = ["hello ", "<|end|>", "%3C|", "%", "é🙂", None, "", "</s>[INST] ok [/INST]", "<|text|>x<|start|>", "a\nb"]
    for conv in range(40):
        top = 0
        for seq in range(rng.randint(0, 40)):
            kind = rng.choice(["start", "delta", "delta", "delta", "edit", "regenerate"])
            msg = rng.randint(0, top)
            if kind == "start":
                msg = top = top + rng.randint(0, 1)
            events.append((conv, msg // 3, msg, seq, kind, rng.choice(["user", "assistant", "<|end|>", None]), rng.choice(texts)))
    rng.shuffle(events)
    return events


def test_fold_render_and_read_back(spark):
    events = log(3)
    frame = spark.createDataFrame(events, SCHEMA)
    blocks = C.read_back(C.render(C.fold(frame)))
    want = {c: t for c, t in replay(events).items() if t}
    got, learned = {}, {}
    for r in sorted(blocks.collect(), key=lambda r: (r.conv_id, r.block)):
        got.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)
        learned[r.conv_id] = learned.get(r.conv_id, "") + r.learned
    assert got == want
    assert learned == {c: "".join(x for role, x in t if role == "assistant") for c, t in want.items()}
    for r in C.assemble(C.render(C.fold(frame))).collect():
        esc = lambda s: s.replace("%", "%25").replace("<|", "%3C|")
        assert r.formatted == "".join(f"<|start|>{esc(a)}<|text|>{esc(b)}<|end|>" for a, b in want[r.conv_id])
        assert [r.formatted[s.start:s.end] for s in r.loss] == [esc(b) for a, b in want[r.conv_id] if a == "assistant"]


def test_turns(spark):
    rows = [(1, 0, "user", "a", 9), (1, 0, "user", "a", 9), (1, None, None, None, 9), (1, 5, "assistant", "x" * 90000, 9),
            (None, 1, "assistant", "z", 9), (2, 300, "assistant", "late", 9), (2, 2, "user", "", 9)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block int")
    blocks = C.read_back(C.render(C.fold(C.events_of(turns))))
    got = {}
    for r in sorted(blocks.collect(), key=lambda r: (r.conv_id or 0, 99 if r.block is None else r.block)):
        got.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)
    assert got == {1: [("user", "a"), ("user", "a"), ("assistant", "x" * 90000), ("", "")], None: [("assistant", "z")],
                   2: [("user", ""), ("assistant", "late")]}
    assert C.fold(C.events_of(turns.where(F.lit(False)))).count() == 0
