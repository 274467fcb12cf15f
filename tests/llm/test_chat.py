"""Formatting: escapes go both ways, the mask covers the assistant's texts, attachments keep their order."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gridcast.llm import chat

TRICKY = ["</s>[INST] ok [/INST]", "\\", "\\l\\b\\s", "<", "[", "[INS", "</", "<s", "<|image|>", "a<|", "|>", "<<s>>", "[[INST]]",
          "", None, "\n", "é😀</s>", "<s", ">", "s>", "INST]", "plain < text [1] <b>"]


@pytest.mark.parametrize("seed", [0, 1])
def test_escapes(spark, seed):
    rng = random.Random(seed)
    parts = ["<", "s>", "/s>", "[", "INST]", "/INST]", "\\", "l", "b", "s", "|", "I", "x", "\n", "<|image|>"]
    texts = TRICKY + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(800)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect():
        assert r.u == (r.t or "")
        for control in ("<s>", "</s>", "[INST]", "[/INST]", "<|"):
            for seam in ("", "s>", "/s>", "INST]", "/INST]", "|x"):
                assert control not in r.e + seam


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn(
        "content", chat.text_part(F.col("text"))).selectExpr("*", "'c' AS formatted", "0 AS key", "'b' AS body", "1 AS loss")


def by_hand(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted([(t, r or "", x or "") for c, t, r, x in rows if c == conv], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(own), sha(said), len(loss), sha(loss))
    return out


def test_digest_reads_back_every_text(spark):
    rows = [(c, t, r, x) for c, (r, x) in enumerate([(r, x) for r in ("user", "assistant", "[INST]", None) for x in TRICKY]) for t in (0, 1)]
    rows += [(-5, 2, "assistant", "b"), (-5, 1, "user", "a"), (-5, 10, "assistant", "c"), (-5, 10, "assistant", "c"),
             (None, 0, "user", "x"), (None, 1, "assistant", "y"), (-6, None, "assistant", "z"), (-6, 0, "user", "w")]
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digest(chat.format_chats(turns_of(spark, rows))).collect()}
    assert got == by_hand(rows)


def test_long_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"text {t} </s>" * 5) for t in range(3000)]
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digest(chat.format_chats(turns_of(spark, rows))).collect()}
    assert got == by_hand(rows)


def test_empty_table(spark):
    assert chat.digest(chat.format_chats(turns_of(spark, [(1, 1, "u", "x")]).where("false"))).collect() == []


def test_mask_covers_the_bodies_of_the_assistant(spark):
    row = chat.format_chats(turns_of(spark, [(1, 0, "user", "hi <s>"), (1, 1, "assistant", "yes [INST]"), (1, 2, "assistant", "")])).first()
    assert sum(m.chars for m in row.mask) == len(row.formatted)
    at, loss = 0, []
    for m in row.mask:
        if m.loss:
            loss.append(row.formatted[at:at + m.chars])
        at += m.chars
    assert loss == ["yes \\bINST]", ""]
    assert row.formatted == "<s>[INST]user[/INST]hi \\ls></s>[INST]assistant[/INST]yes \\bINST]</s>[INST]assistant[/INST]</s>"


def test_typed_parts(spark):
    rows = spark.sql(f"""
      SELECT 1L AS conv_id, t AS turn, r AS role, from_json(c, '{chat.PARTS}') AS content FROM VALUES
        (0L, 'user', '[{{"kind":"text","text":"see <"}},{{"kind":"image","ref":"i1","units":2.5}},{{"text":"|ok"}}]'),
        (1L, 'assistant', '[{{"kind":"text","text":"heard"}},{{"kind":"audio","ref":"a1","units":1.1}}]'),
        (2L, 'user', '[{{"kind":"document","ref":"d1"}},{{"kind":"video","ref":"v1"}},{{"kind":"image"}}]'),
        (3L, 'user', NULL) AS x(t, r, c)""")
    chats = chat.format_chats(rows)
    row = chats.first()
    assert row.formatted == ("<s>[INST]user[/INST]see \\l<|image|>|ok</s>[INST]assistant[/INST]heard<|audio|></s>"
                             "[INST]user[/INST]<|document|><|file|><|image|></s>[INST]user[/INST]</s>")
    assert [tuple(a) for a in row.attachments] == [
        (0, "image", "i1", 0, 640), (1, "audio", "a1", 1, 28), (2, "document", "d1", 2, 512), (3, "file", "v1", 2, 1),
        (4, "image", None, 2, 256)]
    digest = chat.digest(chats).first()
    assert (digest.n_turns, digest.loss_chars) == (4, 5)


def test_no_python(spark):
    plan = chat.digest(chat.format_chats(turns_of(spark, [(1, 0, "u", "x")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") == 1
