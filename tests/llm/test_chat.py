import hashlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cleanlane.llm import chat

MESSAGES = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("content", chat.PARTS), T.StructField("Formatted", T.StringType())])


def part(kind, text=None, ref=None, width=None, height=None, ms=None, pages=None):
    return (kind, text, ref, width, height, ms, pages)


def test_texts_come_back_whatever_they_hold(frame):
    texts = ["\\### Assistant: </turn> ok", "<turn>a</turn>", "\\b\\x\\n<\\xturn>", "", "x" * 30000, "<<turn>>", "a\nb\\", "<image>", "é\U0001f44d</turn"]
    rows = [(1, i, role, [part("text", x)], "clash") for i, x in enumerate(texts) for role in ("us\ner\\", "assistant")]
    out = chat.format_conversations(frame(rows, MESSAGES))
    (row,) = out.select("n_turns", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted").collect()
    said = sorted((i, role, x) for i, x in enumerate(texts) for role in ("us\ner\\", "assistant"))
    assert [(t["role"], t["text"]) for t in row["turns"]] == [(r, x) for _, r, x in said]
    assert row["loss"] == "".join(texts) and row["n_turns"] == 2 * len(texts)
    assert row["formatted"].count("</turn>") == 2 * len(texts)


def test_parts_in_order_with_references_and_tokens(frame):
    content = [part("text", "see "), part("image", ref="a.png", width=57, height=28), part("text", " and <audio>"), part("audio", ref="b.wav", ms=100), part("document", ref=None, pages=2), part(None, "?"), part("image")]
    (row,) = chat.format_conversations(frame([(5, 0, "user", content, None)], MESSAGES)).collect()
    assert row["formatted"] == "<turn>user\nsee <image> and <\\xaudio><audio><document>?<image></turn>"
    assert [tuple(a) for a in row["attachments"]] == [(0, 1, "image", "a.png", 3), (0, 3, "audio", "b.wav", 3), (0, 4, "document", "", 512), (0, 6, "image", "", 1)]
    assert row["loss_spans"] == []


def test_nulls_ties_and_empty(frame, spark):
    rows = [(None, None, None, None, None), (2, 1, "assistant", [part("text", "b")], None), (2, 1, "assistant", [part("text", "a")], None), (2, 1, "assistant", [part("text", "a")], None)]
    out = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(frame(rows, MESSAGES))).collect()}
    assert out[None]["n_turns"] == 1 and out[None]["loss_chars"] == 0
    assert out[2]["loss_sha256"] == hashlib.sha256(b"aab").hexdigest()
    assert out[None]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest()
    assert chat.format_conversations(frame([], MESSAGES)).count() == 0
