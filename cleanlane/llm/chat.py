"""Chat formatting: typed content parts rendered with a reversible turn template.

A message's content is an array of typed parts.  One pass over the parts (a
visitor, as array functions) puts text parts down escaped and gives every
image, audio and document part a placeholder in its place, recording the
attachment's reference and the number of tokens that the placeholder expands
to.  Everything runs as DataFrame functions; no Python touches the rows.

Escaping.  A backslash in a text becomes ``\\b``; a control string of the
template gets ``\\x`` behind its first character.  So no text can hold a
control string, and undoing ``\\x`` first and ``\\b`` second restores every
text.  In roles a line break becomes ``\\n``, as the first line break of a turn
ends its role.

Defined results.  Null role, text, reference or content: empty.  A part of
unknown or null type is a text part.  Attachments with null or non-positive
measures expand to one token.  Rows go by turn (nulls first); equal turns by
role and rendered text, so repeated rows are repeated turns.  A null
conversation id is a conversation of its own.  An empty table gives no rows.
Other columns are ignored, whatever their names.
One conversation is one output value and has to fit into a task; a
conversation's rows meet in one task for that reason alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Type of a message's content.
PARTS = T.ArrayType(
    T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("ref", T.StringType()),
            T.StructField("width", T.IntegerType()),
            T.StructField("height", T.IntegerType()),
            T.StructField("duration_ms", T.LongType()),
            T.StructField("pages", T.IntegerType()),
        ]
    )
)


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings and token costs.

    A control string starts with ``<`` and has no other ``<``, no backslash and
    no line break: no two of them can overlap, which makes the split exact.
    """

    opens: str = "<turn>"
    closes: str = "</turn>"
    image: str = "<image>"
    audio: str = "<audio>"
    document: str = "<document>"
    patch: int = 28
    audio_ms: int = 40
    page_tokens: int = 256
    loss_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for c in self.controls:
            if len(c) < 2 or c[0] != "<" or re.search(r"[<\\\n]", c[1:]):
                raise ValueError(f"{c!r} can't be a control string")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.opens, self.closes, self.image, self.audio, self.document)

    @property
    def kinds(self) -> dict[str, str]:
        return {"image": self.image, "audio": self.audio, "document": self.document}


def escape(c: Column, t: ChatTemplate) -> Column:
    rest = "|".join(re.escape(x[1:]) for x in t.controls)
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\b")), f"<(?={rest})", r"<\\x")


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\x"), F.lit("")), F.lit("\\b"), F.lit("\\"))


def _escape_role(c: Column, t: ChatTemplate) -> Column:
    return F.replace(escape(c, t), F.lit("\n"), F.lit("\\n"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\n"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """Content of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in PARTS.elementType.fields[2:]]))


def _tokens(p: Column, t: ChatTemplate) -> Column:
    """Tokens that a part's placeholder expands to."""
    n = (
        F.when(p["type"] == "image", F.ceil(p["width"] / t.patch) * F.ceil(p["height"] / t.patch))
        .when(p["type"] == "audio", F.ceil(p["duration_ms"] / t.audio_ms))
        .when(p["type"] == "document", p["pages"].cast("long") * t.page_tokens)
    )
    return F.greatest(F.coalesce(n, F.lit(1)).cast("long"), F.lit(1).cast("long"))


def visit(content: Column, t: ChatTemplate) -> tuple[Column, Column]:
    """(rendered text, attachments in order) of one message's parts."""
    parts = F.coalesce(content, F.array().cast(PARTS))
    known = list(t.kinds)

    def render(p):
        out = None
        for kind, mark in t.kinds.items():
            out = F.when(p["type"] == kind, F.lit(mark)) if out is None else out.when(p["type"] == kind, F.lit(mark))
        return out.otherwise(escape(F.coalesce(p["text"], F.lit("")), t))

    places = F.filter(
        F.transform(parts, lambda p, i: F.when(p["type"].isin(known), F.struct(i.alias("part"), p["type"].alias("kind"), F.coalesce(p["ref"], F.lit("")).alias("ref"), _tokens(p, t).alias("tokens")))),
        lambda x: x.isNotNull(),
    )
    return F.array_join(F.transform(parts, render), ""), places


def format_conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "content", template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row a conversation: its id, n_turns, formatted text, loss spans and attachments.

    ``loss_spans`` are (start, length) in code points of ``formatted``, one for
    each turn of a loss role; ``attachments`` are (turn, part, kind, ref,
    tokens) in order of their placeholders.
    """
    t = template
    text, places = visit(F.col(content), t)
    named = F.coalesce(F.col(role), F.lit(""))
    m = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), _escape_role(named, t).alias("head"), named.isin(*t.loss_roles).alias("loss"), text.alias("body"), places.alias("places"))
    m = m.withColumn("piece", F.concat(F.lit(t.opens), "head", F.lit("\n"), "body", F.lit(t.closes)))
    w = Window.partitionBy("conv").orderBy("turn", "head", "body")
    before = F.coalesce(F.sum(F.char_length("piece").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    m = m.select("conv", F.row_number().over(w).alias("i"), "piece", "places", F.when(F.col("loss"), F.struct((before + len(t.opens) + F.char_length("head") + 1).alias("start"), F.char_length("body").cast("long").alias("length"))).alias("span"))
    rows = m.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("i", "piece", "span", "places"))).alias("rows"))
    marks = F.flatten(F.transform("rows", lambda r: F.transform(r["places"], lambda p: F.struct((r["i"] - 1).alias("turn"), p["part"].alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")))))
    return rows.select(
        F.col("conv").alias(conv),
        F.size("rows").cast("long").alias("n_turns"),
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        marks.alias("attachments"),
    )


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """Array of (role, text) read back from a formatted text."""
    t = template
    bodies = F.filter(F.split(formatted, re.escape(t.closes), -1), lambda x: x != "")

    def parse(b):
        own = F.substring(b, len(t.opens) + 1, 2**31 - 1)
        return F.struct(_unescape_role(F.substring_index(own, "\n", 1)).alias("role"), unescape(F.substring(own, F.locate("\n", own) + 1, F.lit(2**31 - 1))).alias("text"))

    return F.transform(bodies, parse)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, read back by the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digests(formatted: DataFrame, conv: str = "conv_id", template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """What the formatted rows say when they are read back, as lengths and digests."""
    turns = read_turns(F.col("formatted"), template)
    spelled = F.array_join(F.transform(turns, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    out = formatted.select(conv, F.size(turns).cast("long").alias("n_turns"), spelled.alias("spelled"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted", "attachments")
    return out.select(
        conv,
        "n_turns",
        F.sha2("spelled", 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        F.coalesce(F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]), F.lit(0)).alias("attachment_tokens"),
    )
