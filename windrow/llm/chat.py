"""Chat formatting with typed content parts, in DataFrame operations only.

A turn's content is an ordered array of parts (text, image, audio, document). A visitor flattens
them: text is escaped, any other part becomes a numbered placeholder, its reference is recorded
as an attachment together with the number of tokens the placeholder stands for.

    <|role|>\\n content <|end|>\\n

Escapes keep texts free of control strings, of this template and of others that open with
``<`` or ``[``: ``~`` is written ``~0``, ``<`` is ``~1``, ``[`` is ``~2``, and a line end within a role is ``~3``.
Undoing them in the opposite order restores any text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens that a part stands for: a patch of an image, a second of audio, a page of a document.
PATCH, AUDIO_PER_SECOND, PAGE_TOKENS = 14, 25, 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<"), F.lit("~1")), F.lit("["), F.lit("~2"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(F.replace(text, F.lit("~3"), F.lit("\n")), F.lit("~2"), F.lit("[")), F.lit("~1"), F.lit("<")), F.lit("~0"), F.lit("~"))


def text_parts(text: Column) -> Column:
    """A content of one text part."""
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *empty))


def _tokens(part: Column) -> Column:
    image = F.ceil(F.coalesce(part.width, F.lit(0)) / PATCH) * F.ceil(F.coalesce(part.height, F.lit(0)) / PATCH)
    audio = F.ceil(F.coalesce(part.seconds, F.lit(0.0)) * AUDIO_PER_SECOND)
    pages = F.coalesce(part.pages, F.lit(0)) * PAGE_TOKENS
    return F.when(part.type == "image", image).when(part.type == "audio", audio).when(part.type == "document", pages).otherwise(F.lit(0)).cast("long")


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, formatted, loss (spans), attachments.

    ``turns`` has conv_id, turn, role and parts (array of :data:`PART`; null parts or texts count as empty,
    parts of unknown type are skipped). ``loss`` lists (start, length) of assistant texts in ``formatted``,
    in code points from 1. ``attachments`` lists (turn_no, type, ref, tokens) in the order of the placeholders.
    Turns go by ``turn`` (null first), equal turns by role and content; repeated rows all stay; a null conv_id
    is a conversation of its own and a null role is the empty role. Other columns are ignored.
    """
    kinds = ["image", "audio", "document"]
    visited = turns.select(
        "conv_id",
        F.col("turn"),
        F.replace(escape(F.coalesce(F.col("role"), F.lit(""))), F.lit("\n"), F.lit("~3")).alias("role"),
        F.concat_ws(
            "",
            F.transform(
                F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")),
                lambda p: F.when(p.type == "text", escape(F.coalesce(p.text, F.lit("")))).when(p.type.isin(kinds), F.concat(F.lit("<|"), p.type, F.lit("|>"))).otherwise(F.lit("")),
            ),
        ).alias("content"),
        F.transform(F.filter("parts", lambda p: p.type.isin(kinds)), lambda p: F.struct(p.type.alias("type"), p.ref.alias("ref"), _tokens(p).alias("tokens"))).alias("media"),
    )
    ordered = visited.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "content", "media"))).alias("t"))
    written = ordered.select(
        "conv_id",
        "t",
        F.concat_ws("", F.transform("t", lambda x: F.concat(F.lit("<|"), x.role, F.lit("|>\n"), x.content, F.lit("<|end|>\n")))).alias("formatted"),
        # the running end of each turn: 2 + role + 3 + content + 8 code points
        F.aggregate(
            "t",
            F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
            lambda a, x: F.struct(
                (a.at + F.char_length(x.role) + F.char_length(x.content) + 13).cast("long").alias("at"),
                F.when(
                    x.role == "assistant",
                    F.concat(a.spans, F.array(F.struct((a.at + F.char_length(x.role) + 6).cast("long").alias("start"), F.char_length(x.content).cast("long").alias("length")))),
                )
                .otherwise(a.spans)
                .alias("spans"),
            ),
        ).spans.alias("loss"),
    )
    media = F.flatten(F.transform("t", lambda x, i: F.transform(F.coalesce(x.media, F.array().cast("array<struct<type:string,ref:string,tokens:bigint>>")), lambda m: F.struct(i.alias("turn_no"), m.type.alias("type"), m.ref.alias("ref"), m.tokens.alias("tokens")))))
    return written.select("conv_id", "formatted", "loss", media.alias("attachments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse ``formatted`` into turns again: conv_id, formatted, loss, turns (array of role and text), loss_text."""
    blocks = F.filter(F.split("formatted", r"<\|end\|>\n"), lambda b: b != "")
    turns = F.transform(
        blocks,
        lambda b: F.struct(unescape(F.substring_index(F.substr(b, F.lit(3)), "|>\n", 1)).alias("role"), unescape(F.substr(b, F.instr(b, "|>\n") + 3)).alias("text")),
    )
    masked = F.concat_ws("", F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s.start.cast("int"), s.length.cast("int")))))
    return formatted.select("conv_id", "formatted", "loss", turns.alias("turns"), masked.alias("loss_text"))
