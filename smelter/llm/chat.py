r"""Chat formatting: typed content parts flattened into marked turns, and read back.

A message holds parts of type text, image, audio or document. Text is escaped; every other
part becomes one placeholder, and what it stands for is recorded in order: kind, reference
and the number of tokens that its placeholder expands to.

A turn is ``<|turn|>role<|text|>parts<|end|>``, with ``<|text|>`` once more between two texts that follow each other. A control string inside a role or text gets
one backslash more after its first character (``</s>`` becomes ``<\/s>``, ``<\/s>`` becomes
``<\\/s>``), so no control string of a text survives and taking one away restores it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}

#: What may not stay whole inside a text, after its first character < or [.
_REST = r"(\|(?:turn|text|end|image|audio|document)\|>|/?s>|/?INST\])"
ESCAPE = r"([<\[])(\\*)" + _REST
UNESCAPE = r"([<\[])\\(\\*)" + _REST

PART_TYPE = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


@dataclass(frozen=True)
class TokenCosts:
    """Tokens that a placeholder expands to: by patches of an image, seconds of audio, pages of a document."""

    patch: int = 28
    per_second: float = 25.0
    per_page: int = 512


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def text_parts(text: Column) -> Column:
    """A message of one text part."""
    nothing = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"),
                            *(F.lit(None).cast(t).alias(n) for n, t in nothing.items())))


def _is_text(part: Column) -> Column:
    return ~F.coalesce(part["type"].isin(*PLACEHOLDERS), F.lit(False))


def _visit(parts: Column) -> Column:
    """The parts as they stand in the formatted text; a kind that is unknown counts as text.

    Between two texts stands a mark: each is escaped on its own, and together they could make a control string.
    """
    def one(part: Column, i: Column) -> Column:
        shown = escaped(F.coalesce(part["text"], F.lit("")))
        before = F.get(parts, i - 1)
        shown = F.when((i > 0) & _is_text(before), F.concat(F.lit(TEXT), shown)).otherwise(shown)
        for kind, placeholder in PLACEHOLDERS.items():
            shown = F.when(part["type"] == kind, F.lit(placeholder)).otherwise(shown)
        return shown

    return F.transform(parts, one)


def _expanded(part: Column, costs: TokenCosts) -> Column:
    def patches(side: str) -> Column:
        return F.ceil(F.coalesce(part[side], F.lit(0)) / costs.patch)

    return (
        F.when(part["type"] == "image", patches("width") * patches("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * costs.per_second))
        .otherwise(F.coalesce(part["pages"], F.lit(0)).cast("bigint") * costs.per_page)
    ).cast("bigint")


def format_chats(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 parts: str = "parts", costs: TokenCosts = TokenCosts()) -> DataFrame:
    """One formatted string per conversation, with its attachments in order.

    ``parts`` has the type ``PART_TYPE``. Gives ``conv``, ``formatted``, ``attachments``
    (place in the conversation, kind, ref, tokens) and ``expanded_tokens``, their sum.

    Null conversation ids form one conversation. Null roles, texts and parts are empty. Turns go
    by number, nulls first; equal numbers by their formatted text, so repeated rows stay and
    the order never depends on arrival. An empty table gives no rows; further columns of the
    input are left out. Turns are flattened and escaped before the shuffle. A conversation is one
    string by definition, so it must fit into one row (2 GB).
    """
    kept = F.coalesce(F.col(parts), F.array().cast(PART_TYPE))
    shown = F.concat(F.lit(TURN), escaped(F.coalesce(F.col(role), F.lit(""))), F.lit(TEXT),
                     F.concat_ws("", _visit(kept)), F.lit(END))
    attached = F.transform(
        F.filter(kept, lambda p: F.coalesce(p["type"].isin(*PLACEHOLDERS), F.lit(False))),
        lambda p: F.struct(p["type"].alias("kind"), p["ref"].alias("ref"), _expanded(p, costs).alias("tokens")))
    turns = messages.select(F.col(conv).alias("conv"), F.struct(
        F.col(turn).cast("bigint").alias("turn"), shown.alias("shown"), attached.alias("attached")).alias("said"))
    ordered = turns.groupBy("conv").agg(F.sort_array(F.collect_list("said")).alias("said"))
    flat = F.flatten(F.transform("said", lambda t: t["attached"]))
    placed = F.transform(flat, lambda a, i: F.struct(i.cast("bigint").alias("place"), a["kind"].alias("kind"),
                                                     a["ref"].alias("ref"), a["tokens"].alias("tokens")))
    return ordered.select(
        F.col("conv").alias(conv),
        F.concat_ws("", F.transform("said", lambda t: t["shown"])).alias("formatted"),
        placed.alias("attachments"),
        F.aggregate(flat, F.lit(0).cast("bigint"), lambda total, a: total + a["tokens"]).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string in order: an array of role and unescaped text.

    Placeholders stay in the text; the nth stands for the nth attachment.
    """
    said = F.filter(F.split(formatted, r"<\|turn\|>"), lambda _, i: i > 0)

    def one(turn: Column) -> Column:
        sides = F.split(F.regexp_replace(turn, r"<\|end\|>", ""), r"<\|text\|>", 2)
        texts = F.transform(F.split(sides[1], r"<\|text\|>"), unescaped)
        return F.struct(unescaped(sides[0]).alias("role"), F.concat_ws("", texts).alias("text"))

    return F.transform(said, one)


def loss_text(turns: Column, role: str = "assistant") -> Column:
    """All text under the loss mask: each of the role's texts once, in order, nothing between."""
    return F.concat_ws("", F.transform(F.filter(turns, lambda t: t["role"] == role), lambda t: t["text"]))
