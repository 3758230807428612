"""Chat formatting as relational expressions.

Turns are collected per conversation in two steps (blocks of the turn number, then the
conversation), sorted, merged where neighbours share a role, and concatenated. The template is::

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n

``<|im_sep|>`` marks the seam of merged turns, so every turn can be read back. Inside texts and
roles the start of a mark (``<|``) gets a backslash, ``<\\|``; one that already has backslashes
gets one more, so the change is reversible and no text can hold a mark. A role's line feeds are
written ``%0A`` (and ``%`` as ``%25``).

Defined results: a NULL text or role counts as empty; NULL turns come first; equal turn numbers
are ordered by role, then text; repeated rows are separate turns; rows without a conversation id
form one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEAM, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Turn numbers per block of the first collection step.
BLOCK = 128


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: id, ``formatted``, and ``segments`` (text, loss), whose texts joined
    give ``formatted`` and whose ``loss`` flag is the loss mask (assistant texts without marks)."""
    rows = turns.select(
        F.col(conv).alias(conv),
        F.floor(F.col(turn) / BLOCK).alias("block"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"),
    )
    blocks = rows.groupBy(conv, "block").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    one = lambda t: F.struct(t["role"].alias("role"), F.array(t["text"]).alias("parts"))
    last = lambda acc: F.element_at(acc, -1)
    merged = F.aggregate(
        F.slice("ts", 2, F.size("ts")),
        F.array(one(F.element_at("ts", 1))),
        lambda acc, t: F.when(
            last(acc)["role"] == t["role"],
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(t["role"].alias("role"), F.concat(last(acc)["parts"], F.array(t["text"])).alias("parts"))),
            ),
        ).otherwise(F.concat(acc, F.array(one(t)))),
    )
    convs = blocks.select(conv, "block", merged.alias("ms")).groupBy(conv).agg(F.sort_array(F.collect_list(F.struct("block", "ms"))).alias("bs"))
    messages = convs.select(conv, F.flatten(F.col("bs.ms")).alias("ms"))

    def segments(m: Column, i: Column) -> Column:
        # a block's first message may continue the last message of the block before it
        opens = (i == 0) | (F.get("ms", i - 1)["role"] != m["role"])
        closes = (i == F.size("ms") - 1) | (F.get("ms", i + 1)["role"] != m["role"])
        mark = lambda s: F.struct(s.alias("text"), F.lit(False).alias("loss"))
        parts = F.transform(
            m["parts"],
            lambda p, j: F.array(
                mark(F.when(opens & (j == 0), F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n"))).otherwise(F.lit(SEAM))),
                F.struct(escape(p).alias("text"), (m["role"] == "assistant").alias("loss")),
            ),
        )
        return F.concat(F.flatten(parts), F.array(mark(F.when(closes, F.lit(END)).otherwise(F.lit("")))))

    out = messages.select(conv, F.flatten(F.transform("ms", segments)).alias("segments"))
    return out.select(conv, F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")


def read_chat(formatted: Column) -> Column:
    """The turns ``(role, text)`` of a formatted conversation, in order."""
    messages = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, F.length(formatted) + 1)

    def turns(m: Column) -> Column:
        role = F.substring_index(m, "\n", 1)
        body = F.substr(m, F.length(role) + 2, F.length(m) - F.length(role) - 1 - len(END))
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda p: F.struct(unescape_role(role).alias("role"), unescape(p).alias("text")))

    return F.flatten(F.transform(messages, turns))
