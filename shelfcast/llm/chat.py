"""Chat formatting by prefix-target expansion: each assistant turn is an example of its own, after all turns before it.

DataFrame functions only. The template marks turns; five signs are escaped inside roles and texts, so that no text
can hold a mark, and every text can be read back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template, and the signs that texts must not show, in order of escaping
BEGIN, OPEN, OPENED, CLOSE, END = "<s>", "[INST:", "]", "[/INST]", "</s>"
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lb;"), ("]", "&rb;")]
ANSWER = "assistant"


def escaped(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)


def unescaped(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), text)


def chat_examples(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_end, whole): one row per assistant turn of a conversation.

    ``formatted`` holds the turns up to and with the reply; of it only the code points from ``loss_start`` to
    ``loss_end`` (from 0, end exclusive), the reply's escaped text, are trainable. ``example`` is the number of turns
    in it. A conversation that does not end with an assistant turn has one more row with all turns and an empty mask,
    so that nothing is lost; ``whole`` marks the row that holds all turns. Turns are ordered by number, then role and
    text, nulls first; null roles and texts are empty; rows with a null conversation are one conversation. A
    conversation is held by one task, an example at a time: their texts grow with the square of its turns.
    """
    role, text = (F.coalesce(df[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.groupBy(df[conv_col].alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct(df[turn_col].alias("turn"), role.alias("role"), text.alias("text")))).alias("turns"))
    marked = F.transform("turns", lambda t: F.struct((t["role"] == ANSWER).alias("answer"), F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(OPENED)).alias("head"), escaped(t["text"]).alias("body")))
    held = turns.select("conv_id", F.size("turns").alias("n"), marked.alias("marked"))
    ends = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: (i == F.col("n")) | F.get("marked", i - 1)["answer"])
    parts = held.select("conv_id", "n", "marked", F.explode(ends).alias("example"))
    last = F.get("marked", F.col("example") - 1)
    before = F.array_join(F.transform(F.slice("marked", 1, F.col("example") - 1), lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    shaped = parts.select("conv_id", "example", (F.col("example") == F.col("n")).alias("whole"), F.concat(F.lit(BEGIN), before, last["head"]).alias("context"), last["body"].alias("body"), last["answer"].alias("answer"))
    start = F.length("context").cast("long")
    return shaped.select(
        "conv_id",
        "example",
        F.concat("context", "body", F.lit(CLOSE), F.when(F.col("answer"), F.lit(END)).otherwise(F.lit(""))).alias("formatted"),
        start.alias("loss_start"),
        (start + F.when(F.col("answer"), F.length("body")).otherwise(F.lit(0))).cast("long").alias("loss_end"),
        "whole",
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, as they were before formatting."""
    inner = F.replace(F.substr(formatted, F.lit(len(BEGIN) + 1)), F.lit(END), F.lit(""))
    parts = F.split(inner, r"\[/INST\]")
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(
            unescaped(F.substr(F.substring_index(p, OPENED, 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescaped(F.substring_index(p, OPENED, -1)).alias("text"),
        ),
    )


def trained_text(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescaped(F.substr(formatted, (start + 1).cast("int"), (end - start).cast("int")))
