"""Preference formatting (operator 10), in DataFrame functions only.

A pair is a chosen and a rejected conversation. The longest prefix of turns that they share is
rendered once as prompt; what follows on either side is a completion. Of a completion only what an
assistant says (with its end mark) is learned from: masks give those parts as code points.

Defined results: turns are ordered by number, then role, then text; a null role is empty, and so
is a null text; a side without turns, or one that is a prefix of the other, has an empty
completion; rows that repeat a turn are turns each; a null pair_id is one pair; turns of another
side are not read; an empty table gives no rows; other columns are not read. A conversation is one
row of the result, so it must fit in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import column

#: Before and after a turn's text; ``{role}`` is replaced.
OPEN, CLOSE = "<|{role}|>\n", "<|end|>\n"
LEARNED = "assistant"


def _opened(role: Column, opening: str) -> Column:
    before, _, after = opening.partition("{role}")
    return F.concat(F.lit(before), role, F.lit(after))


def rendered(turns: Column, opening: str = OPEN, closing: str = CLOSE) -> Column:
    return F.array_join(
        F.transform(turns, lambda t: F.concat(_opened(t["role"], opening), t["text"], F.lit(closing))), ""
    )


def mask_of(turns: Column, learned: str = LEARNED, opening: str = OPEN, closing: str = CLOSE) -> Column:
    """Array of (start, end) of what is learned in the rendered turns, end exclusive."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, turn: Column) -> Column:
        start = acc["at"] + F.length(_opened(turn["role"], opening))
        end = start + F.length(turn["text"]) + len(closing)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == learned, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that are the same on both sides."""
    same = F.zip_with(
        a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False))
    )
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def format_pairs(
    turns: DataFrame,
    pair_id: str = "pair_id",
    side: str = "side",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: str = LEARNED,
    opening: str = OPEN,
    closing: str = CLOSE,
) -> DataFrame:
    """(pair_id, prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask) for each pair."""
    one = F.struct(
        column(turn).alias("turn"),
        F.coalesce(column(role), F.lit("")).alias("role"),
        F.coalesce(column(text), F.lit("")).alias("text"),
    )
    # A condition without value gives null, which the list leaves out.
    listed = lambda name: F.sort_array(F.collect_list(F.when(F.col("side") == name, F.col("one"))))
    rows = turns.select(column(pair_id).alias("pair_id"), column(side).alias("side"), one.alias("one"))
    pairs = rows.groupBy("pair_id").agg(listed("chosen").alias("c"), listed("rejected").alias("r"))
    pairs = pairs.withColumn("prompt_turns", common_turns(F.col("c"), F.col("r")))
    rest = lambda name: F.slice(name, F.col("prompt_turns") + 1, F.greatest(F.size(name), F.lit(1)))
    pairs = pairs.withColumns({"prompt_part": F.slice("c", F.lit(1), F.col("prompt_turns")), "c": rest("c"), "r": rest("r")})
    look = {"opening": opening, "closing": closing}
    return pairs.select(
        "pair_id",
        "prompt_turns",
        rendered(F.col("prompt_part"), **look).alias("prompt"),
        rendered(F.col("c"), **look).alias("chosen"),
        rendered(F.col("r"), **look).alias("rejected"),
        mask_of(F.col("c"), learned, **look).alias("chosen_mask"),
        mask_of(F.col("r"), learned, **look).alias("rejected_mask"),
    )


def echo_pairs(conversations: DataFrame) -> DataFrame:
    """Turns (pair_id, side, turn, role, text) of pairs made from conversations.

    Chosen is the conversation up to its last assistant turn; rejected is the same with that turn
    only repeating the one before. Without an assistant turn both sides are the conversation.
    """
    turn = F.struct("turn", "role", "text")
    last = conversations.groupBy("conv_id").agg(F.max(F.when(F.col("role") == LEARNED, F.col("turn"))).alias("last"))
    known = conversations.join(last.withColumnRenamed("conv_id", "own_id"), F.col("conv_id").eqNullSafe(F.col("own_id")))
    used = known.where("last is null or turn <= last")
    same = used.select(F.col("conv_id").alias("pair_id"), F.explode(F.array(F.lit("chosen"), F.lit("rejected"))).alias("side"), turn.alias("t"), "last")
    same = same.where("side = 'chosen' or last is null or t.turn < last").select("pair_id", "side", "t.turn", "t.role", "t.text")
    before = used.where("turn < last").groupBy("conv_id", "last").agg(F.max(F.struct("turn", "text")).alias("b"))
    ends = used.where("turn = last").groupBy(F.col("conv_id").alias("end_id")).agg(F.max("last").alias("end_turn"))
    echo = ends.join(before, F.col("conv_id").eqNullSafe(F.col("end_id")), "left").select(
        F.col("end_id").alias("pair_id"), F.lit("rejected").alias("side"), F.col("end_turn").alias("turn"), F.lit(LEARNED).alias("role"), F.col("b.text").alias("text")
    )
    return same.unionByName(echo)
