"""Preference formatting: one prompt and two masked completions for each pair of conversations.

The turns of both sides are merged by their content, which finds what they share; the
first turn that only one side has ends the common prefix. The prefix is rendered once as the prompt,
the rest of each side as its completion, with the character spans to train on (what the
assistant says). Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHOSEN, REJECTED = 1, 2


def _header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"))


def _body(turn: Column) -> Column:
    """Text in which no marker can be forged."""
    return F.concat(F.replace(F.coalesce(turn["text"], F.lit("")), F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def _trained_spans(turns: Column) -> Column:
    """Spans [start, end) of code points that the assistant says, end markers included."""
    empty = F.array().cast("array<struct<start:long,end:long>>")
    first = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_header(turn))
        end = (start + F.length(_body(turn))).cast("long")
        span = F.array(F.struct(start.cast("long").alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, first, add, lambda state: state["spans"])


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row for each pair_id of either side. Both sides: pair_id, turn, role, text.

    prompt (the longest common prefix of turns, rendered), chosen and rejected (the rest of each side),
    chosen_spans and rejected_spans (arrays of start, end in the completion), prompt_turns. Turns
    go in the order of turn, then role, then text, nulls first; repeated rows count once; turns align by
    their number. A side without rows has an empty completion, and so have both sides of equal
    conversations. A null role or text is rendered as nothing. Other columns are ignored.

    A row is one training example, so the turns of a pair meet in one task; pairs are
    found and merged before that by content, where no pair has a task of its own.
    """
    sides = [
        df.select("pair_id", "turn", "role", "text", F.lit(side).alias("side")) for df, side in ((chosen, CHOSEN), (rejected, REJECTED))
    ]
    merged = sides[0].unionByName(sides[1]).groupBy("pair_id", "turn", "role", "text").agg(F.bit_or("side").alias("side"))
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "side")), _by_turn)
    # The first turn number at which the sides differ; a missing number sorts first.
    differs = F.min(F.when(F.col("side") != CHOSEN | REJECTED, F.struct(F.col("turn").isNotNull().alias("known"), "turn")))
    pairs = merged.groupBy("pair_id").agg(turns.alias("turns"), differs.alias("from"))

    def common(t: Column) -> Column:
        return F.col("from").isNull() | (F.struct(t["turn"].isNotNull().alias("known"), t["turn"].alias("turn")) < F.col("from"))

    def rest(side: int) -> Column:
        return F.filter("turns", lambda t: ~common(t) & (t["side"].bitwiseAND(F.lit(side)) == side))

    parts = pairs.select("pair_id", F.filter("turns", common).alias("p"), rest(CHOSEN).alias("c"), rest(REJECTED).alias("r"))
    return parts.select(
        "pair_id", _render(F.col("p")).alias("prompt"), _render(F.col("c")).alias("chosen"), _render(F.col("r")).alias("rejected"),
        _trained_spans(F.col("c")).alias("chosen_spans"), _trained_spans(F.col("r")).alias("rejected_spans"),
        F.size("p").alias("prompt_turns"),
    )


def _by_turn(a: Column, b: Column) -> Column:
    order = F.lit(0)
    for name in ("text", "role", "turn"):
        x, y = a[name], b[name]
        order = (
            F.when(x.isNull() & y.isNotNull(), -1).when(x.isNotNull() & y.isNull(), 1)
            .when(x < y, -1).when(x > y, 1).otherwise(order)
        )
    return order
