"""Preference formatting, as column expressions only.

The turns that chosen and rejected conversation share from the start are rendered once as the
prompt; the rest of each is its completion. A completion's mask covers what the model is to learn:
the text of assistant turns with its end mark, not role headers and not other roles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, AFTER, END = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED = "assistant"
TURNS = "array<struct<turn: long, role: string, text: string>>"
NO_SPANS = "array<struct<start: long, length: long>>"


def _header(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), F.coalesce(turn["role"], F.lit("")), F.lit(AFTER))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """(start, length) in code points of the learned stretches of ``rendered(turns)``."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.array().cast(NO_SPANS).alias("spans"))

    def grown(acc: Column, turn: Column) -> Column:
        begin = acc["end"] + F.length(_header(turn))
        length = F.length(_body(turn)).cast("long")
        span = F.struct(begin.alias("start"), length.alias("length"))
        spans = F.when(turn["role"] == LEARNED, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((begin + length).alias("end"), spans.alias("spans"))

    return F.aggregate(turns, start, grown, lambda acc: acc["spans"])


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order; a repeated turn number orders by role and text."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return turns.filter("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per row of ``pairs`` (pair_id, chosen, rejected: conv_ids).

    pair_id, chosen, rejected, n_shared (turns), prompt, both completions, their masks and numbers of
    masked code points. Turns are equal if role and text are, whatever their numbers. A null role or text
    is empty. A conversation that is missing or null has no turns; two equal ones have empty
    completions. Further columns are ignored; empty tables give no rows.
    """
    whole = conversations(turns)
    sides = pairs.select("pair_id", "chosen", "rejected")
    for side in ("chosen", "rejected"):
        own = whole.select(F.col("conv_id").alias(side), F.col("turns").alias(f"{side}_turns"))
        sides = sides.join(own, side, "left").withColumn(f"{side}_turns", F.coalesce(f"{side}_turns", F.array().cast(TURNS)))
    return compared(sides)


def _same(x: Column, y: Column) -> Column:
    return (F.coalesce(x["role"], F.lit("")) == F.coalesce(y["role"], F.lit(""))) & (F.coalesce(x["text"], F.lit("")) == F.coalesce(y["text"], F.lit("")))


def compared(sides: DataFrame) -> DataFrame:
    """The result of ``preferences`` from rows that have both sides' turns, chosen_turns and rejected_turns."""
    a, b = F.col("chosen_turns"), F.col("rejected_turns")
    differs = F.filter(
        F.transform(a, lambda x, i: F.when((i < F.size(b)) & _same(x, F.get(b, i)), F.lit(None).cast("int")).otherwise(i)),
        lambda i: i.isNotNull(),
    )
    rows = sides.withColumn("n_shared", F.coalesce(F.get(differs, F.lit(0)), F.size(a)))
    tail = lambda x: F.slice(x, F.col("n_shared") + 1, F.greatest(F.size(x) - F.col("n_shared"), F.lit(0)))
    rows = rows.withColumns({"shared": F.slice(a, F.lit(1), F.col("n_shared")), "chosen_turns": tail(a), "rejected_turns": tail(b)})
    rows = rows.withColumns({"chosen_mask": mask(F.col("chosen_turns")), "rejected_mask": mask(F.col("rejected_turns"))})
    size = lambda m: F.aggregate(m, F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return rows.select(
        "pair_id",
        "chosen",
        "rejected",
        F.col("n_shared").cast("long").alias("n_shared"),
        rendered(F.col("shared")).alias("prompt"),
        rendered(F.col("chosen_turns")).alias("chosen_completion"),
        rendered(F.col("rejected_turns")).alias("rejected_completion"),
        "chosen_mask",
        "rejected_mask",
        size(F.col("chosen_mask")).alias("n_chosen_learned"),
        size(F.col("rejected_mask")).alias("n_rejected_learned"),
    )


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """Pairs of conversations 2n (chosen) and 2n + 1 (rejected), of those of which at least one exists."""
    numbers = turns.filter("conv_id is not null").select(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id")).distinct()
    return numbers.select("pair_id", (F.col("pair_id") * 2).alias("chosen"), (F.col("pair_id") * 2 + 1).alias("rejected"))


def answers(turns: DataFrame) -> DataFrame:
    """One row per assistant turn, as ``preferences`` gives: the turns before it shared, it chosen, another rejected.

    pair_id is conv_id and place (from 0) joined by a colon; chosen and rejected are the conversations that the
    turns are from. Rejected is the first of these assistant turns whose text differs: the one at the same place of
    conversation conv_id + 1, the others there, those later in the own conversation, the earlier ones; without any,
    rejected is null and its completion empty. Places count a conversation's turns in order, so a gap or a
    repeated turn number does not matter. Empty tables give no rows.
    """
    whole = conversations(turns)
    after = whole.select(F.expr("try_subtract(conv_id, 1)").alias("conv_id"), F.filter(F.transform("turns", lambda t, i: F.struct(i.alias("i"), t.alias("t"))), lambda x: x["t"]["role"] == LEARNED).alias("_next"))
    rows = whole.join(after, "conv_id", "left").withColumn("_own", F.filter(F.transform("turns", lambda t, i: F.struct(i.alias("i"), t.alias("t"))), lambda x: x["t"]["role"] == LEARNED))
    rows = rows.select("*", F.explode("_own").alias("_x"))
    at, turn = F.col("_x.i"), F.col("_x.t")
    following = F.coalesce("_next", F.array().cast(rows.schema["_own"].dataType))
    ordered = F.concat(F.filter(following, lambda x: x["i"] == at), F.filter(following, lambda x: x["i"] != at))
    own = F.concat(F.filter("_own", lambda x: x["i"] > at), F.filter("_own", lambda x: x["i"] < at))
    first = lambda found: F.get(F.filter(found, lambda x: ~_same(x["t"], turn)), F.lit(0))
    rows = rows.withColumns({"_there": first(ordered), "_here": first(own)})
    shared = F.slice("turns", F.lit(1), at)
    other = F.coalesce(F.col("_there.t"), F.col("_here.t"))
    return compared(
        rows.select(
            F.concat_ws(":", F.col("conv_id").cast("string"), at.cast("string")).alias("pair_id"),
            F.col("conv_id").alias("chosen"),
            F.when(F.col("_there").isNotNull(), F.col("conv_id") + 1).when(F.col("_here").isNotNull(), F.col("conv_id")).alias("rejected"),
            F.concat(shared, F.array(turn)).alias("chosen_turns"),
            F.when(other.isNotNull(), F.concat(shared, F.array(other))).otherwise(shared).alias("rejected_turns"),
        )
    )
