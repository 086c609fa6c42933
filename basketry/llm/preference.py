"""Preference formatting: one prompt and two masked completions for each pair.

Chosen and rejected conversations are compared turn by turn; the longest common prefix of equal
turns is rendered once as the prompt, the rest of each as a completion. Masks are the half-open
ranges of code points of a completion that are trained on: the text and end mark of each assistant
turn. A conversation is one string of the result, so its turns meet in one row; nothing larger is
gathered, and pairs are joined by id.

Defined cases: turns are ordered by ``turn``, then role, then text, nulls first; null role renders as
``unknown`` and null text as empty; equal turns are those with equal role and text, null equal to
null; a pair with equal conversations has empty completions; a conversation missing on one side
counts as one without turns; rows without id are left out; repeated turns are turns; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.frames import stored

# The marks of the rendered format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def conversations(turns: DataFrame, key: str, name: str) -> DataFrame:
    """One row for each conversation, its turns in order."""
    rows = turns.filter(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return rows.select(key, F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias(name))


def head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("unknown")), F.lit("\n"))


def rendered(turn: Column) -> Column:
    return F.concat(head(turn), F.coalesce(turn["text"], F.lit("")), F.lit(f"{CLOSE}\n"))


def masks(turns: Column) -> Column:
    """Ranges of the assistant's words in the rendered turns."""

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.char_length(head(turn))
        end = begin + F.char_length(F.coalesce(turn["text"], F.lit(""))) + len(CLOSE)
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(turn["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))
    return F.aggregate(turns, zero, step)["spans"]


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pair_id, n_prompt, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    From ``pair_id`` and arrays of turns ``chosen_turns, rejected_turns``.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    rows = pairs.select("pair_id", *(F.coalesce(c, empty).alias(c) for c in ("chosen_turns", "rejected_turns")))
    least = F.least(F.size("chosen_turns"), F.size("rejected_turns"))
    places = F.when(least > 0, F.sequence(F.lit(0), least - 1)).otherwise(F.array().cast("array<int>"))
    differ = F.filter(places, lambda i: ~F.get("chosen_turns", i).eqNullSafe(F.get("rejected_turns", i)))
    rows = rows.withColumn("n_prompt", F.coalesce(F.get(differ, F.lit(0)), least))
    rest = {c: F.slice(F.col(f"{c}_turns"), F.col("n_prompt") + 1, F.greatest(F.size(f"{c}_turns"), F.lit(1))) for c in ("chosen", "rejected")}
    rows = rows.select("pair_id", "n_prompt", F.slice("chosen_turns", 1, F.col("n_prompt")).alias("prefix"), *(v.alias(k) for k, v in rest.items()))
    text = lambda c: F.array_join(F.transform(c, rendered), "")
    return rows.select(
        "pair_id", F.col("n_prompt").cast("long").alias("n_prompt"), text("prefix").alias("prompt"), text("chosen").alias("chosen"), text("rejected").alias("rejected"),
        masks(F.col("chosen")).alias("chosen_mask"), masks(F.col("rejected")).alias("rejected_mask"),
    )


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Pairs of conversations that end in a reply and whose id is one below that of another with one.

    Only for dense whole-number ids: conversations without such a neighbour give no pair.
    """
    own = conversations(turns, "conv_id", "chosen_turns").filter(F.element_at("chosen_turns", -1)["role"] == "assistant")
    last = F.max(F.struct("turn", "role", "text"))
    reply = turns.filter("conv_id IS NOT NULL AND role = 'assistant'").groupBy("conv_id").agg(last.alias("last"))
    reply = reply.select((F.col("conv_id") - 1).alias("r_id"), F.struct("last.role", "last.text").alias("reply"))
    before = F.slice("chosen_turns", 1, F.size("chosen_turns") - 1)
    joined = own.join(reply, own["conv_id"] == reply["r_id"])
    return joined.select(F.col("conv_id").alias("pair_id"), "chosen_turns", F.concat(before, F.array("reply")).alias("rejected_turns"))


def ranked_replies(turns: DataFrame) -> DataFrame:
    """``conv_id, place, reply``: the last reply of each conversation that has one, ranked by id from 0.

    The ids are sorted over all tasks. A row's place is its number within its task and the rows of
    the tasks before it; only one count for each task is gathered.
    """
    last = F.max(F.struct("turn", "role", "text"))
    replies = turns.filter("conv_id IS NOT NULL AND role = 'assistant'").groupBy("conv_id").agg(last.alias("last"))
    # The number of a sorted row: its task in the upper 31 bits, its place there in the lower 33.
    rows = stored(replies.select("conv_id", F.struct("last.role", "last.text").alias("reply")).orderBy("conv_id").withColumn("row", F.monotonically_increasing_id()), "replies")
    task = F.shiftright("row", 33)
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = rows.groupBy(task.alias("task")).agg(F.count("*").alias("n")).select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.withColumn("task", task).join(F.broadcast(tasks), "task").select("conv_id", (F.col("before") + F.col("row").bitwiseAND((1 << 33) - 1)).alias("place"), "reply")


def following_replies(turns: DataFrame) -> DataFrame:
    """Pairs from plain conversations: a conversation and the same one with another's last reply.

    Every conversation with an assistant turn is chosen, up to the last such turn. Its rejected twin
    ends instead in the last reply of the conversation that follows among these by id, the first one
    after the greatest id. Where no other conversation has a reply, the rejected side is empty.
    """
    ranked = ranked_replies(turns)
    many = ranked.count()
    given = ranked.select(F.pmod(F.col("place") - 1, F.lit(max(many, 1))).alias("place"), F.col("reply").alias("other"))
    others = ranked.select("conv_id", "place").join(given, "place").select("conv_id", "other")
    # Roles are never null in the search: the last assistant turn counted from the end.
    back = F.array_position(F.reverse(F.transform("turns", lambda x: F.coalesce(x["role"] == "assistant", F.lit(False)))), F.lit(True))
    own = conversations(turns, "conv_id", "turns").withColumn("n", (F.size("turns") - back + 1).cast("int")).join(others, "conv_id")
    twin = F.concat(F.slice("turns", 1, F.col("n") - 1), F.array("other"))
    return own.select(F.col("conv_id").alias("pair_id"), F.slice("turns", 1, F.col("n")).alias("chosen_turns"), F.when(F.lit(many > 1), twin).alias("rejected_turns"))


def report(turns: DataFrame, pairs: Callable[[DataFrame], DataFrame] = swapped_replies) -> DataFrame:
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["begin"].cast("string"), s["end"].cast("string"))), ",")
    return format_pairs(pairs(turns)).select(
        F.col("pair_id").alias("conv_id"), "n_prompt", "prompt", "chosen", "rejected", spans("chosen_mask").alias("chosen_mask"), spans("rejected_mask").alias("rejected_mask")
    )
