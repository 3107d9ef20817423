"""Preference formatting: one prompt for the turns that two conversations share, and two masked completions.

Everything is column expressions: a conversation is one row with its ordered turns, the longest
common prefix is the position of the first differing turn, and mask offsets are running sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.sources.shared import stored

#: Role whose turns are learned from.
LEARNED = "assistant"

_MASK = "array<struct<start:int,end:int>>"


def whole(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order.

    Turns are ordered by number, then by role and text where a number repeats; a null number comes
    first. Repeated rows count once. Null roles and texts are empty. Rows without a conversation
    id belong to none. A conversation becomes one row, as its rendering does.
    """
    said = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).alias("conv_id"), said.alias("said"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_set("said")).alias("turns"))


def _rendered(turn: Column) -> Column:
    """A turn with its marks; mark signs inside its text are set apart, so that it can't pose as turns."""
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), F.replace(turn["text"], F.lit("<|"), F.lit("< |")), F.lit("\n<|end|>\n"))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column) -> Column:
    """Code point ranges of the completion that are learned from: text and end mark of learned turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_MASK).alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        end = (state["at"] + F.length(_rendered(turn))).cast("int")
        begin = (state["at"] + F.length(turn["role"]) + 5).cast("int")  # behind <|role|> and its line break
        span = F.array(F.struct(begin.alias("start"), end.alias("end"))).cast(_MASK)
        spans = F.when(turn["role"] == LEARNED, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def formatted(pairs: DataFrame, conversations: DataFrame, **columns: str) -> DataFrame:
    """(chosen_id, rejected_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask) for each pair.

    The prompt is the longest common prefix of both conversations, turns being equal in role and
    text, rendered once. A completion is the rest; it is empty where a conversation is a prefix of
    the other. Masks are the ranges of a completion to learn from. Pairs with an unknown or null
    conversation drop out; a repeated pair is formatted as often. A pair may have ``rejected_turns``, the
    number of first turns that its rejected side has, all where it is null. Other columns of the pairs and
    further columns of the conversations are ignored, whatever their names.
    """
    # Stored, so that a conversation in very many pairs is joined from plain exchanges, which adaptive execution can split.
    known = stored(whole(conversations, **columns))
    cut = F.col("rejected_turns") if "rejected_turns" in pairs.columns else F.lit(None)
    asked = stored(pairs.select("chosen_id", "rejected_id", cut.cast("int").alias("cut")))
    sides = [known.select(F.col("conv_id").alias(f"{side}_id"), F.col("turns").alias(f"{side}_turns")) for side in ("chosen", "rejected")]
    both = asked.join(sides[0], "chosen_id").join(sides[1], "rejected_id")
    both = both.withColumn("rejected_turns", F.slice("rejected_turns", F.lit(1), F.coalesce("cut", F.size("rejected_turns"))))
    shorter = F.least(F.size("chosen_turns"), F.size("rejected_turns"))

    def said(turn: Column) -> Column:
        return F.struct(turn["role"], turn["text"])

    same = F.zip_with(
        F.slice("chosen_turns", F.lit(1), shorter), F.slice("rejected_turns", F.lit(1), shorter), lambda a, b: said(a) == said(b)
    )
    differs = F.array_position(same, F.lit(False))
    split = both.withColumn("n_prompt_turns", F.when(differs > 0, differs - 1).otherwise(shorter).cast("int"))
    n = F.col("n_prompt_turns")
    for side in ("chosen", "rejected"):
        turns = F.col(f"{side}_turns")
        split = split.withColumn(f"{side}_rest", F.slice(turns, n + 1, F.size(turns)))
    return split.select(
        "chosen_id",
        "rejected_id",
        "n_prompt_turns",
        _joined(F.slice("chosen_turns", F.lit(1), n)).alias("prompt"),
        *[_joined(F.col(f"{side}_rest")).alias(side) for side in ("chosen", "rejected")],
        *[_mask(F.col(f"{side}_rest")).alias(f"{side}_mask") for side in ("chosen", "rejected")],
    )


def pairs_by_longest_prefix(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(chosen_id, rejected_id, rejected_turns): a pair for every conversation, at the deepest prefix it shares.

    Among the conversations that share the most first turns with it, it is rejected for the best, which has
    the most text of the learned role, the smaller id where that is equal; the best itself is chosen over the
    last in that order. One that shares no turn with any other is chosen over itself cut
    before its last learned turn, ``rejected_turns`` turns long, or uncut where it has none. Equal pairs are
    one. Rows are read as by ``whole``; further columns, whatever their names, are ignored. No conversations give
    no pairs.
    """
    known = whole(conversations, conv_id, turn, role, text)

    def longer(seen: Column, turn: Column) -> Column:
        last = F.coalesce(F.try_element_at(seen, F.lit(-1)), F.lit(""))
        return F.array_append(seen, F.sha2(F.concat(last, F.sha2(turn["role"], 256), F.sha2(turn["text"], 256)), 256))

    learned = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.when(t["role"] == LEARNED, F.length(t["text"])).otherwise(0))
    last = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda t: t["role"] == LEARNED)), F.lit(True)).cast("int")
    paths = stored(known.select(
        "conv_id", learned.alias("learned"), last.alias("cut"), F.aggregate("turns", F.array().cast("array<string>"), longer).alias("path")
    ))
    prefixes = paths.select("conv_id", "learned", F.posexplode("path").alias("depth", "prefix"))
    worth = F.struct("learned", -F.col("conv_id"))
    sharing = prefixes.groupBy("prefix").agg(
        F.count("*").alias("n"), F.max_by("conv_id", worth).alias("best"), F.min_by("conv_id", worth).alias("last")
    )
    # Stored, as a prefix that very many conversations share is a hot key of the join.
    shared = stored(sharing.where("n > 1").drop("n"))
    deepest = prefixes.join(shared, "prefix").groupBy("conv_id").agg(F.max(F.struct("depth", "best", "last")).alias("near"))
    met = stored(deepest.select("conv_id", "near.best", "near.last"))
    other = F.when(F.col("conv_id") == F.col("best"), F.col("last")).otherwise(F.col("conv_id"))
    together = met.select(F.col("best").alias("chosen_id"), other.alias("rejected_id")).distinct()
    alone = paths.join(met, "conv_id", "left_anti").select(F.col("conv_id").alias("chosen_id"), F.col("conv_id").alias("rejected_id"), F.col("cut").alias("rejected_turns"))
    return together.withColumn("rejected_turns", F.lit(None).cast("int")).unionByName(alone)
