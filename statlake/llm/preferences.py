"""Preference pairs of conversations as one prompt and two masked completions, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import size_in_words

#: A turn is rendered as its head, its text and its end.
HEAD_OPEN, HEAD_CLOSE, END = "<|", "|>\n", "<|end|>\n"
#: The role whose texts and ends are learnt; all else in a completion is masked.
LEARNT = "assistant"


def pair_neighbours(conversations: DataFrame) -> DataFrame:
    """Pair conversations 2n and 2n + 1: pair_id, conv_id, chosen, turn, role, text of their turns.

    The one with more assistant words is chosen, of equal ones the smaller conv_id. Turns without a
    conv_id belong to no conversation and are left out.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id is not null")
    turns = turns.withColumn("pair_id", F.shiftright("conv_id", 1))
    words = F.when(F.col("role") == LEARNT, size_in_words(F.col("text"))).otherwise(F.lit(0))
    scores = turns.groupBy("pair_id", "conv_id").agg(F.sum(words).alias("words"))
    best = scores.groupBy("pair_id").agg(F.max(F.struct("words", (-F.col("conv_id")).alias("first"))).alias("best"))
    best = best.select("pair_id", (-F.col("best.first")).alias("best"))
    return turns.join(best, "pair_id").withColumn("chosen", F.col("conv_id") == F.col("best")).drop("best")


def _segments(turns: Column) -> Column:
    """Of each turn the head, masked, and the text with its end, learnt if the role is LEARNT."""
    return F.flatten(
        F.transform(
            turns,
            lambda t: F.array(
                F.struct(F.concat(F.lit(HEAD_OPEN), t["role"], F.lit(HEAD_CLOSE)).alias("text"), F.lit(False).alias("learnt")),
                F.struct(F.concat(t["text"], F.lit(END)).alias("text"), (t["role"] == LEARNT).alias("learnt")),
            ),
        )
    )


def _rendered(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def mask(segments: Column) -> Column:
    """Segment lengths in code points, each followed by + if it is learnt and - if not."""
    sign = lambda s: F.when(s["learnt"], F.lit("+")).otherwise(F.lit("-"))
    return F.array_join(F.transform(segments, lambda s: F.concat(F.char_length(s["text"]).cast("string"), sign(s))), " ")


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row for each pair of turns (pair_id, conv_id, chosen, turn, role, text).

    Returns pair_id, chosen_id, rejected_id, n_common (turns in the longest common prefix, by role and
    text), prompt (that prefix, rendered once), chosen and rejected (the rendered rest of each) and
    chosen_segments and rejected_segments, the same as lists of (text, learnt): only the learnt role's
    texts and ends are learnt.

    Turns are ordered by turn (null first), then role and text, so ties and repeated rows have a fixed
    place; null roles and texts are empty. Equal conversations have the whole as prompt and two empty
    completions; a pair with one side has a null id, an empty prompt and an empty completion for the
    other. Other columns are ignored. A pair is one output row, so its turns meet in one task; no
    other grouping is made.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    side = lambda keep: F.sort_array(F.collect_list(F.when(keep, turn)))
    pairs = turns.groupBy("pair_id").agg(
        F.min(F.when(F.col("chosen"), F.col("conv_id"))).alias("chosen_id"),
        F.min(F.when(~F.col("chosen"), F.col("conv_id"))).alias("rejected_id"),
        side(F.col("chosen")).alias("_c"),
        side(~F.col("chosen")).alias("_r"),
    )
    shorter = F.least(F.size("_c"), F.size("_r"))
    same = F.zip_with(
        F.slice("_c", F.lit(1), shorter),
        F.slice("_r", F.lit(1), shorter),
        lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]),
    )
    pairs = pairs.withColumn("_split", F.array_position(same, False))
    pairs = pairs.withColumn("n_common", F.when(F.col("_split") == 0, shorter).otherwise(F.col("_split") - 1).cast("int"))
    rest = lambda c: _segments(F.slice(c, F.col("n_common") + 1, F.size(c)))
    pairs = pairs.withColumns(
        {
            "prompt": _rendered(_segments(F.slice("_c", F.lit(1), F.col("n_common")))),
            "chosen_segments": rest("_c"),
            "rejected_segments": rest("_r"),
        }
    )
    return pairs.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        "n_common",
        "prompt",
        _rendered(F.col("chosen_segments")).alias("chosen"),
        _rendered(F.col("rejected_segments")).alias("rejected"),
        "chosen_segments",
        "rejected_segments",
    )
