"""Preference records from pairs of conversations: the shared turns once as prompt, and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwise.session import materialise


def conversations_by_id(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) with each conversation's turns (role, text) in order.

    Rows that repeat a turn exactly count once; turns of one number are ordered by role and text, a null before others.
    Rows without conv_id belong to no conversation. A conversation is one record, so its own length bounds the list.
    """
    rows = turns.where("conv_id is not null").select("conv_id", F.struct("turn", "role", "text").alias("t")).distinct()
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def pairs_by_opening(listed: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id): each conversation against the one with the smallest id among those with the same first turn."""
    opening = listed.select("conv_id", F.element_at("turns", 1).alias("first"))
    opening = opening.select("conv_id", F.sha2(F.to_json("first", {"ignoreNullFields": "false"}), 256).alias("first"))
    least = opening.groupBy("first").agg(F.min("conv_id").alias("chosen_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = opening.join(least, "first").where("conv_id <> chosen_id")
    return pairs.select("chosen_id", F.col("conv_id").alias("rejected_id"))


def pairs_by_number(listed: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id): conversation 2k against 2k + 1."""
    even, odd = (listed.where(F.pmod("conv_id", F.lit(2)) == i).select("conv_id") for i in (0, 1))
    odd = odd.select(F.col("conv_id").alias("rejected_id"), (F.col("conv_id") - 1).alias("conv_id"))
    return even.join(odd, "conv_id").select(F.col("conv_id").alias("chosen_id"), "rejected_id")


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), F.coalesce(turn["role"], F.lit("")), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit("<|im_end|>\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _mask(turns: Column) -> Column:
    """Runs of characters of the rendered turns: their number, and 1 where they are trained on (what an assistant says)."""
    trained = lambda t: F.when(t["role"] == "assistant", 1).otherwise(0)
    runs = F.transform(
        turns,
        lambda t: F.array(
            F.struct(F.length(_head(t)).alias("n"), F.lit(0).alias("trained")), F.struct(F.length(_body(t)).alias("n"), trained(t).alias("trained"))
        ),
    )
    return F.flatten(runs)


def preference_records(listed: DataFrame, pairs: DataFrame) -> DataFrame:
    """chosen_id, rejected_id, prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask per pair.

    Args:
        listed: as from ``conversations_by_id``.
        pairs: (chosen_id, rejected_id); pairs with an unknown id give no record, repeated pairs one each.

    The prompt is the longest common prefix of turns with equal role and text (nulls are equal), rendered once. What follows in
    each conversation is a completion, which may be empty. A null role or text is rendered as an empty one. Masks list runs
    of characters in the completion with 1 for what is trained on.
    """
    chosen = listed.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("a"))
    rejected = listed.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("b"))
    both = pairs.select("chosen_id", "rejected_id").join(rejected, "rejected_id").join(chosen, "chosen_id")
    shorter = F.least(F.size("a"), F.size("b"))
    differs = F.zip_with("a", "b", lambda x, y: ~x.eqNullSafe(y))
    place = F.array_position(differs, True)
    common = F.when(place == 0, shorter).otherwise(place.cast("int") - 1)
    both = both.withColumn("prompt_turns", common.cast("int"))
    rest = lambda c: F.slice(c, F.col("prompt_turns") + 1, F.greatest(F.size(c), F.lit(1)))
    return both.select(
        "chosen_id",
        "rejected_id",
        "prompt_turns",
        _render(F.slice("a", F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        _render(rest("a")).alias("chosen"),
        _render(rest("b")).alias("rejected"),
        _mask(rest("a")).alias("chosen_mask"),
        _mask(rest("b")).alias("rejected_mask"),
    )


def format_preferences(turns: DataFrame) -> DataFrame:
    """Records of conversations with the same first turn and of those with numbers 2k and 2k + 1, each pair once.

    ``turns``: conv_id, turn, role, text; other columns are ignored. An empty table gives no records.
    """
    listed = materialise(conversations_by_id(turns), "conversations")
    return preference_records(listed, pairs_by_opening(listed).unionByName(pairs_by_number(listed)).distinct())
