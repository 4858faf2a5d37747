"""Conversations as training examples, one for each assistant turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "<turn>", "</turn>"


def escaped(text: Column) -> Column:
    """``text`` without ``<``, so that it can hold no control string; reversible."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\n"), F.lit("\n")))


def expand_replies(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_length): the examples of ``conversations``
    (conv_id, turn, role, text).

    A turn is written ``<turn>role``, a line end, its text and ``</turn>``. Every turn of the role
    ``assistant`` gives an example: all turns before it, and itself with its text under the loss
    mask (from the 0-based code point ``loss_start``). What follows the last reply is kept by an
    example with nothing to train on (``loss_length`` 0) that holds the whole conversation.

    Turns are ordered by turn, role and text, nulls first; repeated rows are turns of their own.
    Null roles and texts are empty. Null conv_ids are one conversation. Other columns are ignored.

    A conversation is one row while it is expanded, and the examples of n turns hold about n * n / 2
    turns: this is what the expansion means. Examples are made one after another, not held together.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select(
        "conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("turn")
    )
    whole = (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select(
            "conv_id",
            F.transform(
                "turns",
                lambda x: F.struct(
                    (x["role"] == "assistant").alias("reply"),
                    F.concat(F.lit(OPEN), _escaped_role(x["role"]), F.lit("\n")).alias("header"),
                    escaped(x["text"]).alias("body"),
                ),
            ).alias("turns"),
        )
        .withColumn("parts", F.transform("turns", lambda x: F.concat(x["header"], x["body"], F.lit(CLOSE))))
    )
    last = F.size("turns") - 1
    return (
        whole.select("conv_id", "parts", last.alias("last"), F.posexplode("turns").alias("example", "turn"))
        .where(F.col("turn.reply") | (F.col("example") == F.col("last")))
        .withColumn("context", F.array_join(F.slice("parts", F.lit(1), F.col("example")), ""))
        .select(
            "conv_id",
            "example",
            F.concat("context", F.element_at("parts", F.col("example") + 1)).alias("text"),
            (F.length("context") + F.length("turn.header")).alias("loss_start"),
            F.when(F.col("turn.reply"), F.length("turn.body")).otherwise(F.lit(0)).alias("loss_length"),
        )
    )


def read_back(examples: DataFrame) -> DataFrame:
    """(conv_id, turns, trained, formatted_chars): what the texts of examples say.

    ``turns``: (role, text) of the longest example; ``trained``: the texts under the loss masks.
    """
    masked = F.when(
        F.col("loss_length") > 0, F.expr("substring(text, loss_start + 1, loss_length)")
    ).otherwise(F.lit(""))
    parts = F.slice(F.split("text", CLOSE), F.lit(1), F.size(F.split("text", CLOSE)) - 1)
    return (
        examples.select("conv_id", "example", "text", masked.alias("masked"))
        .groupBy("conv_id")
        .agg(
            F.max_by("text", "example").alias("text"),
            F.sort_array(F.collect_list(F.struct("example", "masked"))).alias("masked"),
            F.sum(F.length("text")).alias("formatted_chars"),
        )
        .select(
            "conv_id",
            F.transform(
                parts,
                lambda x: F.struct(
                    _unescaped_role(F.substring_index(F.replace(x, F.lit(OPEN), F.lit("")), "\n", 1)).alias("role"),
                    unescaped(F.substr(x, F.locate("\n", x) + 1)).alias("text"),
                ),
            ).alias("turns"),
            F.transform("masked.masked", unescaped).alias("trained"),
            "formatted_chars",
        )
    )
