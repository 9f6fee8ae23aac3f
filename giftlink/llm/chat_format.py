"""Chat formatting: multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as named users, together with the
loss mask that selects what the assistant says (text and end tag).

Everything is DataFrame functions. A conversation is rendered in parts of a
bounded number of turns: they are cut at multiples of ``turns_per_part`` in
the turn number, and turns that repeat a number beyond that are cut again by
their order. So a conversation with a third of all rows does not meet in one
task as a whole if its turns are numbered; to be put in order, the rows of one
range of turn numbers do meet in one, and so do all null turns of a
conversation (nothing is lost, the sort spills). The parts of a perspective, in order
(``part``, ``subpart``), concatenate to the whole rendering; spans count
characters from the start of their part.

Defined results: a null role is the participant ``unknown``; ``system`` turns
are context, rendered as system in every view, and no participant; a
conversation with system turns only gives no row; a null text is empty; a
null conversation id is a conversation of its own; null turns come first;
ties in turn are ordered by role and text (nulls first) and repeated rows are
kept; ``<|`` in texts or names is written ``< |`` so that content cannot pose
as a tag; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURNS_PER_PART = 64


def _clean(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate(conversations: DataFrame, turns_per_part: int = TURNS_PER_PART, context_role: str = "system") -> DataFrame:
    """One row per conversation, participant and part: conv_id, perspective,
    part, subpart, n_turns, rendered, loss_spans (``start:end`` in characters,
    joined by commas), n_chars, n_loss_chars."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), "text",
        F.floor(F.col("turn") / turns_per_part).cast("long").alias("part"))
    order = W.partitionBy("conv_id", "part").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    numbered = turns.withColumn("rn", F.row_number().over(order))
    parts = (numbered
             .withColumn("subpart", F.floor((F.col("rn") - 1) / turns_per_part).cast("long"))
             .groupBy("conv_id", "part", "subpart")
             .agg(F.array_sort(F.collect_list(F.struct("rn", "role", _clean(F.col("text")).alias("text"))))
                  .alias("turns")))
    people = (turns.where(F.col("role") != context_role)
              .select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct())
    views = parts.join(people, F.col("conv_id").eqNullSafe(F.col("of")))

    def head(t):
        return F.when(t["role"] == context_role, F.lit("<|im_start|>system\n")) \
            .when(t["role"] == F.col("perspective"), F.lit("<|im_start|>assistant\n")) \
            .otherwise(F.concat(F.lit("<|im_start|>user name="), _clean(t["role"]), F.lit("\n")))

    pieces = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), F.concat(t["text"], F.lit("<|im_end|>\n")).alias("body"),
        (t["role"] == F.col("perspective")).alias("own")))
    views = views.withColumn("pieces", pieces)

    def step(acc, p):
        start = acc["pos"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.concat(start.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(end.alias("pos"),
                        F.when(p["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
                        F.when(p["own"], acc["own"] + F.length(p["body"])).otherwise(acc["own"]).alias("own"))

    zero = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("spans"), F.lit(0).alias("own"))
    views = views.withColumn("mask", F.aggregate("pieces", zero, step))
    return views.select(
        "conv_id", "perspective", "part", "subpart", F.size("turns").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("rendered"),
        F.array_join("mask.spans", ",").alias("loss_spans"),
        F.col("mask.pos").alias("n_chars"), F.col("mask.own").alias("n_loss_chars"))
