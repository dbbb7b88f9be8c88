"""Multi-party perspective rotation of dialogues.

Every participant of a conversation is the assistant once: the dialogue is rendered with
that speaker's turns as the assistant's, everybody else's as those of a named user, and
only the assistant's words are marked for training.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
NARRATOR = "system"
UNNAMED = "unknown"


def _escaped(text: Column) -> Column:
    """Texts cannot forge a turn: the bar of a marker in them is doubled."""
    for mark in (OPEN, CLOSE):
        text = F.replace(text, F.lit(mark), F.lit(mark.replace("|", "||")))
    return text


def rotate(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    turns_per_chunk: int = 10_000,
) -> DataFrame:
    """One row per conversation, perspective and turn: the rendered segment, its place
    in the rendered dialogue and the part of it to train on.

    Columns: ``conversation``, perspective, position (from 0), ``turn``, speaker,
    rendered_as, segment, start, end, train_start, train_end. Places are code points in
    the dialogue, end exclusive; train_start = train_end where nothing is trained. The
    trained part is the assistant's text and the mark that closes it.

    Turns of ``system`` are shown as such from every perspective and have none of their
    own; a conversation of system turns alone gives no rows. A null speaker is one named
    ``unknown``; a null text is an empty one. Turns are in order of turn, then speaker,
    then text, null turns first; repeated rows stay repeated. A null conversation id is
    a conversation of its own. Empty tables give empty tables; other columns are not read.

    A conversation of any length is numbered in chunks of its turns, so no task holds
    all of it.
    """
    name = F.coalesce(F.col(speaker), F.lit(UNNAMED))
    rows = turns.select(
        F.col(conversation).alias("c"),
        F.col(turn).cast("long").alias("t"),
        name.alias("who"),
        F.coalesce(F.col(text), F.lit("")).alias("said"),
    ).withColumn("chunk", F.floor(F.coalesce("t", F.lit(0)) / turns_per_chunk).cast("long"))

    # The length of a segment depends on the perspective only through its header.
    header = F.concat(F.lit(OPEN), F.col("who"), F.lit("\n"))
    named = F.concat(F.lit(f"{OPEN}user name="), _escaped(F.col("who")), F.lit("\n"))
    own = F.lit(f"{OPEN}assistant\n")
    tail = F.lit(f"{CLOSE}\n")

    people = rows.where(F.col("who") != NARRATOR).select("c", F.col("who").alias("perspective")).distinct()
    rotated = rows.join(people, rows["c"].eqNullSafe(people["c"]), "inner").drop(people["c"])
    mine = F.col("who") == F.col("perspective")
    told = F.when(F.col("who") == NARRATOR, header).when(mine, own).otherwise(named)
    body = _escaped(F.col("said"))
    rotated = rotated.select(
        "c",
        "perspective",
        "chunk",
        "t",
        "who",
        "said",
        F.when(F.col("who") == NARRATOR, "system").when(mine, "assistant").otherwise("user").alias("rendered_as"),
        F.concat(told, body, tail).alias("segment"),
        F.length(told).alias("head"),
        mine.alias("mine"),
    )
    keys = ["c", "perspective", "chunk"]
    inside = Window.partitionBy(*keys).orderBy("t", "who", "said")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("c", "perspective").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    totals = (
        rotated.groupBy(*keys)
        .agg(F.count("*").alias("n"), F.sum(F.length("segment")).alias("chars"))
        .select(
            *keys,
            F.coalesce(F.sum("n").over(before), zero).alias("n0"),
            F.coalesce(F.sum("chars").over(before), zero).alias("chars0"),
        )
    )
    placed = rotated.withColumn("nth", F.row_number().over(inside) - 1).withColumn(
        "chars", F.coalesce(F.sum(F.length("segment")).over(earlier), zero)
    )
    same = (
        placed["c"].eqNullSafe(totals["c"])
        & (placed["perspective"] == totals["perspective"])
        & (placed["chunk"] == totals["chunk"])
    )
    start = F.col("chars0") + F.col("chars")
    end = start + F.length("segment")
    return placed.join(totals, same).select(
        placed["c"].alias(conversation),
        placed["perspective"],
        (F.col("n0") + F.col("nth")).cast("long").alias("position"),
        F.col("t").alias("turn"),
        F.col("who").alias("speaker"),
        "rendered_as",
        "segment",
        start.alias("start"),
        end.alias("end"),
        F.when(F.col("mine"), start + F.col("head")).otherwise(end).alias("train_start"),
        F.when(F.col("mine"), end - 1).otherwise(end).alias("train_end"),
    )


def assemble(segments: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One training example per conversation and perspective: the whole dialogue and
    the spans to train on. A row holds a dialogue, so this is for conversations that
    fit a task; ``rotate`` has no such bound."""
    part = F.struct("position", "segment", "train_start", "train_end")
    return (
        segments.groupBy(conversation, "perspective")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .select(
            conversation,
            "perspective",
            F.concat_ws("", F.transform("parts", lambda p: p["segment"])).alias("text"),
            F.transform(
                F.filter("parts", lambda p: p["train_end"] > p["train_start"]),
                lambda p: F.struct(p["train_start"].alias("start"), p["train_end"].alias("end")),
            ).alias("mask"),
        )
    )
