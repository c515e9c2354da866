"""Chat formatting with multi-party perspective rotation.

Every participant of a conversation gets a rendering of the whole dialogue in which their own
turns are the assistant's (and carry the loss mask) and all other turns come from named users.
Context roles (``system``) appear as context in every rendering and are no participants.

A dialogue is rendered in parts of ``PART_TURNS`` consecutive turn numbers: one row per
(conversation, participant, part), whose texts joined in order are the whole rendering. So the
rows that meet in a task are bounded by a part, not by the longest conversation, and the offsets
of the masks count from the start of the part. Everything is built-in expressions.

Edge cases: exact repeats of a turn count once; turns with equal numbers are ordered by role and
text; a NULL turn number sorts first, a NULL text is empty, a NULL role is the participant
``unknown``; rows without a conversation id form one conversation (NULL); conversations without a
participant give no row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 256
CONTEXT_ROLES = ("system",)
OPEN = "<|im_start|>"
CLOSE = "<|im_end|>\n"
UNKNOWN = "unknown"


def turns(conversations: DataFrame) -> DataFrame:
    """Distinct turns with their part; NULLs get their defined value."""
    return (
        conversations.select(
            "conv_id",
            F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
            F.coalesce("role", F.lit(UNKNOWN)).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .distinct()
        .withColumn("part", F.floor(F.col("turn") / PART_TURNS).cast("long"))
    )


def parts(spoken: DataFrame) -> DataFrame:
    """The turns of each part in order, as one array."""
    return spoken.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )


def participants(spoken: DataFrame) -> DataFrame:
    return (
        spoken.filter(~F.col("role").isin(*CONTEXT_ROLES))
        .select("conv_id", F.col("role").alias("speaker"))
        .distinct()
    )


def _header(turn: Column, speaker: Column) -> Column:
    name = (
        F.when(turn["role"].isin(*CONTEXT_ROLES), turn["role"])
        .when(turn["role"] == speaker, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), turn["role"]))
    )
    return F.concat(F.lit(OPEN), name, F.lit("\n"))


def render(conversations: DataFrame) -> DataFrame:
    """One row per conversation, speaker and part.

    ``text`` is the rendering; ``spans`` are the (start, end) character ranges that are learned, which
    are the speaker's own texts with their closing mark; ``n_turns`` counts the turns shown.
    """
    spoken = turns(conversations)
    voices = participants(spoken).withColumnRenamed("conv_id", "of_conv")
    held = parts(spoken)
    seen = held.join(voices, held["conv_id"].eqNullSafe(voices["of_conv"]))
    speaker = F.col("speaker")
    segments = F.transform(
        "turns",
        lambda turn: F.struct(
            _header(turn, speaker).alias("header"),
            F.concat(turn["text"], F.lit(CLOSE)).alias("body"),
            (turn["role"] == speaker).alias("own"),
        ),
    )
    cut = seen.select("conv_id", "speaker", "part", segments.alias("segments"))
    empty = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
    )

    def advance(state: Column, segment: Column) -> Column:
        start = state["at"] + F.length(segment["header"])
        end = start + F.length(segment["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(segment["own"], F.concat(state["spans"], span))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    return cut.select(
        "conv_id",
        "speaker",
        "part",
        F.size("segments").cast("long").alias("n_turns"),
        F.array_join(
            F.transform("segments", lambda one: F.concat(one["header"], one["body"])), ""
        ).alias("text"),
        F.aggregate("segments", empty, advance, lambda state: state["spans"]).alias("spans"),
    )
