"""Multi-party dialogues, rendered once for every participant.

For each speaker of a conversation the whole dialogue is rendered with that
speaker as ``assistant``, all others as named users, and ``system`` turns as
they are.  The mask holds the places (code points, end exclusive) that are
trained on: the speaker's own texts with their end marks.

A rendering is cut into parts of ``PART`` turn numbers, each with offsets of
its own, so a conversation that holds a third of all rows becomes many bounded
rows; an ordinary one is a single part.  Only turns of a part meet in a task.

Edge cases: a null role speaks as ``unknown``, a null text is empty, a null
turn comes first, in part 0; rows with a null ``conv_id`` are one conversation;
ties are ordered by role and text, and repeated rows stay; a conversation of
system turns alone has no participant and no row; control marks inside texts
are broken by a space; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import running_sum

PART = 256
SYSTEM = "system"
#: The format's fixed marks.
START, END = "<|im_start|>", "<|im_end|>"


def _head(role: Column, speaker: Column) -> Column:
    own = F.lit(f"{START}assistant\n")
    system = F.lit(f"{START}{SYSTEM}\n")
    named = F.concat(F.lit(f"{START}user name="), role, F.lit("\n"))
    return F.when(role == speaker, own).when(role == SYSTEM, system).otherwise(named)


def rotate(conversations: DataFrame) -> DataFrame:
    """Per conversation, speaker and part: n_turns, n_own, text, mask."""
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|im_"), F.lit("<| im_")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / PART), F.lit(0)).cast("long").alias("part"),
    )
    speakers = turns.filter(F.col("role") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    parts = turns.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "text"))).alias("turns"))
    views = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))
    speaker = F.col("speaker")
    pieces = F.transform(
        "turns", lambda t: F.struct(_head(t["role"], speaker).alias("head"), t["text"].alias("text"), (t["role"] == speaker).alias("own"))
    )

    size = lambda p: F.length(p["head"]) + F.length(p["text"]) + len(END) + 1

    def spans(bound: Column) -> Column:
        placed = F.arrays_zip(bound.alias("p"), running_sum(F.transform(bound, size)).alias("at"))
        own = F.filter(placed, lambda z: z["p"]["own"])
        return F.transform(own, lambda z: F.concat_ws(":", z["at"] + F.length(z["p"]["head"]), z["at"] + size(z["p"]) - 1))

    rendered = views.select("conv_id", "speaker", "part", pieces.alias("pieces"))
    return rendered.select(
        "conv_id",
        "speaker",
        "part",
        F.size("pieces").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], F.lit(END + "\n"))), "").alias("text"),
        F.array_join(spans(F.col("pieces")), ",").alias("mask"),
    )
