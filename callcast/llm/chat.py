"""Multi-party chat formatting: every dialogue seen from every participant.

For each participant of a dialogue the turns are rendered with that speaker as
``assistant`` and all others as named users; the training mask covers what the
assistant says and its end mark.  Roles in ``narrators`` (such as ``system``)
speak for nobody: they keep their own header and no perspective.

A dialogue is rendered in parts of ``part_turns`` turn numbers, normally one, and
the parts of a perspective, in order, give its whole text.  A part that holds
more than ``PART_ROWS`` different utterances is rendered in pieces, by turn and
then by the order of ties, so a dialogue that holds a large share of all rows is
spread over many tasks; ``joined`` then puts the pieces together, so the result
does not depend on the number of rows.  Only with ``part_rows`` given are the
pieces themselves returned.  Only DataFrame functions are used.

Defined results: turns are in ascending order (a null turn first, in a part of
its own); ties are
ordered by a hash of role and text; rows that repeat (dialogue, turn, role and
text) are one utterance; a null text is empty, a null role is the participant
``unknown``, a null dialogue id is a dialogue of its own; a dialogue of narrators
only has no perspective; the start and end marks inside a text are broken by a
blank so that they cannot be taken for marks; an empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART_TURNS = 256
PART_ROWS = 4096


def header(speaker: Column, role: Column, narrators: list[str]) -> Column:
    """The line that opens a turn of ``role`` in the perspective of ``speaker``."""
    return F.concat(F.lit(START), F.when(role == speaker, F.lit("assistant")).when(role.isin(narrators), role).otherwise(F.concat(F.lit("user name="), role)), F.lit("\n"))


def said(text: Column) -> Column:
    """What stands between header and next turn, end mark included."""
    safe = F.replace(F.replace(text, F.lit(START), F.lit("<|im_start |>")), F.lit(END), F.lit("<|im_end |>"))
    return F.concat(safe, F.lit(END + "\n"))


def utterances(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("unknown")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    return rows.withColumn("tie", F.shiftrightunsigned(F.xxhash64("role", "text"), 1))


def parts(rows: DataFrame, part_turns: int, part_rows: int) -> DataFrame:
    """Each row with its part, an array of numbers in the order of the dialogue."""
    block = F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / part_turns)
    rows = rows.withColumn("block", block)
    large = rows.groupBy("conv_id", "block").agg(F.count_distinct(F.struct("turn", "tie")).alias("n")).where(F.col("n") > part_rows).select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "n")
    joined = rows.join(large, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")), "left").drop("_c", "_b")
    finer = F.shiftrightunsigned(F.col("tie"), 63 - 10)  # 1024 slices of a turn, in the order of ties
    none = F.lit(-1).cast("long")
    return joined.withColumn("part", F.when(F.col("n").isNull(), F.array("block", none, none)).otherwise(F.array(F.col("block"), F.coalesce("turn", none), finer))).drop("n", "block")


def perspectives(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    narrators: list[str] = ("system",), part_turns: int = PART_TURNS, part_rows: int | None = None,
) -> DataFrame:
    """conv_id, speaker, part, n_turns, n_spoken, text, mask (array of start, end in characters of ``text``).

    ``part`` holds the block of turns and, with ``part_rows``, the turn and the slice of its ties where a block is divided (else -1, -1).
    """
    rows = utterances(turns, conv_id, turn, role, text)
    who = rows.where(~F.col("role").isin(list(narrators))).select(F.col("conv_id").alias("_c"), F.col("role").alias("speaker")).distinct()
    one = F.struct("turn", "tie", "role", "text")
    dialogues = parts(rows, part_turns, PART_ROWS if part_rows is None else part_rows).groupBy("conv_id", "part").agg(F.array_sort(F.collect_set(one)).alias("turns"))
    seen = dialogues.join(who, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    speaker = F.col("speaker")
    pieces = F.transform("turns", lambda u: F.struct(header(speaker, u["role"], list(narrators)).alias("head"), said(u["text"]).alias("body"), (u["role"] == speaker).alias("own")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))
    walked = F.aggregate(
        "pieces", start,
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
            F.when(p["own"], F.concat(acc["mask"], F.array(F.struct((acc["at"] + F.length(p["head"])).alias("start"), (acc["at"] + F.length(p["head"]) + F.length(p["body"]) - 1).alias("end"))))).otherwise(acc["mask"]).alias("mask"),
        ),
    )
    shown = seen.withColumn("pieces", pieces)
    pieces = shown.select(
        "conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_spoken"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"), walked["mask"].alias("mask"),
    )
    return joined(pieces) if part_rows is None else pieces


def joined(pieces: DataFrame) -> DataFrame:
    """The pieces of each block of turns as one row, with the masks moved to where each piece starts."""
    keys, none = ["conv_id", "speaker", "block"], F.lit(-1).cast("long")
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)).cast("int")
    moved = F.transform("mask", lambda m: F.struct((m["start"] + F.col("at")).alias("start"), (m["end"] + F.col("at")).alias("end")))
    placed = pieces.withColumn("block", F.col("part")[0]).withColumn("at", at).select(*keys, F.struct("part", "n_turns", "n_spoken", "text", moved.alias("mask")).alias("x"))
    whole = placed.groupBy(*keys).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    total = lambda c: F.aggregate(F.col("xs")[c], F.lit(0).cast("long"), lambda a, v: a + v).alias(c)
    return whole.select("conv_id", "speaker", F.array("block", none, none).alias("part"), total("n_turns"), total("n_spoken"), F.array_join(F.col("xs")["text"], "").alias("text"), F.flatten(F.col("xs")["mask"]).alias("mask"))
