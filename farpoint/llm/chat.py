"""Chat formatting by perspective rotation.

Every participant of a conversation gets the whole dialogue from their own
point of view: their turns stand as the assistant's, all others as named users,
and the loss mask covers exactly their own turns, each with its end mark.
System turns frame the dialogue; the system is no participant.

A long conversation is rendered in segments: by blocks of ``segment_turns`` turn
numbers and, where numbers repeat, at most ``segment_turns`` turns each. So one
endless conversation is many rows and no task holds it whole. Participants are
those of the whole conversation, also in segments where they are silent.

``dialogues`` (op2) cuts by position in the conversation, whatever its numbers;
``perspectives`` by turn number. By position, every segment but the last has ``segment_turns``
turns, later ones open with the system turns of the first again (the frame; no more than
``segment_turns``), and tell where they stand in the whole rendering.

Turns go by (turn, role, text), a null turn last; turns that tie or repeat are all
kept. A null role is the participant ``unknown``; a null text is empty. Turns with a
null conv_id are one conversation. Text cannot forge a mark: ``<|`` in a turn becomes
``<\\|`` (one backslash more for each that is there, so it can be undone), ``|`` in a role
``\\|``. A conversation of system turns only, like an
empty table, gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LAST_ID, per_batch

SEGMENT_TURNS = 256
OWN, OTHER, SYSTEM, END = "<|assistant|>\n", "<|user:{}|>\n", "<|system|>\n", "<|end|>\n"

RENDERED = ("conv_id long, block long, part long, perspective string, rendered string, "
            "mask string, n_turns long, n_own long")


def render(speaker: str, roles: list[str], texts: list[str]) -> tuple[str, list[tuple[int, int]]]:
    """The dialogue as ``speaker`` sees it, and the character spans of the loss mask."""
    out, spans, at = [], [], 0
    for role, text in zip(roles, texts, strict=True):
        own = role == speaker
        head = OWN if own else SYSTEM if role == "system" else OTHER.format(role)
        if own:
            spans.append((at + len(head), at + len(head) + len(text) + len(END)))
        out += [head, text, END]
        at += len(head) + len(text) + len(END)
    return "".join(out), spans


def said_turns(turns: DataFrame, segment_turns: int) -> DataFrame:
    """(conv_id, turn, role, text, block): block cuts the turn numbers."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce("turn", F.lit(LAST_ID)).alias("turn"),
        F.replace(F.coalesce("role", F.lit("unknown")), F.lit("|"), F.lit("\\|")).alias("role"),
        F.regexp_replace(F.coalesce("text", F.lit("")), r"<(\\*)\|", r"<$1\\|")
        .alias("text")).withColumn(
            "block", F.expr(f"turn div {segment_turns}"))


def speakers_of(said: DataFrame) -> DataFrame:
    return (said.filter("role != 'system'").select("conv_id", "role").distinct()
            .select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")))


def perspectives(turns: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """One row per conversation segment and participant.

    ``mask`` lists the spans as ``start-end`` joined by commas; ``block`` and ``part``
    number the segments.
    """
    said = said_turns(turns, segment_turns)
    speakers = speakers_of(said)
    order = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    segments = (said.withColumn("n", F.row_number().over(order))
                .withColumn("part", F.expr(f"(n - 1) div {segment_turns}"))
                .groupBy("conv_id", "block", "part")
                .agg(F.sort_array(F.collect_list(F.struct("n", "role", "text"))).alias("said")))
    views = (segments.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))
             .select("conv_id", "block", "part", "perspective", "said.role", "said.text"))

    def make():
        def work(batch):
            rows = []
            for who, roles, texts in zip(*(batch.column(c).to_pylist() for c in
                                           ("perspective", "role", "text")), strict=True):
                rendered, spans = render(who, roles, texts)
                rows.append((rendered, ",".join(f"{a}-{b}" for a, b in spans),
                             len(roles), len(spans)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("conv_id", "block", "part", "perspective")]
                + [pa.array(c) for c in zip(*rows, strict=True)],
                ["conv_id", "block", "part", "perspective", "rendered", "mask",
                 "n_turns", "n_own"])
        return work
    return per_batch(views, RENDERED, make)


DIALOGUE = ("conv_id long, segment long, perspective string, first_turn long, offset long, "
            "frame_chars long, rendered string, mask string, n_turns long, n_own long")


def dialogues(turns: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """One row per participant and segment of ``segment_turns`` turns by position.

    ``first_turn`` is the position of the segment's first turn, ``frame_chars`` the length
    of the repeated frame. ``rendered`` after the frame stands at ``offset`` in the whole
    rendering, so joined in order the segments give the whole; a span of ``mask`` moves by
    ``offset - frame_chars``.
    """
    said = said_turns(turns, segment_turns)
    # positions: turns of the earlier blocks, then the order inside the block
    earlier = said.groupBy("conv_id", "block").agg(F.count("*").alias("held")).select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"),
        (F.sum("held").over(Window.partitionBy("conv_id").orderBy("block"))
         - F.col("held")).alias("before"))
    order = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    placed = (said.withColumn("inside", F.row_number().over(order))
              .join(earlier, F.col("conv_id").eqNullSafe(F.col("c"))
                    & (F.col("block") == F.col("b")))
              .select("conv_id", "role", "text", F.expr("before + inside - 1").alias("n"))
              .withColumn("segment", F.expr(f"n div {segment_turns}")))
    lines = F.sort_array(F.collect_list(F.struct("n", "role", "text")))
    segments = placed.groupBy("conv_id", "segment").agg(lines.alias("said")).select(
        F.col("conv_id").alias("c"), F.col("segment").alias("s"), "said")
    frames = (placed.filter("segment = 0 and role = 'system'").groupBy("conv_id")
              .agg(lines.alias("frame")).select(F.col("conv_id").alias("f"), "frame"))
    # lengths as all others see the turns, and what a speaker's own turns differ by
    other, end = len(OTHER.format("")), len(END)
    sizes = (placed.groupBy("conv_id", "segment", "role").agg(
        F.count("*").alias("times"),
        F.sum(F.length("text") + end + F.when(F.col("role") == "system", len(SYSTEM))
              .otherwise(other + F.length("role"))).alias("chars"))
        .groupBy("conv_id", "segment").agg(
            F.sum("chars").alias("chars"),
            F.map_from_entries(F.collect_list(F.struct("role", "times"))).alias("times")))
    size = F.expr("chars + coalesce(times[perspective], 0) * "
                  f"({len(OWN) - other} - length(perspective))")
    upto = Window.partitionBy("conv_id", "perspective").orderBy("segment")
    views = (sizes.join(speakers_of(said), F.col("conv_id").eqNullSafe(F.col("of")))
             .withColumn("size", size)
             .withColumn("offset", F.sum("size").over(upto) - F.col("size"))
             .select("conv_id", "segment", "perspective", "offset")
             .join(segments, F.col("conv_id").eqNullSafe(F.col("c"))
                   & (F.col("segment") == F.col("s")))
             .join(frames, F.col("conv_id").eqNullSafe(F.col("f")) & (F.col("segment") > 0),
                   "left")
             .select("conv_id", "segment", "perspective", "offset", "said.role", "said.text",
                     F.expr("said.n[0]").alias("first_turn"),
                     F.coalesce("frame.text", F.array()).alias("frame")))

    def make():
        def work(batch):
            rows = []
            for who, roles, texts, frame in zip(*(batch.column(c).to_pylist() for c in (
                    "perspective", "role", "text", "frame")), strict=True):
                framed = sum(len(SYSTEM) + len(t) + len(END) for t in frame)
                rendered, spans = render(who, ["system"] * len(frame) + roles, frame + texts)
                rows.append((framed, rendered, ",".join(f"{a}-{b}" for a, b in spans),
                             len(roles), len(spans)))
            names = [c.split()[0] for c in DIALOGUE.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names[:5]]
                + [pa.array(c) for c in zip(*rows, strict=True)], names)
        return work
    return per_batch(views, DIALOGUE, make)
