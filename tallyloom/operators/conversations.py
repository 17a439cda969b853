"""Rendering of conversations kept as one row per turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.chat import ChatMarks, render_message
from tallyloom.operators.ordered import whole_part

TURNS_PER_PART = 1000


def render_turns(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    add_generation_prompt: bool = False,
    marks: ChatMarks = ChatMarks(),
    turns_per_part: int = TURNS_PER_PART,
) -> DataFrame:
    """Messages of a conversation in order of turn, as one string per conversation.

    Turns are joined in parts of ``turns_per_part`` first, so that the turns of a long conversation
    combine in many tasks; its parts are then joined in order. A conversation is one training
    example and has to fit a cell. ``turn`` is a whole number, unique within the conversation.
    """
    lines = turns.select(
        conversation,
        whole_part(turn, turns_per_part).alias("_part"),
        F.struct(F.col(turn).alias("turn"), render_message(role, text, marks).alias("line")).alias("_line"),
    )
    parts = lines.groupBy(conversation, "_part").agg(F.array_sort(F.collect_list("_line")).alias("_lines"))
    parts = parts.select(conversation, F.struct("_part", F.array_join("_lines.line", "").alias("text")).alias("_text"))
    whole = parts.groupBy(conversation).agg(F.array_sort(F.collect_list("_text")).alias("_texts"))
    body = F.array_join("_texts.text", "")
    if add_generation_prompt:
        body = F.concat(body, F.lit(marks.generation_prompt))
    return whole.select(conversation, body.alias("rendered"))
