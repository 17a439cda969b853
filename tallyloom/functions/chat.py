"""Conversations as nested columns and their rendering as one string."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import as_column


@dataclass(frozen=True)
class ChatMarks:
    """How a rendered message opens and closes. ``{role}`` is replaced in ``opening``."""

    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"
    image: str = "<image>"
    answering: str = "assistant"

    def opened(self, role: Column) -> Column:
        before, after = self.opening.split("{role}")
        return F.concat(F.lit(before), role, F.lit(after))

    @property
    def generation_prompt(self) -> str:
        return self.opening.replace("{role}", self.answering)


def conversation(image: Column | str, prompt: Column | str, answer: Column | str | None = None) -> Column:
    """A user message of [image, text] and, when ``answer`` is given, an assistant message."""
    image = as_column(image)

    def part(kind: str, text: Column | None, picture: Column | None) -> Column:
        return F.struct(
            F.lit(kind).alias("type"),
            (F.lit(None).cast("string") if text is None else text).alias("text"),
            (F.when(F.lit(False), image) if picture is None else picture).alias("image"),
        )

    def message(role: str, *parts: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), F.array(*parts).alias("content"))

    messages = [message("user", part("image", None, image), part("text", as_column(prompt), None))]
    if answer is not None:
        messages.append(message("assistant", part("text", as_column(answer), None)))
    return F.array(*messages)


def render_message(role: Column | str, text: Column | str, marks: ChatMarks = ChatMarks()) -> Column:
    """One message between its marks."""
    return F.concat(marks.opened(as_column(role)), F.coalesce(as_column(text), F.lit("")), F.lit(marks.closing))


def render_conversation(
    messages: Column | str, add_generation_prompt: bool = False, marks: ChatMarks = ChatMarks()
) -> Column:
    """C7 for the output of :func:`conversation`: one string per row, an image mark per image part."""
    body = F.array_join(
        F.transform(
            as_column(messages),
            lambda message: render_message(
                message["role"],
                F.array_join(
                    F.transform(
                        message["content"],
                        lambda part: F.when(part["type"] == "image", F.lit(marks.image)).otherwise(
                            F.coalesce(part["text"], F.lit(""))
                        ),
                    ),
                    "",
                ),
                marks,
            ),
        ),
        "",
    )
    return F.concat(body, F.lit(marks.generation_prompt)) if add_generation_prompt else body
