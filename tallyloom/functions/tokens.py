"""Loss masks and prompt removal over arrays of token ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.constants import IGNORED_LABEL
from tallyloom.functions.text import as_column


def marker_end(ids: Column | str, marker: Sequence[int]) -> Column:
    """Number of tokens up to the end of the first occurrence of ``marker``; null without one.

    The search runs over the ids as comma-separated text, which the JVM scans once per row; a
    lambda over positions would copy a slice for each of them.
    """
    if not marker:
        raise ValueError("the marker needs at least one token")
    text = F.concat(F.lit(","), F.array_join(as_column(ids).cast("array<string>"), ",", "?"), F.lit(","))
    found = F.instr(text, F.lit("," + ",".join(str(int(token)) for token in marker) + ","))
    before = F.substring(text, F.lit(1), found)
    # As many commas as tokens in front of the marker, plus the one that opens it.
    skipped = F.length(before) - F.length(F.replace(before, F.lit(","), F.lit("")))
    return F.when(found > 0, skipped - 1 + len(marker))


def loss_labels(
    ids: Column | str,
    attention: Column | str,
    marker: Sequence[int],
    prompt_length: Column | str,
) -> Column:
    """C14: the ids with ignored labels over the prompt and the padding.

    The prompt ends with the first marker. Without a marker the first ``prompt_length`` tokens
    count as prompt. Everything after the first marker is trained on. ``attention`` has one entry
    per token.
    """
    ids = as_column(ids)
    ignored = F.lit(IGNORED_LABEL).cast("int")
    prompt = F.least(F.coalesce(as_column(prompt_length), F.lit(0)), F.size(ids))
    cut = F.coalesce(marker_end(ids, marker), prompt).cast("int")
    labels = F.concat(F.array_repeat(ignored, cut), F.slice(ids, cut + 1, F.size(ids)))
    return F.zip_with(labels, as_column(attention), lambda label, seen: F.when(seen == 0, ignored).otherwise(label))


def drop_prompt(generated: Column | str, prompt: Column | str) -> Column:
    """The generated ids after as many tokens as the prompt has."""
    generated, prompt = as_column(generated), as_column(prompt)
    left = F.greatest(F.size(generated) - F.size(prompt), F.lit(0))
    return F.slice(generated, F.size(prompt) + 1, left)
