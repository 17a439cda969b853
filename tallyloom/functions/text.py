"""Predicates, prompts, label normalisation and answer parsing over string columns.

Every function takes and returns a ``Column`` and stays in the JVM. White space means
Unicode white space throughout: Spark's ``trim`` removes the blank alone and Java's ``\\s`` is
ASCII, so trimming passes an explicit character set and regular expressions an explicit class.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.constants import (
    ANSWER_LABELS,
    FIELD_ALIASES,
    INSTRUCTION,
    LINE_ENDS,
    PUNCTUATION,
    SPACE_CLASS,
    UNINFORMATIVE,
    UNKNOWN,
    UNKNOWN_TARGET,
    WHITESPACE,
)


def as_column(value: Column | str) -> Column:
    """A column given by name or as it is."""
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Remove white space from both ends."""
    return F.btrim(as_column(value), F.lit(WHITESPACE))


def collapse_space(value: Column | str) -> Column:
    """One blank for every run of white space, none at the ends."""
    return strip(F.regexp_replace(as_column(value), SPACE_CLASS + "+", " "))


def informative(value: Column | str) -> Column:
    """True unless null, blank, or a word that stands for a missing value. Never null.

    A floating-point NaN casts to the text ``NaN`` and is caught by the word list.
    """
    text = as_column(value).cast("string")
    return text.isNotNull() & ~F.lower(strip(text)).isin(UNINFORMATIVE)


def clean(value: Column | str) -> Column:
    """Collapsed text, or an empty string when the value is not informative."""
    value = as_column(value)
    return F.when(informative(value), collapse_space(value.cast("string"))).otherwise(F.lit(""))


def class_name(value: Column | str) -> Column:
    """B1: null becomes "Unknown"; the rest is trimmed. An empty string stays its own class."""
    return strip(F.coalesce(as_column(value).cast("string"), F.lit(UNKNOWN)))


def training_target(target: Column | str, raw: Column | str | None = None) -> Column:
    """C3, training rule: the class when informative, else the raw label.

    ``raw=None`` means the table has no raw-label column. A raw label that is itself not
    informative gives an empty string (the answer line is still written).
    """
    target = as_column(target)
    fallback = F.lit(UNKNOWN_TARGET) if raw is None else clean(raw)
    return F.when(informative(target), collapse_space(target.cast("string"))).otherwise(fallback)


def scoring_truth(target: Column | str, raw: Column | str | None = None) -> Column:
    """C3, scoring rule: the first of class and raw label that is not null or empty.

    Unlike the training rule this keeps words such as "Unknown" as they are.
    """
    target = as_column(target).cast("string")
    rest = [] if raw is None else [as_column(raw).cast("string")]
    return F.coalesce(F.nullif(target, F.lit("")), *rest, F.lit(UNKNOWN))


def labelled_line(label: str, value: Column | str) -> Column:
    """``label: value``, or null when there is nothing informative to say."""
    value = as_column(value)
    return F.when(informative(value), F.concat(F.lit(f"{label}: "), collapse_space(value.cast("string"))))


def user_prompt(
    segment: Column | str | None = None,
    organ: Column | str | None = None,
    instruction: str = INSTRUCTION,
    labels: Mapping[str, str] = ANSWER_LABELS,
) -> Column:
    """C4: instruction line, then the context lines that have something to say."""
    lines = [F.lit(instruction)]
    if segment is not None:
        lines.append(labelled_line(labels["crop"], segment))
    if organ is not None:
        lines.append(labelled_line(labels["plant_organ"], organ))
    return F.concat_ws("\n", *lines)


def answer_text(
    target: Column | str,
    raw: Column | str | None = None,
    context: Mapping[str, Column | str] | None = None,
    labels: Mapping[str, str] = ANSWER_LABELS,
) -> Column:
    """Labelled lines in the order of ``labels``; only the class line is always there.

    ``context`` maps field names of ``labels`` to columns. Fields outside ``labels``
    (provenance, file names) are refused, so they cannot leak into training text.
    """
    context = dict(context or {})
    stray = set(context) - set(labels)
    if stray:
        raise ValueError(f"not answer fields: {sorted(stray)}")
    lines = []
    for field, label in labels.items():
        if field == "diagnosis":
            lines.append(F.concat(F.lit(f"{label}: "), training_target(target, raw)))
        elif field in context:
            lines.append(labelled_line(label, context[field]))
    return F.concat_ws("\n", *lines)


def normalize_label(value: Column | str) -> Column:
    """Lower case, no surrounding punctuation, blanks for runs of space, hyphen, underscore."""
    bare = F.btrim(F.lower(strip(as_column(value))), F.lit(PUNCTUATION + " "))
    spaced = F.regexp_replace(bare, SPACE_CLASS[:-1] + r"\-_]+", " ")
    return F.coalesce(strip(spaced), F.lit(""))


def _alias_pattern(aliases: Sequence[str]) -> str:
    names = "|".join(alias.replace(" ", SPACE_CLASS + "*") for alias in aliases)
    return f"(?iu)(?:{names}){SPACE_CLASS}*:{SPACE_CLASS}*([^\\n]+)"


def extract_field(text: Column | str, aliases: Sequence[str]) -> Column:
    """Rest of the line after the first ``alias:``, trimmed, without trailing ``. , ;``.

    Aliases match anywhere, also inside a word, and the value may start on the next line.
    A blank left in front of the removed punctuation stays.
    """
    value = F.regexp_extract(as_column(text), _alias_pattern(aliases), 1)
    return F.coalesce(F.rtrim(strip(value), F.lit(".,;")), F.lit(""))


def first_line(text: Column | str) -> Column:
    """First line that is not blank, trimmed; empty when there is none."""
    # Line ends are white space, so after trimming the left side the wanted line comes first.
    opened = F.ltrim(as_column(text), F.lit(WHITESPACE))
    return F.coalesce(strip(F.regexp_extract(opened, f"^[^{LINE_ENDS}]*", 0)), F.lit(""))


def fallback_class(text: Column | str) -> Column:
    """The first line, or what follows its first colon."""
    line = first_line(text)
    colon = F.instr(line, ":")
    return F.when(colon > 0, strip(F.substring(line, colon + 1, F.length(line)))).otherwise(line)


def parse_answer(
    text: Column | str, aliases: Mapping[str, Sequence[str]] = FIELD_ALIASES
) -> Column:
    """C9 + C10 as one struct: every field of ``aliases`` plus ``raw_text``; no field is null."""
    text = as_column(text)
    fields = []
    for name, names in aliases.items():
        value = extract_field(text, names)
        if name == "diagnosis":
            value = F.coalesce(F.nullif(value, F.lit("")), fallback_class(text))
        fields.append(value.alias(name))
    fields.append(F.coalesce(strip(text), F.lit("")).alias("raw_text"))
    return F.struct(*fields)


def exact_match(truth: Column | str, predicted: Column | str) -> Column:
    """C11: equal after trimming and lower-casing; a null counts as empty text."""

    def plain(value: Column | str) -> Column:
        return F.coalesce(F.lower(strip(as_column(value))), F.lit(""))

    return plain(truth) == plain(predicted)


def is_correct(
    truth: Column | str, predicted: Column | str, require_nonempty: bool = True
) -> Column:
    """Normalized equality, by default only for a prediction that is not empty."""
    guess = normalize_label(predicted)
    same = normalize_label(truth) == guess
    return same & (guess != "") if require_nonempty else same


def fill_from(predicted: Column | str, known: Column | str) -> Column:
    """The predicted field when not empty, else the known one, else empty text."""
    return F.coalesce(F.nullif(as_column(predicted), F.lit("")), as_column(known).cast("string"), F.lit(""))


def thousands(value: Column | str, missing: str = "N/A") -> Column:
    """Whole number with thousands separators; text that is no whole number stays as it is."""
    value = as_column(value)
    return F.coalesce(F.format_number(value.try_cast("bigint"), 0), value.cast("string"), F.lit(missing))


def duration(seconds: Column | str) -> Column:
    """``Hh MMm`` from one hour on, ``MMm SSs`` below."""
    seconds = as_column(seconds)
    hours = F.floor(seconds / 3600).cast("bigint")
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("bigint")
    rest = F.floor(F.pmod(seconds, F.lit(60))).cast("bigint")
    return F.when(hours > 0, F.format_string("%dh %02dm", hours, minutes)).otherwise(
        F.format_string("%02dm %02ds", minutes, rest)
    )
