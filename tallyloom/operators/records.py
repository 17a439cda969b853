"""Evaluation records from generated answers, and those that went wrong."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import is_correct, parse_answer, scoring_truth
from tallyloom.operators.metrics import segment_name

# Fields of a record.
FIELDS = [
    "filename",
    "crop",
    "ground_truth",
    "predicted",
    "predicted_type",
    "predicted_organ",
    "predicted_symptoms",
    "predicted_pathogen",
    "plant_organ",
    "visual_symptoms",
    "pathogen",
    "is_correct",
    "raw_output",
]


def _known(df: DataFrame, name: str) -> Column:
    """A metadata column as text; empty when the table lacks it."""
    return F.col(name).cast("string") if name in df.columns else F.lit("")


def evaluation_records(
    answers: DataFrame,
    key: str | Sequence[str],
    answer: str = "raw_output",
    target: str = "canonical_disease",
    raw_target: str | None = "disease",
    segment: str = "crop",
) -> DataFrame:
    """The row key and thirteen fields per answer; one projection, no shuffle.

    Without a file name column, rows are named after their key.
    """
    key = [key] if isinstance(key, str) else list(key)
    raw = raw_target if raw_target in answers.columns else None
    named = (
        F.col("filename").cast("string")
        if "filename" in answers.columns
        else F.concat_ws("_", F.lit("sample"), *[F.col(name).cast("string") for name in key])
    )
    # The answer is parsed once; the projections below only pick fields.
    parsed = answers.withColumn("_parsed", parse_answer(answer)).withColumn(
        "_truth", scoring_truth(target, raw)
    )
    return parsed.select(
        *[F.col(name) for name in key if name not in FIELDS],
        named.alias("filename"),
        (segment_name(segment) if segment in answers.columns else F.lit("Unknown")).alias("crop"),
        F.col("_truth").alias("ground_truth"),
        F.col("_parsed.diagnosis").alias("predicted"),
        F.col("_parsed.disease_type").alias("predicted_type"),
        F.col("_parsed.plant_organ").alias("predicted_organ"),
        F.col("_parsed.visual_symptoms").alias("predicted_symptoms"),
        F.col("_parsed.pathogen").alias("predicted_pathogen"),
        _known(answers, "plant_organ").alias("plant_organ"),
        _known(answers, "visual_symptoms").alias("visual_symptoms"),
        _known(answers, "pathogen").alias("pathogen"),
        is_correct(F.col("_truth"), F.col("_parsed.diagnosis")).alias("is_correct"),
        F.col(answer).alias("raw_output"),
    )


def failures(records: DataFrame) -> DataFrame:
    """Records whose prediction is not correct."""
    return records.where(~F.col("is_correct"))
