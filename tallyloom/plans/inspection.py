"""A first look at source files (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.constants import ANSWER_LABELS
from tallyloom.functions import text
from tallyloom.sources import reports
from tallyloom.sources.shards import first_rows, parquet_reader, table_profile


def inspect_source(
    spark: SparkSession,
    path: str,
    folder: str,
    n: int = 5,
    image: str = "image",
    target: str = "canonical_disease",
    raw_target: str = "disease",
) -> tuple[DataFrame, DataFrame]:
    """Columns with the row count, and a preview with the conversation each row would give.

    Both are written below ``folder`` as JSON and returned.
    """
    profile = table_profile(parquet_reader(spark).parquet(path))
    preview = first_rows(spark, path, n, heavy=[image])

    def known(name: str) -> str | None:
        return name if name in preview.columns else None

    preview = preview.withColumn("user_prompt", text.user_prompt(known("crop"), known("plant_organ")))
    if target in preview.columns:
        context = {name: name for name in ANSWER_LABELS if name != "diagnosis" and name in preview.columns}
        preview = preview.withColumn("answer", text.answer_text(target, known(raw_target), context))
    reports.write_json(profile, f"{folder.rstrip('/')}/columns")
    reports.write_json(preview, f"{folder.rstrip('/')}/sample_preview")
    return profile, preview
