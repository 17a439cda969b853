"""Rows that failed, kept aside so that the run can go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def good_rows(outcome: DataFrame, error: str = "error") -> DataFrame:
    """Rows without an error, the error column dropped."""
    return outcome.where(F.col(error).isNull()).drop(error)


def bad_rows(
    outcome: DataFrame,
    filename: Column | str | None,
    file: Column | str | None = None,
    ordinal: Column | str | None = None,
    error: str = "error",
    at: Column | None = None,
) -> DataFrame:
    """Failed rows as five text columns: timestamp, filename, shard_id, row_idx, error."""

    def text(value: Column | str | None) -> Column:
        if value is None:
            return F.lit(None).cast("string")
        return (F.col(value) if isinstance(value, str) else value).cast("string")

    when = F.current_timestamp() if at is None else at
    return outcome.where(F.col(error).isNotNull()).select(
        F.date_format(when, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        text(filename).alias("filename"),
        text(file).alias("shard_id"),
        text(ordinal).alias("row_idx"),
        text(error).alias("error"),
    )


def append_quarantine(bad: DataFrame, path: str) -> None:
    """Append to the quarantine table; every run adds its own files."""
    bad.write.mode("append").parquet(path)
