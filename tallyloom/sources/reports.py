"""Sinks for finished report tables (A5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(report: DataFrame, path: str, order: Sequence[Column | str] = ()) -> None:
    """One headed CSV table; with ``order``, the files follow it by name.

    Quotes are doubled, as most readers expect; texts may hold line ends.
    """
    table = report.orderBy(*order) if order else report
    table.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(report: DataFrame, path: str) -> None:
    """One JSON object per row; null fields are written out."""
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def rounded(report: DataFrame, places: int = 4) -> DataFrame:
    """Round every fractional column half-even, as reports show them."""
    return report.select(
        *[
            F.bround(F.col(name), places).alias(name) if kind in ("double", "float") else F.col(name)
            for name, kind in report.dtypes
        ]
    )
