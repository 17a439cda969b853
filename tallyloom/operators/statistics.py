"""What a selection consists of (E1, E2) and how a job went."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import informative

SPLITS = ("train", "val", "test")


def dataset_statistics(
    selected: DataFrame,
    source_rows: Column | int,
    target: str,
    segment: str | None = None,
    described: Sequence[str] = (),
    split: str = "split",
) -> DataFrame:
    """One row of counts over a split selection.

    Null is no class and no segment. ``described`` columns are counted where informative. One pass
    groups by class and by segment at once and combines on the map side; the median is exact, over
    one row per class.
    """
    rows = selected.select(
        F.col(target).alias("_class"),
        (F.lit(None).cast("string") if segment is None else F.col(segment)).alias("_segment"),
        F.col(split).alias("_split"),
        *[informative(name).alias(f"_with_{name}") for name in described],
    )
    grouped = rows.groupingSets([["_class"], ["_segment"]], "_class", "_segment").agg(
        (F.grouping("_class") == 0).alias("_per_class"),
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col("_split") == name).alias(f"_{name}") for name in SPLITS],
        *[F.count_if(F.col(f"_with_{name}")).alias(f"_rows_with_{name}") for name in described],
    )
    per_class = F.col("_per_class")
    class_size = F.when(per_class & F.col("_class").isNotNull(), F.col("_n"))
    source = F.lit(source_rows).cast("bigint") if isinstance(source_rows, int) else source_rows

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(per_class, F.col(name))), F.lit(0).cast("bigint"))

    return grouped.agg(
        total("_n").alias("selected_total_rows"),
        *[total(f"_{name}").alias(f"selected_{name}_rows") for name in SPLITS],
        F.count(class_size).alias("num_classes"),
        F.median(class_size).alias("median_samples_per_class"),
        F.min(class_size).alias("min_samples_per_class"),
        F.max(class_size).alias("max_samples_per_class"),
        *[total(f"_rows_with_{name}").alias(f"rows_with_{name}") for name in described],
        F.count_if(~per_class & F.col("_segment").isNotNull()).alias("num_segments"),
    ).select(source.alias("total_source_rows"), "*")


def class_distribution(selected: DataFrame, target: str, split: str = "split") -> DataFrame:
    """Rows per class in all and in each split, zero where a class is absent.

    For a file, order by total descending, then class.
    """
    return (
        selected.where(F.col(target).isNotNull())
        .groupBy(target)
        .agg(
            F.count(F.lit(1)).alias("total_samples"),
            *[F.count_if(F.col(split) == name).alias(f"{name}_samples") for name in SPLITS],
        )
    )


def job_tallies(outcome: DataFrame, path: str = "image_path", n_bytes: str = "n_bytes", error: str = "error") -> DataFrame:
    """Finished rows, all rows, bytes written and bad rows of a preprocessing outcome."""
    return outcome.agg(
        F.count(path).alias("valid_rows"),
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum(n_bytes), F.lit(0).cast("bigint")).alias("total_bytes"),
        F.count(error).alias("bad_rows"),
    )
