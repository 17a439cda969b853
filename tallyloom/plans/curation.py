"""Source files to a balanced, split manifest with its statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.constants import (
    FILE_COLUMN,
    MAX_CLASS_ROWS,
    MAX_TRAIN_ROWS,
    METADATA_COLUMNS,
    MIN_CLASS_ROWS,
    ORDINAL_COLUMN,
    SEED,
    TEST_FRACTION,
    VALIDATION_FRACTION,
)
from tallyloom.operators import sampling
from tallyloom.operators.statistics import class_distribution, dataset_statistics
from tallyloom.sources import reports
from tallyloom.sources.manifests import PLAIN, current_manifest, publish_manifest
from tallyloom.sources.shards import scan_metadata
from tallyloom.sources.workspace import stage

POINTER = (FILE_COLUMN, ORDINAL_COLUMN)
DESCRIBED = ("visual_symptoms", "plant_organ", "pathogen", "disease_type")


@dataclass(frozen=True)
class Selection:
    """What to select. ``max_train_rows`` bounds the train split, not the selection."""

    target: str = "canonical_disease"
    segment: str | None = "crop"
    min_class_rows: int = MIN_CLASS_ROWS
    max_class_rows: int = MAX_CLASS_ROWS
    max_train_rows: int = MAX_TRAIN_ROWS
    val_fraction: float = VALIDATION_FRACTION
    test_fraction: float = TEST_FRACTION
    seed: int = SEED


def select_rows(source: DataFrame, selection: Selection = Selection(), key: Sequence[str] = POINTER) -> DataFrame:
    """Balance, cap and split the rows of a metadata scan.

    The capped selection is staged: it is small next to the source, and the split reads it more
    than once. Its classes are bounded by the caps.
    """
    balanced = sampling.balance_classes(
        source, selection.target, key, selection.min_class_rows, selection.max_class_rows, selection.seed
    )
    most = sampling.total_cap(selection.max_train_rows, selection.val_fraction, selection.test_fraction)
    chosen = stage(sampling.cap_rows(stage(balanced, "balanced", compact=True), most, key, selection.seed), "chosen")
    return sampling.stratified_split(
        chosen,
        selection.target,
        key,
        selection.val_fraction,
        selection.test_fraction,
        selection.seed,
        class_bound=max(selection.min_class_rows, selection.max_class_rows),
    )


def build_manifest(
    spark: SparkSession,
    paths: str | Sequence[str],
    folder: str,
    selection: Selection = Selection(),
    columns: Sequence[str] = METADATA_COLUMNS,
    schema: StructType | str | None = None,
    report_folder: str | None = None,
) -> DataFrame:
    """Scan, select, publish ``folder``/manifest, write its statistics; returns the version of this call."""
    source = scan_metadata(spark, paths, columns, schema)
    path = f"{folder.rstrip('/')}/{PLAIN}"
    rows = sampling.with_shuffle_key(select_rows(source, selection), POINTER, selection.seed)
    manifest = current_manifest(spark, path, publish_manifest(rows, path))
    reports_at = (report_folder or folder).rstrip("/")
    described = [name for name in DESCRIBED if name in manifest.columns]
    segment = selection.segment if selection.segment in manifest.columns else None
    statistics = dataset_statistics(
        manifest, source.agg(F.count(F.lit(1))).scalar(), selection.target, segment, described
    )
    reports.write_json(statistics, f"{reports_at}/data_statistics")
    reports.write_csv(
        class_distribution(manifest, selection.target),
        f"{reports_at}/class_distribution",
        [F.desc("total_samples"), selection.target],
    )
    return manifest
