"""Manifests: one row per selected sample, kept as one table partitioned by split (A3, A4).

A manifest is written plainly, for one owner, or published: every publication is a new folder of
``<path>-versions/data``, and becomes current when one row about it is appended to
``<path>-versions/log``. Spark commits that row by renaming one file, so readers see the old
version or the new one, whole; readers of the old one are left in peace.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SPLIT_COLUMN = "split"
PREPROCESSED = "preprocessed_manifest"
PLAIN = "manifest"
LOG_SCHEMA = "version bigint, folder string, published timestamp, columns string"


def write_manifest(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3: one directory per split. A reader of one split opens that directory alone.

    Rows are gathered by split first, and large splits divided again, so files are neither tiny
    nor huge.
    """
    df.hint("rebalance", SPLIT_COLUMN).write.mode(mode).partitionBy(SPLIT_COLUMN).parquet(path)


def manifest_versions(spark: SparkSession, path: str) -> DataFrame:
    """Publications of a manifest: ``version, folder, published, columns``. Empty if the log holds none yet."""
    return spark.read.schema(LOG_SCHEMA).parquet(f"{path}-versions/log")


def _table_exists(problem: AnalysisException) -> bool:
    return problem.getCondition() != "PATH_NOT_FOUND"


def publication(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    """The log's row of a version, or of the newest; None if there is none.

    Of publications that raced for one number, the larger folder name counts, for every reader.
    """
    try:
        log = manifest_versions(spark, path)
    except AnalysisException as problem:
        if _table_exists(problem):
            raise
        return None
    if version is not None:
        log = log.where(F.col("version") == version)
    return log.agg(F.max(F.struct("version", "folder", "columns")).alias("newest")).first().newest


def publish_manifest(df: DataFrame, path: str) -> int:
    """A3 for manifests that are read while they are made anew; returns the number of the version.

    ``df`` may read the current version. An attempt that fails before its row is in the log leaves
    a folder that no reader looks at.
    """
    spark, folder = df.sparkSession, uuid.uuid4().hex
    write_manifest(df, f"{path}-versions/data/{folder}", "errorifexists")
    try:
        last = manifest_versions(spark, path).agg(F.max("version")).first()[0]
    except AnalysisException as problem:
        if _table_exists(problem):
            raise
        last = None
    version = (last or 0) + 1
    row = spark.range(0, 1, 1, 1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.lit(folder).alias("folder"),
        F.current_timestamp().alias("published"),
        F.lit(df.schema.json()).alias("columns"),
    )
    row.write.mode("append").parquet(f"{path}-versions/log")
    return version


def current_manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A4: the newest publication, or the one of a number; without publications the plain table."""
    found = publication(spark, path, version)
    if found is None and version is not None:
        raise FileNotFoundError(f"no version {version} of {path}")
    if found is None:
        return spark.read.parquet(path)
    # The log knows the columns, so a manifest without rows can be read as well.
    columns = StructType.fromJson(json.loads(found.columns))
    return spark.read.schema(columns).parquet(f"{path}-versions/data/{found.folder}")


def first_readable(spark: SparkSession, candidates: Sequence[str]) -> DataFrame:
    """A4: the first path that exists, as a table; a publication goes before a plain table."""
    for path in candidates:
        try:
            return current_manifest(spark, path)
        except AnalysisException as problem:
            if _table_exists(problem):
                raise
    raise FileNotFoundError(f"no manifest at any of {list(candidates)}")


def read_manifest(spark: SparkSession, split: str, folders: Sequence[str]) -> DataFrame:
    """A4: rows of one split from the best manifest of the first folders that have one.

    A preprocessed manifest wins over a plain one, whatever the folder. Only the plain manifest
    serves the test split.
    """
    names = [PLAIN] if split == "test" else [PREPROCESSED, PLAIN]
    candidates = [f"{folder.rstrip('/')}/{name}" for name in names for folder in folders]
    return first_readable(spark, candidates).where(F.col(SPLIT_COLUMN) == split)
