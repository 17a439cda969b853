"""Scans of Parquet source files that keep a pointer to every row (A1, A2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.constants import FILE_COLUMN, METADATA_COLUMNS, ORDINAL_COLUMN


def parquet_reader(spark: SparkSession, schema: StructType | str | None = None) -> DataFrameReader:
    """A reader of all Parquet files below a path, with the union of their columns."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    # Merging reads every footer (in a Spark job). Give the schema to skip that.
    return reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)


def scan_metadata(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] = METADATA_COLUMNS,
    schema: StructType | str | None = None,
) -> DataFrame:
    """A1: the wanted columns that exist, plus source file and row ordinal.

    A column that only some files have is null for the others. Columns that are not wanted, such
    as the image, never leave storage.
    """
    table = parquet_reader(spark, schema).parquet(*([paths] if isinstance(paths, str) else paths))
    present = [name for name in columns if name in table.columns]
    return table.select(
        *present,
        F.col("_metadata.file_path").alias(FILE_COLUMN),
        F.col("_metadata.row_index").alias(ORDINAL_COLUMN),
    )


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files under ``path`` with their sizes; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", F.col("_metadata.file_path").alias(FILE_COLUMN), F.col("length").alias("n_bytes"))
    )


def table_profile(table: DataFrame) -> DataFrame:
    """A2: one row per column with its position, plus the number of rows.

    The count needs no column, so Parquet answers it from the footers.
    """
    names = F.array(
        *[
            F.struct(F.lit(at).alias("position"), F.lit(field.name).alias("column_name"))
            for at, field in enumerate(table.schema.fields)
        ]
    )
    return (
        table.agg(F.count(F.lit(1)).alias("total_rows"))
        .select("total_rows", F.explode(names).alias("_column"))
        .select("_column.position", "_column.column_name", "total_rows")
    )


def first_rows(
    spark: SparkSession,
    path: str,
    n: int = 5,
    heavy: Sequence[str] = ("image",),
) -> DataFrame:
    """A2: the first ``n`` rows of the first file by name, heavy columns shown as a type tag."""
    first = list_files(spark, path, "*.parquet").agg(F.min("path")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no Parquet files under {path}")
    table = spark.read.parquet(first)
    shown = [
        F.lit(f"<{field.dataType.simpleString()}>").alias(field.name)
        if field.name in heavy
        else F.col(field.name)
        for field in table.schema.fields
    ]
    # At most n rows pass the ordinal filter; the limit only lets the scan stop after them.
    return (
        table.select(*shown, F.col("_metadata.row_index").alias(ORDINAL_COLUMN))
        .where(F.col(ORDINAL_COLUMN) < n)
        .limit(n)
    )
