"""Operators on unbounded input.

The row-wise ones need no state, so a stream runs them as they are. Progress keeps one row per active
run between micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.operators.history import progress, running_best
from tallyloom.operators.ordered import join_groups
from tallyloom.sources.quarantine import bad_rows, good_rows


def stream_metadata(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    columns: Sequence[str],
    max_files: int = 1000,
) -> DataFrame:
    """A lazy scan of source files as they arrive; only the wanted columns are read."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .parquet(path)
        .select(*columns)
    )


def quarantine_batches(
    good_path: str,
    bad_path: str,
    filename: str,
    file: str | None = None,
    ordinal: str | None = None,
    error: str = "error",
) -> Callable[[DataFrame, int], None]:
    """A6 for ``foreachBatch``: rows without an error to one table, bad-sample rows to another.

    Each micro-batch owns a directory named after its number and overwrites it, so a batch that
    runs again after a failure leaves no duplicates.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # written twice, computed once
        try:
            good_rows(batch, error).write.mode("overwrite").parquet(f"{good_path}/batch={number}")
            bad = bad_rows(batch, filename, file, ordinal, error)
            bad.write.mode("overwrite").parquet(f"{bad_path}/batch={number}")
        finally:
            batch.unpersist()

    return write


def progress_batches(
    out_path: str,
    state_path: str,
    total_steps: int | Column,
    budget_seconds: float,
    by: Sequence[str] = ("run",),
    step: str = "step",
    ts: str = "ts",
    metric: str | None = None,
    floor: float = -1.0,
    timeout_seconds: float | None = None,
) -> Callable[[DataFrame, int], None]:
    """T3 for ``foreachBatch``, with ``metric`` also T1's running best, over log rows as they arrive.

    State is one row per run: first and last time, best metric. A run starts with its earliest row up to the
    batch, and the running best follows ``step`` inside a batch. Rows that arrive in the order of time and step
    hence get what the batch operators give them, however they are split. Null is a run like any other.

    With ``timeout_seconds`` a run whose last row is that much older than the newest row of earlier batches is
    forgotten; a later row begins it anew. State then stays as small as the runs that are active.

    Batch n reads state n-1 and overwrites state n and output n, so a batch that runs again after a failure
    leaves no duplicates. Rows are combined before the shuffle: a hot run gathers in no task.
    """

    def state(spark: SparkSession, batch: DataFrame, number: int) -> DataFrame:
        """State n; ``_before`` is the best before this batch."""
        best = F.col(metric).cast("double") if metric is not None else F.lit(None).cast("double")
        none = F.lit(None).cast("double")
        fresh = batch.select(
            *by, F.col(ts).alias("_start"), F.col(ts).alias("_last"),
            F.when(~F.isnan(best), best).alias("_best"), none.alias("_before"),
        )
        if number > 0:
            known = spark.read.schema(fresh.schema).parquet(f"{state_path}/batch={number - 1}")
            known = known.withColumn("_before", F.col("_best"))
            if timeout_seconds is not None:
                newest = known.agg(F.max("_last")).scalar()
                span = F.make_dt_interval(secs=F.lit(float(timeout_seconds)))
                known = known.where(F.coalesce(F.col("_last") >= newest - span, F.lit(True)))
            fresh = fresh.unionByName(known)
        merged = fresh.groupBy(*by).agg(
            F.min("_start").alias("_start"), F.max("_last").alias("_last"),
            F.max("_best").alias("_best"), F.max("_before").alias("_before"),
        )
        merged.write.mode("overwrite").parquet(f"{state_path}/batch={number}")
        return spark.read.schema(merged.schema).parquet(f"{state_path}/batch={number}")

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # read for the state and for the output
        try:
            runs = state(batch.sparkSession, batch, number).select(*by, "_start", F.col("_before").alias("_earlier"))
            rows = progress(join_groups(batch, runs, by), total_steps, budget_seconds, by, step, ts, "_start")
            if metric is not None:
                rows = running_best(rows, by, step, metric, floor)
                rows = rows.withColumn("improved", F.col("improved") & F.coalesce(F.col(metric) > F.col("_earlier"), F.lit(True)))
                rows = rows.withColumn("best_so_far", F.greatest("best_so_far", "_earlier"))
            rows.drop("_start", "_earlier").write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        finally:
            batch.unpersist()

    return write
