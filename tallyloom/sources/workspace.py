"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, or a folder of its warehouse, which is shared as well."""
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, name: str, compact: bool = False) -> str:
    """Write ``df`` to a new folder and return its path.

    ``compact`` evens out the files first. It is meant for selections that leave few rows per
    task of a large scan, which would otherwise leave one tiny file per task.
    """
    path = new_folder(df.sparkSession, name)
    (df.hint("rebalance") if compact else df).write.parquet(path)
    return path


def stage(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write ``df`` once and read it back.

    Later stages neither repeat the work nor depend on executors that may be lost, and the
    planner sees the real size in bytes: a join broadcasts the staged side only when that size is
    under ``spark.sql.autoBroadcastJoinThreshold``, and shuffles both sides otherwise.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_once(df, name, compact))
