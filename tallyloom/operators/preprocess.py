"""Resumable conversion of the images of a manifest."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.constants import FINISHED_BYTES
from tallyloom.operators.scoring import IMAGE_ROWS, Transcode, arrow_batches, transcode_batches
from tallyloom.sources.workspace import stage, write_once

# Outputs are spread over directories named after the first digits of their names.
PREFIX_DIGITS = 3
# What a task reads of outputs on average, and what opening one counts as.
TASK_BYTES, OPEN_BYTES = 128 * 1024 * 1024, 64 * 1024


@lru_cache(maxsize=64)
def open_folder(folder: str) -> tuple[FileSystem, str]:
    """File system and path of a folder given as a path or a URI."""
    uri = folder if ":" in folder else f"file://{folder}"
    return FileSystem.from_uri(re.sub("^s3a:", "s3:", re.sub("^file:/+", "file:///", uri)))


class FolderStore:
    """Writes outputs below a folder that all executors reach, given as a path or a URI."""

    def __init__(self, root: str):
        self.root = root

    def __call__(self, path: str, data: bytes) -> None:
        files, base = open_folder(self.root)
        target = f"{base}/{path}"
        files.create_dir(target.rsplit("/", 1)[0], recursive=True)
        # A reader never sees half a file, and a retried task replaces the same one.
        draft = f"{target}.{uuid.uuid4().hex}.part"
        with files.open_output_stream(draft) as out:
            out.write(data)
        files.move(draft, target)


class FileReader:
    """Content of the first of several paths that is a file, given as paths or URIs; opened inside the task that needs it."""

    def __call__(self, paths: Sequence[str]) -> bytes:
        for path in paths:
            # One file system per store, not per image.
            scheme, host, rest = re.match(r"(?:([A-Za-z][A-Za-z0-9+.-]*)://([^/]*))?(.*)", path, re.S).groups()
            files, base = open_folder(f"{scheme}://{host}" if scheme and host else "/")
            name = f"{base.rstrip('/')}{rest}"
            if files.get_file_info(name).is_file:
                with files.open_input_stream(name) as stream:
                    return stream.read()
        raise FileNotFoundError(f"no such image path: {paths[0]}")


def output_name(key: Sequence[str], suffix: str = ".jpg") -> Column:
    """Path below the output folder, from the row key alone: a new subset keeps old names valid.

    Keys of several columns are hashed as JSON, so nulls and separators in them give no shared name.
    """
    parts = [F.col(part).cast("string").alias(part) for part in key]
    whole = F.concat_ws("", *parts) if len(parts) == 1 else F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
    name = F.md5(whole)
    return F.concat(F.substring(name, 1, PREFIX_DIGITS), F.lit("/"), name, F.lit(suffix))


def finished_outputs(spark: SparkSession, folder: str, suffix: str = ".jpg", min_bytes: int = FINISHED_BYTES) -> DataFrame:
    """Outputs of earlier runs with their sizes: ``output_path, n_bytes``.

    Each task lists some of the name-prefix directories, so the listing never passes through the
    driver, however many outputs there are.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = open_folder(folder)
        for batch in batches:
            for prefix in batch["prefix"]:
                found = files.get_file_info(FileSelector(f"{base}/{prefix}", allow_not_found=True))
                kept = [(f"{prefix}/{file.base_name}", file.size) for file in found if file.base_name.endswith(suffix)]
                yield pd.DataFrame(kept, columns=["output_path", "n_bytes"])

    number = 16**PREFIX_DIGITS
    prefixes = spark.range(0, number, 1, min(number, 64)).select(
        F.lower(F.lpad(F.hex("id"), PREFIX_DIGITS, "0")).alias("prefix")
    )
    return prefixes.mapInPandas(run, "output_path string, n_bytes bigint").where(F.col("n_bytes") > min_bytes)


def output_contents(spark: SparkSession, folder: str, suffix: str = ".jpg", batch_rows: int = IMAGE_ROWS) -> DataFrame:
    """Outputs with what they hold: ``output_path, content``.

    Spark's own scan of files would hold the name and status of each on the driver. Here tasks list the folder, and other tasks,
    dealt by hash, open the files; the driver learns one sum. Contents travel ``batch_rows`` at a time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = open_folder(folder)
        for batch in batches:
            for start in range(0, len(batch), batch_rows):
                paths, contents = list(batch["output_path"].iloc[start : start + batch_rows]), []
                for path in paths:
                    with files.open_input_stream(f"{base}/{path}") as stream:
                        contents.append(stream.read())
                yield pd.DataFrame({"output_path": paths, "content": contents})

    # Empty files count as well.
    listed = stage(finished_outputs(spark, folder, suffix, -1), "outputs")
    weight = listed.agg(F.sum(F.col("n_bytes") + OPEN_BYTES)).first()[0] or 0
    dealt = listed.select("output_path").repartition(max(1, -(-weight // TASK_BYTES)), "output_path")
    return dealt.mapInPandas(run, "output_path string, content binary")


def preprocess_images(
    rows: DataFrame,
    payloads: Callable[[DataFrame], DataFrame | Iterable[DataFrame]],
    key: str | Sequence[str],
    transcode: Transcode,
    folder: str,
    store=None,
    suffix: str = ".jpg",
    batch_rows: int = IMAGE_ROWS,
    keep: Sequence[str] = (),
    fetch: Callable[[Sequence[str]], bytes] | None = None,
) -> DataFrame:
    """``key..., keep..., output_path, n_bytes, error`` for every row; outputs are written on the way.

    ``payloads`` takes the rows still to do (key columns and all others, plus ``output_path``) and
    returns them with a ``payload`` column; it is called for unfinished rows alone, so a
    second run fetches no image twice. It may also return passes, each converted and staged before the next
    is asked for; rows in none of them fail. With ``fetch``, rows also name files by ``places`` (U2). The outcome is staged, so reading it does
    not convert again.
    """
    spark = rows.sparkSession
    key = [key] if isinstance(key, str) else list(key)
    kept = [*key, *keep, "output_path"]
    named = rows.withColumn("output_path", output_name(key, suffix))
    done = stage(finished_outputs(spark, folder, suffix), "finished")
    earlier = named.select(*kept).join(done, "output_path").select(
        *kept, "n_bytes", F.lit(None).cast("string").alias("error")
    )
    pending = named.join(done, "output_path", "left_anti")
    with arrow_batches(spark, batch_rows):

        def convert(part: DataFrame) -> DataFrame:
            return transcode_batches(
                part, transcode, keep=kept, store=store or FolderStore(folder), path="output_path", fetch=fetch
            )

        found = payloads(pending)
        if isinstance(found, DataFrame):
            return stage(earlier.unionByName(convert(found)), "preprocessed")
        outcome = stage(earlier, "preprocessed")
        folders = [write_once(convert(part), "preprocessed") for part in found]
        if folders:
            fresh = spark.read.schema(outcome.schema).parquet(*folders)
            outcome = outcome.unionByName(fresh)
        reached = outcome.select("output_path").distinct()
        lost = named.select(*kept).join(reached, "output_path", "left_anti")
        failed = [F.lit(None).cast("bigint").alias("n_bytes"), F.lit("cannot read source row").alias("error")]
        return stage(outcome.unionByName(lost.select(*kept, *failed)), "preprocessed")


def with_image_path(manifest: DataFrame, outcome: DataFrame, key: str | Sequence[str], folder: str) -> DataFrame:
    """The manifest plus ``image_path``, null for rows that failed."""
    key = [key] if isinstance(key, str) else list(key)
    paths = outcome.select(
        *key,
        F.when(F.col("error").isNull(), F.concat(F.lit(folder.rstrip("/") + "/"), "output_path")).alias("image_path"),
    )
    return manifest.join(paths, key, "left")
