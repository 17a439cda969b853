"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.workspace import new_folder, stage

HELD_OUT_FOLDS, HELD_OUT_FOLD = 4, 2
#: So many words of 64 marks, about 64 MB in a task's memory, are listed to all tasks; more marks are joined by shuffle.
MOST_WORDS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str = "doc_id") -> Column:
    """True for rows kept out of training; a null key is not held out and is never trained on."""
    fold = F.crc32(F.col(key).cast("string")) % HELD_OUT_FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def trainable(key: str = "doc_id") -> Column:
    return F.col(key).isNotNull() & ~held_out(key)


def spread(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out evenly for costly tasks, whatever the files looked like."""
    return rows.repartition(partitions) if partitions else rows


def marked_rows(rows: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key``, a long, is in ``marks``; wide rows stay where they are read.

    Marks are packed into one row per 64 neighbouring keys, so the list for all tasks is near a bit per row where keys are positions.
    ``marks`` is read twice.
    """
    word, place = F.shiftright(key, 6), F.col(key).bitwiseAND(63).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    words = stage(marks.groupBy(word.alias("__llm_word")).agg(F.bit_or(bit).alias("__llm_bits")), "marks", compact=True)
    if words.count() > MOST_WORDS:
        return rows.join(marks, key, "left_semi")
    found = rows.join(F.broadcast(words), word == F.col("__llm_word")).where(F.getbit("__llm_bits", place) == 1)
    return found.select(*rows.columns)


def gathered(spark: SparkSession, name: str, parts: Iterable[DataFrame], schema: str) -> DataFrame:
    """Rows of all ``parts``, each written before the next one is built, so a long row of blocks is no long plan."""
    folder, paths = new_folder(spark, name), []
    for part in parts:
        paths.append(f"{folder}/{len(paths)}")
        part.write.parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def vocabulary_path(name: str) -> str:
    """Where this machine keeps a public vocabulary file."""
    return public_tokenizers.path(name)


class Known(dict):
    """Word -> computed value. When it is full it becomes the ``old`` half of a new table, so memory is bounded."""

    LONGEST = 64

    def __init__(self, compute, old: dict | None = None):
        super().__init__()
        self.compute, self.old = compute, old or {}

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word, self)
        if len(word) <= self.LONGEST:
            self[word] = value
        return value

    def renewed(self, limit: int) -> Known:
        if len(self) <= limit:
            return self
        self.old = {}
        return Known(self.compute, self)
