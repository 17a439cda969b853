"""Compare the rows of each bucket with each other, in parallel and without listing all pairs.

Rows come as ``bucket`` (long), an id and a payload. Buckets are sorted into tasks; a task holds
one bucket at a time. A bucket of more than ``CELL`` rows is dealt by hash into cells of about that size and
every pair of cells becomes a bucket of its own, so the largest bucket a task ever holds is two cells,
whatever one key holds. All pairs are still compared: nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.workspace import stage

CELL = 2048
# A list of so many hot buckets, of 12 bytes each, is sent to all tasks; a longer one is joined by shuffle.
LISTED_BUCKETS = 100_000


def split_hot(rows: DataFrame, key: str, cell: int = CELL) -> DataFrame:
    """``rows`` with columns ``bucket, home``; hot buckets become pairs of cells.

    ``home`` is the cell of the row in a pair of two cells (0 or 1) so that a comparison may skip what the
    cells' own buckets compare already; it is 2 for a whole bucket and for a cell paired with itself.
    """
    hot = rows.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > cell)
    hot = hot.select("bucket", F.ceil(F.col("size") / cell).cast("int").alias("cells"))
    # Written first: rows then meet a list whose size is known, and are not shuffled for it while it is short.
    hot = stage(hot, "hot-buckets")
    short = hot.count() <= LISTED_BUCKETS
    joined = rows.join(F.broadcast(hot) if short else hot, "bucket", "left")
    own = F.pmod(F.xxhash64(key, F.lit(11)), F.col("cells")).cast("int")
    others = F.sequence(F.lit(0), F.col("cells") - 1)
    pairs = F.transform(
        others,
        lambda other: F.struct(
            F.xxhash64("bucket", F.least(own, other), F.greatest(own, other)).alias("bucket"),
            F.when(own == other, 2).when(own < other, 0).otherwise(1).alias("home"),
        ),
    )
    single = F.array(F.struct(F.col("bucket"), F.lit(2).alias("home")))
    targets = F.when(F.col("cells").isNull(), single).otherwise(pairs)
    rest = [name for name in rows.columns if name != "bucket"]
    return joined.select(F.explode(targets).alias("to"), *rest).select("to.bucket", "to.home", *rest)


def whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Regroup sorted batches so that no bucket is cut; holds one batch and one bucket at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        first = int(np.searchsorted(keys, keys[-1]))
        if first == 0 and held and held[-1].column(0)[-1].as_py() == keys[-1]:
            held.append(batch)
            continue
        if held or first:
            yield pa.Table.from_batches([*held, batch.slice(0, first)])
        held = [batch.slice(first)]
    if held:
        yield pa.Table.from_batches(held)


def compare_buckets(rows: DataFrame, compare: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """Run ``compare`` on tables of whole buckets. Its first column is the sorted ``bucket``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches):
            yield compare(table)

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(work, schema)


def neighbours_in_bucket(buckets: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Positions i such that i and i + d lie in one bucket, for each distance d; every pair once."""
    alive, distance = np.arange(len(buckets)), 1
    while True:
        alive = alive[alive + distance < len(buckets)]
        alive = alive[buckets[alive] == buckets[alive + distance]]
        if not len(alive):
            return
        yield alive, distance
        distance += 1


class Forest:
    """Labels of rows joined so far; linking arrays of pairs costs a few vector steps."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                nearer = label[label]
                if np.array_equal(nearer, label):
                    break
                label[:] = nearer

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows that are not the first of their tree, and those first rows."""
        moved = np.flatnonzero(self.label != np.arange(len(self.label)))
        return moved, self.label[moved]
