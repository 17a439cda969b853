"""Uniform shuffle into shards of exact size.

Rows stay in the task that reads them until it is known how many of them go to each shard: the
matrix of (task, shard) counts is drawn from its exact law, the multivariate hypergeometric one, from the
row counts alone. Then each task ranks its rows by a random key and cuts the ranks at its row of the
matrix (permute locally), rows move to their shard (exchange), and each shard ranks what it got by a
second random key (permute again). Every assignment of rows to shards and slots is equally likely, and shard
sizes differ by one row at most.

Row work is DataFrame operations only. The matrix has at most ``BLOCKS`` x shards numbers, whatever the
data; only row counts of blocks reach the driver. Rows are written once and exchanged once, with all their columns. Ranks are taken inside key ranges of about ``RANGE_ROWS`` rows with
offsets from counted ranges, so neither a block nor a shard is ever sorted in one task. Keys and blocks are
written once: a lost task re-reads the same draw.

Nulls, repeated rows and empty texts are rows like any other. An empty table gives no rows.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.workspace import stage

BLOCKS, RANGE_ROWS = 1024, 200_000
BLOCK, FIRST, SECOND, RANK = "__shard_block", "__shard_first", "__shard_second", "__shard_rank"


def draw_hypergeometric(draw: random.Random, good: int, bad: int, sample: int) -> int:
    """Good ones in a ``sample`` without replacement: inversion, walking outwards from the mode."""
    low, high = max(0, sample - bad), min(good, sample)
    if low == high:
        return low
    mode = min(max((sample + 1) * (good + 1) // (good + bad + 2), low), high)
    log = math.lgamma
    ways = lambda n, k: log(n + 1) - log(k + 1) - log(n - k + 1)
    peak = math.exp(ways(good, mode) + ways(bad, sample - mode) - ways(good + bad, sample))
    left = draw.random() - peak
    up, down, at_up, at_down = peak, peak, mode, mode
    while left >= 0:
        if at_up < high:
            up *= (good - at_up) * (sample - at_up) / ((at_up + 1) * (bad - sample + at_up + 1))
            at_up += 1
            left -= up
            if left < 0:
                return at_up
        if at_down > low:
            down *= at_down * (bad - sample + at_down) / ((good - at_down + 1) * (sample - at_down + 1))
            at_down -= 1
            left -= down
            if left < 0:
                return at_down
        if (at_up == high or up == 0) and (at_down == low or down == 0):
            return mode
    return mode


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows of each block for each shard: uniform over all assignments with these margins."""
    draw, left, matrix = random.Random(seed), list(sizes), []
    for count in counts:
        rest, row = sum(left), []
        for shard, free in enumerate(left):
            taken = draw_hypergeometric(draw, free, rest - free, count)
            rest, count = rest - free, count - taken
            left[shard] -= taken
            row.append(taken)
        matrix.append(row)
    return matrix


def _ranked(rows: DataFrame, group: str, key: str, most: int, rank: str) -> DataFrame:
    """``rank`` of each row inside its group in order of a uniform key, from 0."""
    ranges = max(1, math.ceil(most / RANGE_ROWS))
    part = F.floor(F.col(key) * ranges).alias("__shard_range")
    sizes = rows.groupBy(group, part).agg(F.count("*").alias("__shard_rows"))
    earlier = Window.partitionBy(group).orderBy("__shard_range").rowsBetween(Window.unboundedPreceding, -1)
    # One small row per range: broadcast would be safe too, but the join keeps the window's partitioning.
    offsets = sizes.select(
        group, "__shard_range", F.coalesce(F.sum("__shard_rows").over(earlier), F.lit(0)).alias("__shard_offset")
    )
    inside = Window.partitionBy(group, "__shard_range").orderBy(key, SECOND)
    ranked = rows.withColumn("__shard_range", part).withColumn(rank, F.row_number().over(inside) - 1)
    joined = ranked.join(offsets, [group, "__shard_range"])
    return joined.withColumn(rank, F.col(rank) + F.col("__shard_offset")).drop("__shard_range", "__shard_offset")


def _bounds(spark, matrix: dict[int, list[int]]) -> DataFrame:
    """``block, ends``: where each shard's share of the block's ranks ends. A bounded table."""
    ends = []
    for block, row in matrix.items():
        total = 0
        ends.append({"b": block, "e": [total := total + n for n in row]})
    text = F.from_json(F.lit(json.dumps(ends)), "array<struct<b: int, e: array<bigint>>>")
    return spark.range(1).select(F.inline(text)).select(F.col("b").alias(BLOCK), F.col("e").alias("__shard_ends"))


def shuffle_into_shards(
    rows: DataFrame, shards: int, seed: int = 17, shard: str | Column = "shard", slot: str = "slot"
) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard)."""
    spark = rows.sparkSession
    tagged = rows.withColumns(
        {BLOCK: F.spark_partition_id() % BLOCKS, FIRST: F.rand(seed), SECOND: F.rand(seed + 1)}
    )
    tagged = stage(tagged, "sharding")
    counts = {row[0]: row[1] for row in tagged.groupBy(BLOCK).count().orderBy(BLOCK).collect()}
    total = sum(counts.values())
    sizes = [total // shards + (i < total % shards) for i in range(shards)]
    matrix = dict(zip(counts, communication_matrix(list(counts.values()), sizes, seed)))
    # Ranked without the rows: what is kept is the last key of each (block, shard), as many numbers as the matrix has.
    key = F.struct(FIRST, SECOND)
    ranked = _ranked(tagged.select(BLOCK, FIRST, SECOND), BLOCK, FIRST, max(counts.values(), default=0), RANK)
    ranked = ranked.join(F.broadcast(_bounds(spark, matrix)), BLOCK)
    ranked = ranked.withColumn("to", F.size(F.filter("__shard_ends", lambda end: end <= F.col(RANK))))
    last = ranked.groupBy(BLOCK, "to").agg(F.max(key).alias("last"))
    cuts = last.groupBy(BLOCK).agg(F.sort_array(F.collect_list(F.struct("last", "to"))).alias("__shard_cuts"))
    # The rows then find their shard where they lie, and move once.
    sent = tagged.join(F.broadcast(stage(cuts, "sharding")), BLOCK)
    sent = sent.withColumn(shard, F.filter("__shard_cuts", lambda cut: key <= cut["last"])[0]["to"]).drop("__shard_cuts")
    done = _ranked(sent, shard, SECOND, max(sizes), slot)
    return done.select(*rows.columns, shard, F.col(slot).cast("long").alias(slot))


def write_shards(rows: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder per shard, rows in slot order inside each file."""
    rows.repartition(shard).sortWithinPartitions(shard, slot).write.partitionBy(shard).mode("overwrite").parquet(path)


def text_digests(text: str = "text", overhead: int = 16) -> dict[str, Column]:
    """UTF-8 bytes plus a fixed overhead, and the CRC-32 of the UTF-8 bytes (null: no bytes)."""
    data = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    return {"size": (F.octet_length(data) + overhead).cast("long"), "text_crc32": F.crc32(data)}
