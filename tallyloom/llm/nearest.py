"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

**Index.** The tree is fitted on a bounded sample (``SAMPLE`` rows by hash), split ``BRANCHES`` ways per level until a node
holds at most ``LEAF_SAMPLE`` sample rows. Every row is then put in the leaf it descends to; the tree is a few hundred
centres, whatever the data.

**Search.** A query walks the tree through a priority queue: the nearest branch seen so far is opened next, which gives the
order in which it would visit the leaves. How many leaves to visit is calibrated: for ``CALIBRATION`` sample rows the
true neighbours over *all* rows are found by brute force, and the visits are widened until their leaves hold ``RECALL`` of them.
Queries then meet the rows of their leaves. Leaves of many rows are dealt into chunks and queries into blocks, so no
task holds an unbounded leaf or query set. Distances are computed on the original vectors in double precision.

Rows whose vector is null, zero, not finite or of an uncommon width take no part. Equal rows are one query; as
candidates they count each. A query's own row is known by its id. Ties go to the smaller id, null ids last.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.vectors import common_width, matrix, usable
from tallyloom.sources.workspace import stage

SAMPLE, LEAF_SAMPLE, BRANCHES, STEPS = 8192, 64, 8, 12
CALIBRATION, RECALL = 64, 0.97
CHUNK_ROWS, QUERY_BLOCK = 8192, 65_536
NEAREST = 10


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


class Tree:
    """Nodes as arrays: the centres of each node's children, and whether a child is a leaf."""

    def __init__(self, sample: np.ndarray, seed: int = 3):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves, draw = 0, np.random.default_rng(seed)
        self.root = self._grow(sample, draw)

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, rows: np.ndarray, draw: np.random.Generator) -> int:
        if len(rows) <= LEAF_SAMPLE:
            return self._leaf()
        centres = rows[draw.choice(len(rows), BRANCHES, replace=False)]
        for _ in range(STEPS):
            own = squared(rows, centres).argmin(axis=1)
            centres = np.stack([rows[own == k].mean(axis=0) for k in range(len(centres)) if (own == k).any()])
        own = squared(rows, centres).argmin(axis=1)
        if len(np.unique(own)) < 2:
            return self._leaf()
        number = len(self.centres)
        self.centres.append(centres)
        self.children.append([])
        self.children[number] = [self._grow(rows[own == k], draw) for k in range(len(centres))]
        return number

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf (from 0) each row descends to."""
        at = np.full(len(rows), self.root)
        while (at >= 0).any():
            for node in np.unique(at[at >= 0]):
                here = np.flatnonzero(at == node)
                nearest = squared(rows[here], self.centres[node]).argmin(axis=1)
                at[here] = np.array(self.children[node])[nearest]
        return -at - 1

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first."""
        queue = [(0.0, self.root)]
        while queue:
            _, node = heapq.heappop(queue)
            if node < 0:
                yield -node - 1
                continue
            for distance, child in zip(squared(query[None, :], self.centres[node])[0], self.children[node]):
                heapq.heappush(queue, (float(distance), child))


def nearest_rows(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray, count: int):
    """Exact nearest rows of each query in double precision: (query, row, distance), ties to the smaller id."""
    picked, places, scores = [], [], []
    for start in range(0, len(queries), 256):
        some = queries[start : start + 256]
        rough = squared(some, rows)
        for k, line in enumerate(rough):
            line[ids == own[start + k]] = np.inf
            if len(line) > count:
                bound = np.partition(line, count - 1)[count - 1]
                near = np.flatnonzero(line <= bound + 1e-9 * (1 + bound))
            else:
                near = np.arange(len(line))
            near = near[np.isfinite(line[near])]
            exact = np.sqrt(((rows[near] - some[k]) ** 2).sum(axis=1))
            best = np.lexsort((ids[near], exact))[:count]
            picked.append(np.full(len(best), start + k))
            places.append(near[best])
            scores.append(exact[best])
    if not picked:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return np.concatenate(picked), np.concatenate(places), np.concatenate(scores)


def calibrate(indexed: DataFrame, tree: Tree, sample: pd.DataFrame, width: int, count: int, recall: float) -> int:
    """Leaf visits that hold ``recall`` of the true neighbours of some sample rows over all rows."""
    chosen = sample.iloc[:: max(1, len(sample) // CALIBRATION)].head(CALIBRATION)
    queries, own = np.array(chosen["vector"].tolist(), dtype=np.float64), chosen["key"].to_numpy()

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows, ids = matrix(batch.column(1), width), batch.column(0).to_numpy(zero_copy_only=False)
                query, place, score = nearest_rows(queries, rows, ids, own, count)
                leaf = batch.column(2).to_numpy()[place]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(score), pa.array(leaf, pa.int32())], names=["query", "score", "leaf"]
                )

    found = indexed.select("key", "vector", "leaf").mapInArrow(brute, "query long, score double, leaf int")
    first = F.row_number().over(Window.partitionBy("query").orderBy("score", "leaf"))
    true = found.withColumn("rank", first).where(F.col("rank") <= count).toPandas()
    needed = []
    for query, part in true.groupby("query"):
        order = {leaf: visit for visit, leaf in enumerate(tree.visits(queries[query]), 1)}
        needed.extend(order[leaf] for leaf in part["leaf"])
    if not needed:
        return tree.leaves
    return int(np.quantile(needed, recall, method="higher"))


def search(
    rows: DataFrame,
    queries: Column,
    vector: str = "embedding",
    key: str = "vec_id",
    count: int = NEAREST,
    recall: float = RECALL,
) -> DataFrame:
    """``query_id, rank, key, score`` for the rows of the same table that ``queries`` holds for."""
    asked = F.coalesce(queries, F.lit(False))
    rows = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector"), asked.alias("asked"))
    rows = rows.where(usable("vector"))
    width = common_width(rows, "vector")
    rows = rows.where(F.size("vector") == width)
    sample = rows.where(F.col("key").isNotNull()).orderBy(F.xxhash64("vector", "key")).limit(SAMPLE).toPandas()
    tree = Tree(np.array(sample["vector"].tolist(), dtype=np.float64).reshape(-1, max(1, width)))

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = tree.leaf_of(matrix(batch.column(1), width)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaves.astype(np.int32))], names=["key", "vector", "asked", "leaf"]
            )

    kind = rows.schema["vector"].dataType.simpleString()
    indexed = stage(rows.mapInArrow(descend, f"key long, vector {kind}, asked boolean, leaf int"), "nearest")
    visits = calibrate(indexed, tree, sample, width, count, recall) if len(sample) else 1

    # One row per leaf of the tree, which is bounded.
    sizes = indexed.groupBy("leaf").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks"))
    asking = indexed.where("asked").select(F.col("key").alias("query"), "vector").dropDuplicates()
    blocks = max(1, -(-asking.count() // QUERY_BLOCK))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                order = [tree.visits(query) for query in matrix(part.column(1), width)]
                leaves = [[leaf for leaf, _ in zip(each, range(visits))] for each in order]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(leaves, pa.list_(pa.int32()))], names=["query", "vector", "leaves"]
                )

    walked = asking.mapInArrow(walk, f"query long, vector {kind}, leaves array<int>")
    block = F.pmod(F.xxhash64("query", "vector"), F.lit(blocks)).cast("int").alias("block")
    uid = F.xxhash64("query", "vector").alias("uid")
    walked = walked.select(uid, "query", "vector", block, F.explode("leaves").alias("leaf")).join(F.broadcast(sizes), "leaf")
    walked = walked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    spread = F.pmod(F.xxhash64("key", "vector"), F.col("chunks")).cast("int").alias("chunk")
    stored = indexed.join(F.broadcast(sizes), "leaf").select("leaf", spread, "key", "vector")
    stored = stored.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["uid", "query", "key", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=names).astype({"uid": "int64", "query": "int64", "key": "Int64", "score": float})
        points = np.array(left["vector"].tolist(), dtype=np.float64)
        ids = right["key"].to_numpy(dtype=np.float64, na_value=np.inf) if right["key"].isna().any() else right["key"].to_numpy()
        found, place, score = nearest_rows(
            points, np.array(right["vector"].tolist(), dtype=np.float64), ids, left["query"].to_numpy(), count
        )
        return pd.DataFrame(
            {
                "uid": left["uid"].to_numpy()[found],
                "query": left["query"].to_numpy()[found],
                "key": right["key"].to_numpy()[place],
                "score": score,
            }
        )

    at = ["leaf", "chunk", "block"]
    found = walked.groupBy(at).cogroup(stored.groupBy(at)).applyInPandas(meet, "uid long, query long, key long, score double")
    rank = F.row_number().over(Window.partitionBy("uid").orderBy("score", F.col("key").asc_nulls_last()))
    found = found.withColumn("rank", rank).where(F.col("rank") <= count)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("key").alias(key), "score")
