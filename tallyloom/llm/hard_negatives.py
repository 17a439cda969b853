"""Hard negatives by angular triangle filtering.

**Stored.** Components become whole numbers (``SCALE`` times the value, rounded down). Every vector keeps its length and its
angles to ``DIRECTIONS`` reference directions, fitted on a bounded sample of ``SAMPLE`` vectors. Rows are laid out by the direction they are nearest to and by the angle to
it, so that rows that are read together point the same way.

**Filter.** Angles obey the triangle inequality: two vectors at angles s and t to one direction are at least ``|s - t|`` and at most
``min(s + t, 2 pi - s - t)`` apart. The narrowest interval over all directions bounds the cosine, and times both
lengths the score. ``SLACK`` of both lengths and one more unit are added on either side, far above what rounding
can shift, so the bounds always hold. Chunks whose range of angles cannot reach an anchor's window are passed over whole, then rows; what overlaps a window is scored in whole numbers.

**Two searches.** Anchors come in blocks of ``BLOCK``. First their positives: the window is open above, and its lower end rises with the
last of the best found. Then the negatives of every positive: the window lies between two shares of the positive's score,
and its lower end rises likewise. Both start from a floor that a sample of ``FLOOR_SAMPLE`` rows gives; no result lies below it. Results are exact.

Tasks hand over at most ``count`` rows per window; vectors are shuffled once, for the layout. The driver holds one block of anchors.

Rows take no part if the label or vector is null, a component is null or not finite, or the width is not the most common one.
A vector that is all zero takes part and scores 0. Rows with an anchor's own id are not among its positives or negatives. Equal scores go by ascending id,
null ids last; repeated rows count each, repeated anchors give their rows each. A score that may not fit a long (lengths of 2**31 units on) is an error.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import gathered
from tallyloom.llm.vectors import common_width, matrix
from tallyloom.sources.workspace import stage

SCALE, POSITIVES, NEGATIVES, LEAST, MOST = 256, 5, 10, 30, 90
DIRECTIONS, SAMPLE, STEPS = 16, 2048, 12
BLOCK, FLOOR_SAMPLE, ROWS = 1024, 8192, 2048
SLACK, LONGEST = 1e-6, 2**31
NO_ID = 2**63 - 1


def directions_of(vectors: np.ndarray, count: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors in the middle of groups of the sample's directions."""
    size = np.linalg.norm(vectors, axis=1)
    unit = vectors[size > 0] / size[size > 0, None]
    unit = np.unique(unit, axis=0)
    if not len(unit):
        return np.eye(1, vectors.shape[1])
    draw = np.random.default_rng(13)
    found = unit[draw.choice(len(unit), min(count, len(unit)), replace=False)]
    for _ in range(STEPS):
        own = (unit @ found.T).argmax(axis=1)
        sums = np.stack([unit[own == k].sum(axis=0) for k in range(len(found))])
        length = np.linalg.norm(sums, axis=1)
        found = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], found)
    return found


def angles(vectors: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and angles to the directions (a right angle for the zero vector)."""
    size = np.linalg.norm(vectors, axis=1)
    cosine = (vectors @ directions.T) / np.where(size > 0, size, 1)[:, None]
    return size, np.arccos(np.clip(cosine, -1, 1))


def score_bounds(own, own_size, least, most, small, large) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of anchors (rows) with vectors (columns).

    ``own`` holds the anchors' angles; ``least`` and ``most`` bound the vectors' angles, ``small`` and ``large`` their lengths.
    """
    near = np.zeros((len(own), len(least)))
    far = np.full(near.shape, np.pi)
    for r in range(own.shape[1]):
        t, low, high = own[:, r, None], least[None, :, r], most[None, :, r]
        np.maximum(near, np.maximum(low - t, t - high), out=near)
        np.minimum(far, np.minimum(t + high, 2 * np.pi - t - low), out=far)
    top, bottom = np.cos(near), np.cos(np.maximum(far, near))
    slack = SLACK * own_size[:, None] * large[None, :] + 1
    upper = own_size[:, None] * np.where(top > 0, large, small)[...] * top + slack
    lower = own_size[:, None] * np.where(bottom > 0, small, large)[...] * bottom - slack
    return lower, upper


@dataclass
class Windows:
    """What is wanted: for each window its anchor, the scores it spans, and whether labels must be equal or differ."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    sizes: np.ndarray
    angles: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    count: int


def _scan(stored: DataFrame, wanted: Windows) -> DataFrame:
    """``window, score, id``: in every task the best rows of each window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = [np.zeros(0, dtype=np.int64) for _ in wanted.anchor]
        ids = [np.zeros(0, dtype=np.int64) for _ in wanted.anchor]
        low = wanted.low.copy()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                _chunk(batch.slice(start, ROWS), wanted, low, scores, ids)
        window = np.repeat(np.arange(len(scores)), [len(s) for s in scores])
        score, found = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (scores, ids))
        arrays = [pa.array(window, pa.int32()), pa.array(score), pa.array(found, pa.int64(), mask=found == NO_ID)]
        yield pa.RecordBatch.from_arrays(arrays, names=["window", "score", "id"])

    return stored.select("id", "label", "vector", "size", "angles").mapInArrow(work, "window int, score long, id long")


def _chunk(batch: pa.RecordBatch, wanted: Windows, low: np.ndarray, scores: list, ids: list) -> None:
    own_ids, labels = batch.column(0).fill_null(NO_ID).to_numpy(), batch.column(1).to_numpy()
    size, turned = batch.column(3).to_numpy(), matrix(batch.column(4), wanted.angles.shape[1])
    # The span of all windows of an anchor, as it is now; anchors without a window span nothing.
    floor, roof = np.full(len(wanted.ids), np.inf), np.full(len(wanted.ids), -np.inf)
    np.minimum.at(floor, wanted.anchor, low)
    np.maximum.at(roof, wanted.anchor, wanted.high)
    span = (turned.min(axis=0)[None], turned.max(axis=0)[None], size.min()[None], size.max()[None])
    lower, upper = score_bounds(wanted.angles, wanted.sizes, *span)
    anchors = np.flatnonzero((upper[:, 0] >= floor) & (lower[:, 0] <= roof))
    if not len(anchors):
        return
    lower, upper = score_bounds(wanted.angles[anchors], wanted.sizes[anchors], turned, turned, size, size)
    open_ = (upper >= floor[anchors, None]) & (lower <= roof[anchors, None])
    open_ &= (wanted.labels[anchors, None] == labels) == wanted.same
    open_ &= wanted.ids[anchors, None] != own_ids
    rows, some = np.flatnonzero(open_.any(axis=0)), np.flatnonzero(open_.any(axis=1))
    if not len(rows):
        return
    # Whole numbers below 2**53 are exact as doubles, and so are their sums in any order.
    exact = np.float64 if wanted.sizes.max() * size.max() < 2**52 else np.int64
    vectors = matrix(batch.column(2), wanted.vectors.shape[1]).astype(exact)
    made = wanted.vectors[anchors[some]].astype(exact) @ vectors[rows].T
    place = {anchor: i for i, anchor in enumerate(anchors[some])}
    open_, own_ids = open_[np.ix_(some, rows)], own_ids[rows]
    for k in np.flatnonzero(np.isin(wanted.anchor, anchors[some])):
        i = place[wanted.anchor[k]]
        fit = np.flatnonzero(open_[i] & (made[i] >= low[k]) & (made[i] <= wanted.high[k]))
        if len(fit):
            score = np.concatenate([scores[k], made[i, fit].astype(np.int64)])
            found = np.concatenate([ids[k], own_ids[fit]])
            best = np.lexsort((found, -score))[: wanted.count]
            scores[k], ids[k] = score[best], found[best]
            if len(best) == wanted.count:
                low[k] = max(low[k], scores[k][-1])


def _best(scanned: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("window").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return scanned.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _with_floors(stored: DataFrame, share: float, wanted: Windows) -> Windows:
    """Windows whose lower ends rise to the last of the best among some rows."""
    if share < 0.25:
        last = _best(_scan(stored.sample(share, 11), wanted), wanted.count).where(F.col("rank") == wanted.count)
        for row in last.select("window", "score").collect():
            wanted.low[row[0]] = max(wanted.low[row[0]], row[1])
    return wanted


def prepare(rows: DataFrame, asked: Column, vector: str, key: str, label: str) -> tuple[DataFrame, int]:
    """``id, label, vector, asked, size, angles`` of the rows that take part, laid out by direction, and the width."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"))
    rows = rows.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), whole.alias("vector"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
    )
    width = common_width(rows, "vector")
    rows = rows.where(F.size("vector") == width)
    sample = rows.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE).toPandas()
    directions = directions_of(np.array(sample["vector"].tolist(), dtype=np.float64).reshape(-1, max(1, width)))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, turned = angles(matrix(batch.column(2), width), directions)
            if (size >= LONGEST).any():
                raise ValueError(f"a vector is longer than {LONGEST} units: its scores may not fit a long")
            near = turned.argmin(axis=1) if len(size) else np.zeros(0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * len(directions)), pa.array(turned.ravel()))
            arrays = [*batch.columns, pa.array(size), lists, pa.array(near, pa.int32()), pa.array(turned.min(axis=1, initial=np.pi))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "size", "angles", "near", "angle"])

    schema = "id long, label long, vector array<double>, asked boolean, size double, angles array<double>, near int, angle double"
    turned = rows.mapInArrow(turn, schema).withColumn("row", F.monotonically_increasing_id())
    # The row number parts equal vectors, however many there are.
    laid = turned.repartitionByRange("near", "angle", "row").sortWithinPartitions("near", "angle").drop("near", "angle", "row")
    return stage(laid, "hard-negatives"), width


def mine(
    rows: DataFrame,
    anchors: Column,
    vector: str = "embedding",
    key: str = "vec_id",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    floor_sample: int = FLOOR_SAMPLE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``anchors`` holds for."""
    spark = rows.sparkSession
    stored, width = prepare(rows, anchors, vector, key, label)
    share = floor_sample / max(1, stored.count())
    columns = stored.where("asked").select("id", "label", "vector", "size", "angles")

    def blocks() -> Iterator[DataFrame]:
        for block in batched(columns.toLocalIterator(), BLOCK):
            own = [np.array([row[k] for row in block]) for k in range(1, 5)]
            own_ids = np.array([NO_ID if row[0] is None else row[0] for row in block])
            every = np.arange(len(block))
            open_above = Windows(own_ids, *own, every, np.full(len(block), -NO_ID), np.full(len(block), NO_ID), True, positives)
            found = _best(_scan(stored, _with_floors(stored, share, open_above)), positives).orderBy("window", "rank").collect()
            # (anchor, positive) pairs of one block; integer shares of the score, rounded inwards.
            score = np.array([row["score"] for row in found], dtype=object)
            low, high = -((-least * score) // 100), (most * score) // 100
            pairs = [row for row, a, b in zip(found, low, high) if a <= b]
            if not pairs:
                continue
            at = np.array([row["window"] for row in pairs])
            span = (low[low <= high].astype(np.int64), high[low <= high].astype(np.int64))
            between = _with_floors(stored, share, Windows(own_ids, *own, at, *span, False, negatives))
            named = [(k, block[row["window"]][0], row["id"], row["score"]) for k, row in enumerate(pairs)]
            named = spark.createDataFrame(named, "window int, anchor_id long, positive_id long, positive_score long")
            result = _best(_scan(stored, between), negatives).join(F.broadcast(named), "window")
            yield result.select(
                "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"),
            )

    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return gathered(spark, "hard-negatives", blocks(), schema)
