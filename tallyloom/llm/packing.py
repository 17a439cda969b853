"""Concatenate and cut: all documents as one stream of ids, cut into windows of equal length.

Pass 1 encodes each document once and writes it with its task number and the ids before it in
that task. Pass 2 sums the tasks' totals into global offsets: task totals are summed inside groups of
tasks and over the groups, so even a million tasks need no large window. A document's place in the
stream is then known, and it is cut into pieces independently of all others: there is no shuffle of ids
and nothing depends on who holds the neighbours.

Only the last sequence can be shorter than the window, so padding is below one window for the
whole corpus. Null and empty texts are documents of one token, the end mark. Every piece carries its
boundary records: whether its document goes on before or after it. An empty table gives no pieces.
Repeated rows are separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.word_tokens import word_tokens
from tallyloom.sources.workspace import stage

WINDOW, END = 2048, 1
TASKS_PER_GROUP = 1024
PIECE_ROWS, PIECE_BYTES = 20_000, 1 << 24


def encoded_stream(docs: DataFrame, text: str, key: str, end: int = END, path: str | None = None) -> DataFrame:
    """``key, ids, n, task, before``: ids (little-endian unsigned 32 bits, with the end mark) and place in the task."""
    tail = np.array([end], dtype="<u4").tobytes()
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, ids binary, n long, task int, before long"
    kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int64()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, before = word_tokens(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [found + tail for found in encoder.ids(batch.column(1).to_pylist())]
            n = np.fromiter((len(x) // 4 for x in ids), dtype="int64", count=len(ids))
            start = before + np.cumsum(n) - n
            before += int(n.sum())
            columns = [ids, n, np.full(len(ids), task, dtype="int32"), start]
            arrays = [batch.column(0), *[pa.array(c, type=k) for c, k in zip(columns, kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "ids", "n", "task", "before"])
        encoder.forget()

    return docs.select(key, text).mapInArrow(encode, schema)


def task_offsets(stream: DataFrame) -> DataFrame:
    """``task, base``: ids of all earlier tasks. A row per task of the first pass."""
    totals = stream.groupBy("task").agg(F.sum("n").alias("total"))
    totals = totals.withColumn("team", F.floor(F.col("task") / TASKS_PER_GROUP))
    teams = totals.groupBy("team").agg(F.sum("total").alias("team_total"))
    earlier = Window.orderBy("team").rowsBetween(Window.unboundedPreceding, -1)
    teams = teams.select("team", F.coalesce(F.sum("team_total").over(earlier), F.lit(0)).alias("team_base"))
    inside = Window.partitionBy("team").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return (
        totals.withColumn("inside", F.coalesce(F.sum("total").over(inside), F.lit(0)))
        .join(teams, "team")
        .select("task", (F.col("team_base") + F.col("inside")).alias("base"))
    )


def cut(stream: DataFrame, key: str, window: int = WINDOW) -> DataFrame:
    """Pieces of every document, given its ``place`` in the whole stream."""
    kind = stream.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long,"
        " offset long, goes_back boolean, goes_on boolean"
    )
    names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset", "goes_back", "goes_on"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held, rows, took = batch.column(0), 0, [], []
            for i, (ids, place) in enumerate(zip(batch.column(1), batch.column(2).to_pylist())):
                ids = ids.as_buffer().to_pybytes() if hasattr(ids, "as_buffer") else ids.as_py()
                n, start = len(ids) // 4, 0
                while start < n:
                    sequence, offset = divmod(place + start, window)
                    length = min(window - offset, n - start)
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((start, length, part, n, sequence, offset, start > 0, start + length < n))
                    took.append(i)
                    start, held = start + length, held + len(part)
                    if len(rows) >= PIECE_ROWS or held >= PIECE_BYTES:
                        yield _batch(key, names, keys, took, rows)
                        held, rows, took = 0, [], []
            if rows:
                yield _batch(key, names, keys, took, rows)

    return stream.select(key, "ids", "place").mapInArrow(pieces, schema)


def _batch(key: str, names: list[str], keys: pa.Array, took: list[int], rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3, pa.bool_(), pa.bool_()]
    columns = [pa.array(column, type=kind) for column, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays([keys.take(pa.array(took, type=pa.int64())), *columns], names=[key, *names])


def pack(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    end: int = END,
    path: str | None = None,
) -> DataFrame:
    """Pieces with their ids: ``key, start, length, ids, doc_tokens, sequence_id, offset, goes_back, goes_on``."""
    stream = stage(encoded_stream(docs, text, key, end, path), "packing")
    # A row of 12 bytes per task of the first pass: a million tasks are 12 MB.
    placed = stream.join(F.broadcast(task_offsets(stream)), "task")
    placed = placed.select(key, "ids", (F.col("base") + F.col("before")).alias("place"))
    return cut(placed, key, window)
