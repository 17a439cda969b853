"""Where a user's own Python runs: a predictor (U1) or a codec (U2), in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

# Texts for one batch of rows.
Predictor = Callable[[pd.DataFrame], Sequence[str]]
# Bytes to bytes; raises for a payload it cannot read.
Transcode = Callable[[bytes], bytes]

# Rows per Arrow batch when rows carry images.
IMAGE_ROWS = 64
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """Rows per Arrow batch for the jobs started inside; image rows need small batches."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


def score_batches(
    rows: DataFrame,
    load: Callable[[], Predictor],
    answer: str = "raw_output",
    batch_rows: int = 8,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the text a predictor generates for each row.

    ``load`` runs once per task and returns the predictor, which is called with ``batch_rows``
    rows at a time, however large the Arrow batches are. Only ``keep`` columns (default: all)
    travel back from Python; leave image bytes out.
    """
    kept = list(rows.columns if keep is None else keep)
    schema = StructType([*[rows.schema[name] for name in kept], StructField(answer, StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for batch in batches:
            texts: list[str] = []
            for start in range(0, len(batch), batch_rows):
                texts.extend(predict(batch.iloc[start : start + batch_rows]))
            yield batch[kept].assign(**{answer: texts})

    return rows.mapInPandas(run, schema)


def transcode_batches(
    rows: DataFrame,
    transcode: Transcode,
    payload: str = "payload",
    keep: Sequence[str] = (),
    store: Callable[[str, bytes], None] | None = None,
    path: str | None = None,
    fetch: Callable[[Sequence[str]], bytes] | None = None,
    places: str = "places",
) -> DataFrame:
    """Run ``transcode`` over payload bytes; failures become error texts, never exceptions.

    Without ``store`` the result holds the bytes. With it, each output is handed to
    ``store(row[path], bytes)`` inside the task, and the result holds sizes only. Stores must
    accept the same output twice, since tasks are retried. ``fetch`` opens a file for rows that name it by ``places``, an array of
    paths, one row at a time: what is read is what rows ask for. A payload in the row serves where no file does.
    """
    fields = [field for field in rows.schema.fields if field.name in keep]
    fields += [StructField("n_bytes", LongType()), StructField("error", StringType())]
    if store is None:
        fields.append(StructField("output", BinaryType()))
    schema = StructType(fields)
    wanted = [*keep, payload] if path is None or path in keep else [*keep, path, payload]
    wanted += [] if fetch is None else [places]

    def one(data: bytes | None, target: str | None, named: Sequence[str] | None) -> tuple[int | None, str | None, bytes | None]:
        try:
            if named is not None and len(named):
                try:
                    data = fetch(named)
                except FileNotFoundError:
                    if data is None:
                        raise
            if data is None:
                raise ValueError("no payload")
            output = transcode(bytes(data))
            if store is not None:
                store(target, output)
            return len(output), None, output
        except Exception as problem:  # the hook may raise anything; the row is reported, not lost
            return None, f"{type(problem).__name__}: {problem}", None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            targets = batch[path] if path is not None else [None] * len(batch)
            named = batch[places] if fetch is not None else [None] * len(batch)
            done = [one(*row) for row in zip(batch[payload], targets, named)]
            out = batch[list(keep)].assign(
                n_bytes=pd.array([size for size, _, _ in done], dtype="Int64"),
                error=[error for _, error, _ in done],
            )
            yield out if store is not None else out.assign(output=[output for _, _, output in done])

    return rows.select(*wanted).mapInPandas(run, schema)
