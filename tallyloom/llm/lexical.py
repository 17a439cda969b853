"""Ranked lexical search by hashed max-sketches.

**Index.** A document is read once. Its terms are folded into a sketch of ``WIDTH`` coordinates: a term's hash picks the
coordinate, which keeps the largest count of the terms that fall on it. A term's impact on a score grows with its count
alone inside one document, so the largest count gives the largest impact; counts, not impacts, are kept, because
impacts need totals that are known only after this pass. Sketches are stored without their zeros, next to the exact terms
and counts.

**Search.** Queries go through the index in blocks of ``BLOCK`` items. For a chunk of documents all terms of the block are looked up in the sketches
at once; weighted and summed they bound every score from above, since no weight is negative. For each query the documents of the chunk are then
scored exactly in the order of falling bounds, until the bound can no longer reach the last of the best ``count`` found by the
task. Where to start is known from the exact scores of a sample of about ``SAMPLE`` documents: the last of its best is a floor that no
document of the result lies below, and which every task starts with. Nothing is dropped that could be in the result, so it is exact.

Tasks hand over at most ``count`` rows per query; texts and postings are not shuffled. The driver holds one block of items.

Null and empty texts have no term: such documents are not counted, such items get no rows. Equal scores go by ascending key, null keys last;
rows that repeat a key rank each on their own. Every item row is a query of its own. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import Known, gathered
from tallyloom.sources.workspace import stage

WIDTH, BEST, BLOCK, SAMPLE = 1 << 14, 10, 1024, 50_000
TERMS_KEPT, CELLS = 500_000, 1 << 21
NO_KEY = 2**63 - 1

#: A term is a run of ASCII letters and digits and of all characters beyond ASCII; only A-Z fold. In UTF-8 that is a rule on bytes.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or bytes([b]).isalnum() else 32 for b in range(256))


def terms_of(text: bytes | str | None) -> Counter:
    """Terms of the whole text with their counts."""
    data = text.encode() if isinstance(text, str) else text or b""
    return Counter(data.translate(_FOLD).split())


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """``key, n, places, tops, terms, counts`` of the documents that have a term, written. ``width`` is at most 65536."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sketch = Known(lambda term, _: zlib.crc32(term) % width), np.zeros(width, dtype=np.uint32)
        for batch in batches:
            rows, keys = [], []
            for i, text in enumerate(batch.column(1)):
                found = terms_of(text.as_buffer().to_pybytes() if text.is_valid else None)
                if not found:
                    continue
                known = known.renewed(TERMS_KEPT)
                at = np.fromiter(map(known.__getitem__, found), dtype=np.int64, count=len(found))
                counts = np.fromiter(found.values(), dtype=np.uint32, count=len(found))
                np.maximum.at(sketch, at, counts)
                places = np.flatnonzero(sketch)
                tops = sketch[places]
                sketch[places] = 0
                rows.append((int(counts.sum()), places.astype("<u2").tobytes(), tops.astype("<u4").tobytes(), b" ".join(found), counts.astype("<u4").tobytes()))
                keys.append(i)
            columns = zip(*rows) if rows else [[]] * 5
            arrays = [pa.array(c, pa.int64() if k == 0 else pa.binary()) for k, c in enumerate(columns)]
            taken = batch.column(0).take(pa.array(keys, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken, *arrays], names=["key", "n", "places", "tops", "terms", "counts"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n long, places binary, tops binary, terms binary, counts binary"
    return stage(docs.select(key, text).mapInArrow(work, schema), "lexical-index")


def document_counts(index: DataFrame, terms: list[bytes]) -> list[int]:
    """How many documents hold each of the terms."""
    number = {term: i for i, term in enumerate(terms)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            for each in batch.column(0):
                for term in number.keys() & each.as_buffer().to_pybytes().split(b" "):
                    held[number[term]] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at])], names=["term", "docs"])

    counted = index.select("terms").mapInArrow(work, "term int, docs long").groupBy("term").agg(F.sum("docs"))
    found = dict(counted.collect())
    return [found.get(i, 0) for i in range(len(terms))]


@dataclass
class Questions:
    """A block of queries: ``flat`` names the term of each (query, term) entry, ``weights`` its weight times repeats."""

    items: list
    terms: list[list[tuple[bytes, int]]]
    places: np.ndarray
    flat: np.ndarray
    weights: np.ndarray
    starts: np.ndarray
    width: int
    docs: int
    total: int


def _questions(index: DataFrame, block: list, width: int, docs: int, total: int) -> Questions | None:
    asked = [(item, found) for item, text in block if (found := terms_of(text))]
    if not asked:
        return None
    names = list(dict.fromkeys(term for _, found in asked for term in found))
    number = {term: i for i, term in enumerate(names)}
    weight = [math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1))) for df in document_counts(index, names)]
    terms = [[(term, weight[number[term]] * times) for term, times in found.items()] for _, found in asked]
    entries = [(number[term], w) for each in terms for term, w in each]
    sizes = [len(each) for each in terms]
    return Questions(
        [item for item, _ in asked], terms, np.array([zlib.crc32(term) % width for term in names]),
        np.array([t for t, _ in entries]), np.array([w for _, w in entries], dtype=np.int64), np.cumsum([0, *sizes[:-1]]),
        width, docs, total,
    )


def impact(count, norm):
    """What ``count`` occurrences add per unit of weight, in a document of norm ``norm``."""
    return (1_000_000_000 * count) // (1000 * count + 8 * norm)


def _scored(index: DataFrame, asked: Questions, count: int, floors: np.ndarray) -> DataFrame:
    """``query, score, key``: in every task the best rows of each query, none below its floor."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per query a sorted list of (-score, key), and the pair that a new one must come before.
        best = [[] for _ in asked.items]
        low, last = np.maximum(floors, 1), np.full(len(best), NO_KEY)
        sketch = np.zeros(asked.width, dtype=np.int64)
        rows_at_once = max(1, CELLS // max(1, len(asked.flat)))
        for batch in batches:
            for start in range(0, batch.num_rows, rows_at_once):
                _chunk(batch.slice(start, rows_at_once), asked, count, best, low, last, sketch)
        found = [(q, -score, None if key == NO_KEY else key) for q, each in enumerate(best) for score, key in each]
        arrays = [pa.array([row[k] for row in found], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["query", "score", "key"])

    columns = index.select(F.col("key").cast("long").alias("key"), "n", "places", "tops", "terms", "counts")
    return columns.mapInArrow(work, "query int, score long, key long")


def _chunk(batch, asked: Questions, count: int, best: list, low: np.ndarray, last: np.ndarray, sketch: np.ndarray) -> None:
    keys = batch.column(0).fill_null(NO_KEY).to_numpy()
    norms = np.array([25 + 75 * n * asked.docs // asked.total for n in batch.column(1).to_pylist()], dtype=np.int64)
    tops = np.zeros((len(keys), len(asked.places)), dtype=np.int64)
    for i, (places, values) in enumerate(zip(batch.column(2), batch.column(3))):
        at = np.frombuffer(places.as_buffer(), dtype="<u2")
        sketch[at] = np.frombuffer(values.as_buffer(), dtype="<u4")
        tops[i] = sketch[asked.places]
        sketch[at] = 0
    bounds = np.add.reduceat(impact(tops, norms[:, None])[:, asked.flat] * asked.weights, asked.starts, axis=1)
    open_ = (bounds > low) | ((bounds == low) & (keys[:, None] <= last))
    postings: dict[int, dict] = {}
    for q in np.flatnonzero(open_.any(axis=0)):
        rows = np.flatnonzero(open_[:, q])
        for i in rows[np.lexsort((keys[rows], -bounds[rows, q]))]:
            if bounds[i, q] < low[q]:
                break
            if i not in postings:
                names = batch.column(4)[int(i)].as_buffer().to_pybytes().split(b" ")
                postings[i] = dict(zip(names, np.frombuffer(batch.column(5)[int(i)].as_buffer(), dtype="<u4").tolist()))
            held, norm = postings[i], int(norms[i])
            score = sum(w * impact(held[term], norm) for term, w in asked.terms[q] if term in held)
            if score > low[q] or (score == low[q] and keys[i] <= last[q]):
                bisect.insort(best[q], (-score, int(keys[i])))
                del best[q][count:]
                if len(best[q]) == count:
                    low[q], last[q] = -best[q][-1][0], best[q][-1][1]


def _best(scored: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def search(
    index: DataFrame,
    items: DataFrame,
    item: str = "item_id",
    text: str = "text",
    key: str = "doc_id",
    count: int = BEST,
    width: int = WIDTH,
    sample: int = SAMPLE,
    block_items: int = BLOCK,
) -> DataFrame:
    """``item, rank, key, score``: the ``count`` best documents with a score above 0 for every row of ``items``.

    ``width`` must be the one the index was built with.
    """
    spark = index.sparkSession
    kind = items.schema[item].dataType.simpleString()
    docs, total = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    def blocks() -> Iterator[DataFrame]:
        for block in batched(items.select(item, text).toLocalIterator(), block_items):
            asked = _questions(index, block, width, docs, total) if docs else None
            if asked is None:
                continue
            floors = np.zeros(len(asked.items), dtype=np.int64)
            if docs > 4 * sample:
                some = _best(_scored(index.sample(sample / docs, 7), asked, count, floors), count)
                for query, floor in some.where(F.col("rank") == count).select("query", "score").collect():
                    floors[query] = floor
            numbered = spark.createDataFrame(list(enumerate(asked.items)), f"query int, `{item}` {kind}")
            found = _best(_scored(index, asked, count, floors), count).join(F.broadcast(numbered), "query")
            yield found.select(item, "rank", F.col("key").alias(key), "score")

    return gathered(spark, "lexical", blocks(), f"`{item}` {kind}, rank int, `{key}` long, score long")
