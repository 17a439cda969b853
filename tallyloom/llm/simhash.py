"""SimHash near-duplicates: fingerprints, and links of few differing bits by the general pigeonhole.

**Fingerprints.** ASCII capitals fold to small letters; words are runs of anything but the ASCII
white space; shingles of ``words`` words joined by single spaces are hashed with XXH64 (seed 42), with repeats.
A bit is 1 if it is set in over half of the hashes. A text of fewer words is one shingle; null, empty and blank
texts have fingerprint 0 and link like any other.

**Links.** If two fingerprints differ in at most T bits and the 64 positions are cut into parts with
thresholds t_i >= -1, sum of (t_i + 1) = T + 1, then in some part i with t_i >= 0 they differ in at most t_i bits.
The parts group bits that vary together, so that a part's values are as diverse as possible *between* the parts.
For every way of cutting, dynamic programming chooses the thresholds with the least estimated number of
candidates and probes; the cheapest cut wins. The estimate comes from a bounded sample of fingerprints
(``PLAN_ROWS``) and only steers cost: every plan finds every link.

Each distinct fingerprint is one row with the smallest id that has it, so copies cost nothing. It is put in the bucket of
its own value of each part and, where t_i = 1 or more, probes the buckets of all values at that distance. Buckets
are compared in tasks, hot ones in cells (see ``buckets``), and give at most one edge per row: a spanning forest, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.buckets import Forest, compare_buckets, neighbours_in_bucket, split_hot
from tallyloom.llm.components import connected_components
from tallyloom.sources.workspace import stage

SEED, BITS = 42, 64
SHINGLE, MOST_BITS = 3, 3
PLAN_ROWS = 2048
PART_CHOICES = (2, 3, 4, 5, 6)
HASHES_AT_ONCE = 1 << 16


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of all word shingles, in bounded arrays."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return
    joined = b" ".join(found)
    if len(found) <= words:
        yield np.array([digest(joined, SEED)], dtype=np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(found) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    for at in range(0, len(starts), HASHES_AT_ONCE):
        part = zip(starts[at : at + HASHES_AT_ONCE], ends[at : at + HASHES_AT_ONCE])
        yield np.array([digest(joined[a:b], SEED) for a, b in part], dtype=np.uint64)


def fingerprint_of(text: str | None, words: int = SHINGLE) -> int:
    """The 64-bit fingerprint as a signed long."""
    total, counts = 0, np.zeros(BITS, dtype=np.int64)
    for hashes in shingle_hashes(text, words):
        total += len(hashes)
        rows = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    ones = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view("<i8")[0])


def fingerprint(text: Column | str, words: int = SHINGLE) -> Column:
    """Fingerprint column (signed long) of a text column."""
    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(text, words) for text in texts.tolist()], dtype="int64")

    return fingerprints(text)


def fingerprint_hex(value: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def correlated_parts(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the positions into equal parts, each grown from the bits most correlated with what it holds."""
    centred = bits - bits.mean(axis=0)
    scale = np.sqrt((centred**2).sum(axis=0))
    scale[scale == 0] = 1
    likeness = np.abs(centred.T @ centred) / np.outer(scale, scale)
    left, cuts = list(range(BITS)), []
    for width in (BITS * (i + 1) // parts - BITS * i // parts for i in range(parts)):
        grown = [left.pop(int(np.argmax(likeness[np.ix_(left, left)].sum(axis=1))))]
        while len(grown) < width:
            grown.append(left.pop(int(np.argmax(likeness[np.ix_(left, grown)].mean(axis=1)))))
        cuts.append(sorted(grown))
    return cuts


def thresholds(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Least total of ``costs[i][t_i + 1]`` with sum of (t_i + 1) = budget."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for steps, more in enumerate(row):
                total = used + steps
                if total <= budget and (total not in new or cost + more < new[total][0]):
                    new[total] = (cost + more, [*chosen, steps - 1])
        best = new
    return best.get(budget, (float("inf"), []))


def make_plan(sample: np.ndarray, rows: int, most_bits: int) -> list[tuple[list[int], int]]:
    """Parts with their thresholds, skipped parts left out. ``sample``: fingerprints as unsigned 64 bits."""
    if len(sample) < 2:
        sample = np.arange(2, dtype=np.uint64)
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    bits = bits.astype(np.float64)
    pairs = rows * rows / 2
    best = (float("inf"), [])
    for parts in PART_CHOICES:
        cuts, costs = correlated_parts(bits, parts), []
        for cut in cuts:
            held = bits[:, cut]
            apart = held @ (1 - held).T
            apart = np.rint(apart + apart.T)[np.triu_indices(len(held), 1)]
            near = np.bincount(apart.astype(int), minlength=most_bits + 1)[: most_bits + 1].cumsum()
            # A probe is a shuffled row, about as dear as fifty comparisons; the sample never proves "no candidates".
            share = (near + 0.5) / len(apart)
            probes = np.cumsum([comb(len(cut), k) for k in range(most_bits + 1)])
            costs.append([0.0, *(share * pairs + 50.0 * rows * (probes + (probes > 1)))])
        cost, chosen = thresholds(costs, most_bits + 1)
        if cost < best[0]:
            best = (cost, [(cut, t) for cut, t in zip(cuts, chosen) if t >= 0])
    return best[1]


def bucket_rows(prints: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """``bucket, node, probe``: every fingerprint under its own values and, as a probe, under close ones."""
    moves = []
    for number, (cut, t) in enumerate(plan):
        mask = sum(1 << b for b in cut)
        flips = [sum(1 << b for b in chosen) for k in range(1, t + 1) for chosen in combinations(cut, k)]
        moves.append((number, mask, np.array([0, *flips], dtype=np.uint64)))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                nodes = batch.column(0).slice(start, 2048).to_numpy().view(np.uint64)
                for number, mask, flips in moves:
                    values = (nodes & np.uint64(mask))[:, None] ^ flips[None, :]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(values.size, number, dtype=np.int32)),
                            pa.array(values.ravel().view(np.int64)),
                            pa.array(np.repeat(nodes, len(flips)).view(np.int64)),
                            pa.array(np.tile(np.arange(len(flips)) > 0, len(nodes))),
                        ],
                        names=["part", "value", "node", "probe"],
                    )

    rows = prints.select("node").mapInArrow(keys, "part int, value long, node long, probe boolean")
    return rows.select(F.xxhash64("part", "value").alias("bucket"), "node", "probe")


def close_edges(rows: DataFrame, most_bits: int) -> DataFrame:
    """``src, dst``: in every bucket a spanning forest of the rows within ``most_bits`` of each other."""

    def compare(table: pa.Table) -> pa.RecordBatch:
        buckets = table.column("bucket").to_numpy()
        nodes = table.column("node").to_numpy()
        probe = table.column("probe").to_numpy()
        values, forest = nodes.view(np.uint64), Forest(len(nodes))
        for i, distance in neighbours_in_bucket(buckets):
            j = i + distance
            near = (np.bitwise_count(values[i] ^ values[j]) <= most_bits) & ~(probe[i] & probe[j])
            if near.any():
                forest.link(i[near], j[near])
        moved, first = forest.edges()
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[first])], names=["src", "dst"])

    return compare_buckets(split_hot(rows, "node"), compare, "src long, dst long")


def linked_fingerprints(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``node, component`` for the fingerprints (distinct longs in ``node``) that have a link."""
    sample = prints.orderBy(F.xxhash64("node")).limit(PLAN_ROWS).toPandas()["node"]
    plan = make_plan(sample.to_numpy(dtype=np.int64).view(np.uint64), prints.count(), most_bits)
    return connected_components(close_edges(bucket_rows(prints, plan), most_bits))


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = SHINGLE, most_bits: int = MOST_BITS
) -> DataFrame:
    """``key, fingerprint (long), component_id`` per row; the component is the smallest key that links reach.

    Repeated keys and texts are ordinary rows. A null key keeps its row and never names a component
    unless all rows of the component lack one.
    """
    rows = stage(docs.select(F.col(key).alias("key"), fingerprint(text, words).alias("node")), "simhash")
    prints = stage(rows.groupBy("node").agg(F.min("key").alias("least")), "simhash")
    linked = stage(linked_fingerprints(prints.select("node"), most_bits), "simhash")
    placed = prints.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    owners = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.join(owners, "component").select("node", "component_id")
    return rows.join(placed, "node").select(
        F.col("key").alias(key), F.col("node").alias("fingerprint"), "component_id"
    )
