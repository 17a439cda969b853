"""Groups of near copies: SimHash fingerprints first, every link checked by the exact Jaccard similarity of word shingles.

**Fingerprints.** ``simhash.near_duplicates`` groups the rows by fingerprints of few differing bits. Of each of its groups the texts
meet in cells with the group's first text and are linked where the check holds, so a group costs what its rows cost.

**Bands.** Fingerprints of pairs near the bound differ in more bits than can be looked up; bands find what is left.
A text is the set of its shingles' hashes (see ``simhash``). ``BANDS`` hashes of ``BAND_ROWS`` minima each
put it into buckets: sets of similarity s share none with probability (1 - s^BAND_ROWS)^BANDS, which is 0.0002 for 16 bands of
4 at s = 0.8 and less above. A bit threshold with a recall of 0.99 at 0.8 would be 17 of 64 (a bit differs with probability
acos(2s / (1 + s)) / pi = 0.15), where the pigeonhole parts compare about every pair of texts; buckets grow with the rows.

**Check.** Every link is checked by the whole sets, so none joins texts of less than ``LEAST_TENTHS``. Bands are taken in a few rounds
(``BAND_ROUNDS``). In a round only buckets whose texts are not all in one group yet are compared, and of buckets with the same
members one; most copies are joined by their fingerprints, so their sets are sent to one comparison and not to sixteen. Only texts of such
buckets are read again. Equal sets are one node, so copies cost nothing, and each bucket gives a spanning forest, not pairs. Hot buckets are
compared in cells (see ``buckets``).

Texts without a word have the empty set and are copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.buckets import CELL, compare_buckets, split_hot
from tallyloom.llm.common import marked_rows
from tallyloom.llm.components import connected_components
from tallyloom.llm.simhash import near_duplicates, shingle_hashes
from tallyloom.sources.workspace import stage

#: Least similarity of near copies, in tenths, so that the check is in whole numbers.
LEAST_TENTHS = 8
BANDS, BAND_ROWS = 16, 4
BAND_ROUNDS = ((0, 1), (1, 3), (3, 8), (8, BANDS))
# Bytes of sets handed over at once.
SENT_BYTES = 1 << 24


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes."""
    parts = [np.unique(part) for part in shingle_hashes(text, words)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)


def _constants() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(23)
    flip = draw.integers(0, 2**64, BANDS * BAND_ROWS, dtype=np.uint64)
    return flip, draw.integers(0, 2**64, BANDS * BAND_ROWS, dtype=np.uint64) | np.uint64(1)


def bands_of(hashes: np.ndarray, constants: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One hash per band of minima; none for the empty set."""
    import xxhash

    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    least = np.full(BANDS * BAND_ROWS, 2**64 - 1, dtype=np.uint64)
    for start in range(0, len(hashes), 1024):
        part = hashes[start : start + 1024]
        mixed = (part[None, :] ^ constants[0][:, None]) * constants[1][:, None]
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(axis=1))
    rows = least.astype("<u8").reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(rows)], dtype=np.uint64).view(np.int64)


def _sketches(rows: DataFrame, words: int) -> DataFrame:
    """``row, print, bands`` of (row, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        constants = _constants()
        for batch in batches:
            sets = (shingle_set(text.as_py(), words) for text in batch.column(1))
            made = [(xxhash.xxh128_digest(s.astype("<u8").tobytes()), bands_of(s, constants)) for s in sets]
            prints, bands = pa.array([p for p, _ in made], pa.binary()), pa.array([b for _, b in made], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), prints, bands], names=["row", "print", "bands"])

    return rows.mapInArrow(work, "row long, print binary, bands array<long>")


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """``bucket, node, hashes`` of (node, text, buckets): a set for each comparison its text takes part in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = [], 0
        for batch in batches:
            for node, text, buckets in zip(batch.column(0), batch.column(1), batch.column(2)):
                data = shingle_set(text.as_py(), words).astype("<u8").tobytes()
                for bucket in buckets.as_py():
                    made.append((bucket, node.as_py(), data))
                    held += len(data) + 64
                    if held >= SENT_BYTES:
                        yield _set_rows(made)
                        made, held = [], 0
        yield _set_rows(made)

    return rows.mapInArrow(work, "bucket long, node long, hashes binary")


def _set_rows(made: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array([row[k] for row in made], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "node", "hashes"])


def similar_forest(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of the pairs whose similarity reaches the least one."""
    left, right = [], []
    sizes = np.array([len(s) for s in sets])
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    known = np.zeros(len(values), dtype=np.int32)
    rest, waiting = np.arange(len(sets)), []
    flat, at = codes, starts
    while len(rest):
        if not waiting:
            waiting, first = [rest[0]], 0
            rest, flat, at = _without(rest, np.arange(len(rest)) == first, flat, at, sizes)
            continue
        i = waiting.pop()
        own = codes[starts[i] : starts[i] + sizes[i]]
        known[own] = 1
        both = np.add.reduceat(known[flat], at)
        known[own] = 0
        near = both * (10 + LEAST_TENTHS) >= LEAST_TENTHS * (sizes[rest] + sizes[i])
        if near.any():
            found = rest[near]
            left += [int(i)] * len(found)
            right += found.tolist()
            waiting += found.tolist()
            rest, flat, at = _without(rest, near, flat, at, sizes)
    return left, right


def _without(rest, gone, flat, at, sizes):
    """The rows that stay, with their codes."""
    stay = ~gone
    flat = flat[np.repeat(stay, sizes[rest])]
    rest = rest[stay]
    return rest, flat, np.concatenate(([0], np.cumsum(sizes[rest])[:-1])) if len(rest) else at[:0]


def verified_edges(members: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """``src, dst``: in every bucket a spanning forest of the pairs that are similar enough.

    ``members``: bucket, node; ``rows``: row, text. A text's buckets go to the text, and its set from there to each of them, once.
    Texts in no bucket are passed over where they are read.
    """

    def compare(table: pa.Table) -> pa.RecordBatch:
        buckets, nodes = table.column("bucket").to_numpy(), table.column("node").to_numpy()
        hashes = table.column("hashes")
        edges = [np.flatnonzero(np.diff(buckets)) + 1]
        bounds = [0, *edges[0].tolist(), len(buckets)]
        src, dst = [], []
        for a, b in zip(bounds, bounds[1:]):
            if b - a > 1:
                left, right = similar_forest([np.frombuffer(hashes[k].as_py(), dtype="<u8") for k in range(a, b)])
                src += nodes[a:b][left].tolist()
                dst += nodes[a:b][right].tolist()
        return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    asked = split_hot(members, "node").groupBy(F.col("node").alias("row")).agg(F.collect_list("bucket").alias("buckets"))
    asked = stage(asked, "near-copies", compact=True)
    wanted = marked_rows(rows, asked.select("row"), "row")
    placed = _sets(wanted.join(asked, "row").select(F.col("row").alias("node"), "text", "buckets"), words)
    return compare_buckets(placed, compare, "src long, dst long")


def _first_of_equal(asked: DataFrame, seen: DataFrame | None) -> DataFrame:
    """``bucket`` and the mark of its members: one bucket for the same members, none for members compared before."""
    mark = [F.bit_xor(F.xxhash64("node")).alias("xor"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("other"), F.count("*").alias("n")]
    found = asked.groupBy("bucket").agg(*mark).groupBy("xor", "other", "n").agg(F.min("bucket").alias("bucket"))
    return found if seen is None else found.join(seen, ["xor", "other", "n"], "left_anti")


def fingerprint_cells(found: DataFrame, sketches: DataFrame, nodes: DataFrame, cell: int = CELL // 2) -> DataFrame:
    """``bucket, node`` of the fingerprint groups (``found``: row, component_id) that hold several texts.

    Large groups are dealt into cells of about ``cell`` texts, and the group's first text is in each of them. Texts without a word,
    copies of each other already, take no part.
    """
    worded = nodes.where(F.size("bands") > 0).select("print", "node")
    members = sketches.select("row", "print").join(found, "row").join(worded, "print")
    members = stage(members.select("component_id", "node").distinct(), "near-copies", compact=True)
    sizes = members.groupBy("component_id").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1")
    placed = members.join(stage(sizes, "near-copies", compact=True), "component_id")
    cells = F.ceil(F.col("n") / cell).cast("int")
    own = F.array(F.pmod(F.xxhash64("node", F.lit(13)), cells).cast("int"))
    where = F.when(F.col("node") == F.col("first"), F.sequence(F.lit(0), cells - 1)).otherwise(own)
    placed = placed.select("component_id", "node", F.explode(where).alias("cell"))
    return placed.select(F.xxhash64("component_id", "cell").alias("bucket"), "node")


def band_buckets(nodes: DataFrame, labels: DataFrame, first: int, end: int) -> DataFrame:
    """``bucket, node`` of the buckets of some bands whose texts are not all in one group yet."""
    own = nodes.select("node", F.slice("bands", first + 1, end - first).alias("bands"))
    members = own.join(labels, "node").select("node", "component", F.explode("bands").alias("bucket"))
    # Most buckets hold one text: two numbers per bucket tell which hold several groups.
    spans = members.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    several = stage(spans.where("least < most").select("bucket"), "near-copies", compact=True)
    return members.join(several, "bucket", "left_semi").select("bucket", "node")


def groups(rows: DataFrame, words: int, row: str = "row", text: str = "text") -> DataFrame:
    """``row, component`` for every row; ``row`` must be a unique long that does not change when ``rows`` is read again."""
    rows = rows.select(F.col(row).alias("row"), F.col(text).alias("text"))
    sketches = stage(_sketches(rows, words), "near-copies")
    nodes = sketches.groupBy("print").agg(F.min("row").alias("node"), F.any_value("bands").alias("bands"))
    nodes = stage(nodes, "near-copies")
    labels, seen = nodes.select("node", F.col("node").alias("component")), None
    found = near_duplicates(rows, key="row").select("row", "component_id")
    for bands in (None, *BAND_ROUNDS):
        asked = band_buckets(nodes, labels, *bands) if bands else fingerprint_cells(found, sketches, nodes)
        asked = stage(asked, "near-copies", compact=True)
        firsts = stage(_first_of_equal(asked, seen), "near-copies", compact=True)
        seen = firsts.drop("bucket") if seen is None else seen.unionByName(firsts.drop("bucket"))
        asked = asked.join(firsts.select("bucket"), "bucket", "left_semi")
        edges = stage(verified_edges(asked, rows, words), "near-copies", compact=True)
        # Groups found so far are the nodes of the next links.
        link = edges.join(labels.select(F.col("node").alias("src"), F.col("component").alias("a")), "src")
        link = link.join(labels.select(F.col("node").alias("dst"), F.col("component").alias("b")), "dst")
        joined = connected_components(link.select(F.col("a").alias("src"), F.col("b").alias("dst")))
        joined = stage(joined.select(F.col("node").alias("component"), F.col("component").alias("to")), "near-copies", compact=True)
        labels = labels.join(joined, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels = stage(labels, "near-copies")
    placed = nodes.select("print", "node").join(labels, "node").select("print", "component")
    return sketches.select("row", "print").join(placed, "print").select("row", "component")
