"""Near duplicates, components and neighbours against brute force; sharding against its law."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import buckets, nearest, pivots, sharding, simhash
from tallyloom.llm.components import connected_components


def closure(keys, near):
    """Smallest key reachable, by plain search."""
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in near:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(0, i) for i in range(1000, 1200)]
    edges += [(i, i + 1) for i in range(2000, 2050)] + [(5, 5)]
    found = dict(connected_components(spark.createDataFrame(edges, "src long, dst long")).collect())
    want = closure({x for e in edges for x in e}, edges)
    assert found == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def plain_fingerprint(text, words=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t", "One", "One two", "A b c d É", "the same words the same words " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) % 2**64 == plain_fingerprint(text)


def test_spark_hash_is_the_fingerprint_hash(spark):
    want = xxhash.xxh64_intdigest(b"a b c", seed=42)
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == want


@pytest.mark.parametrize("most", [3, 7])
@pytest.mark.parametrize("cell", [4, 2048])
def test_links_of_fingerprints(spark, monkeypatch, most, cell):
    rng = random.Random(most)
    centres = [rng.getrandbits(64) for _ in range(30)]
    values = {0, 1, 2**63}
    for centre in centres:
        for _ in range(12):
            flips = rng.sample(range(64), rng.randrange(0, 7))
            values.add(centre ^ sum(1 << b for b in flips))
    values = sorted(v - 2**64 if v >= 2**63 else v for v in values)
    near = [(a, b) for i, a in enumerate(values) for b in values[:i] if ((a ^ b) % 2**64).bit_count() <= most]
    prints = spark.createDataFrame([(v,) for v in values], "node long")
    monkeypatch.setattr(buckets.split_hot, "__defaults__", (cell,))
    found = dict(simhash.linked_fingerprints(prints, most).collect())
    want = closure(values, near)
    assert {v: found.get(v, v) for v in values} == want


def test_every_plan_spends_its_budget():
    sample = np.random.default_rng(0).integers(0, 2**63, 300).astype(np.uint64)
    for rows in (10, 10**5, 10**9):
        plan = simhash.make_plan(sample, rows, 3)
        assert sum(t + 1 for _, t in plan) == 4
        assert len({b for cut, _ in plan for b in cut}) == sum(len(cut) for cut, _ in plan)


def test_near_duplicate_documents(spark):
    texts = {4: "a b c d e f", 2: "A B c d e f", 9: "other words stand here", 7: None, 5: "", 6: " "}
    rows = [(k, t, "x") for k, t in texts.items()] + [(9, texts[9], "y"), (None, texts[4], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    found = simhash.near_duplicates(docs)
    assert found.count() == len(rows)
    groups = {row.doc_id: row.component_id for row in found.collect()}
    assert groups == {4: 2, 2: 2, None: 2, 9: 9, 7: 5, 5: 5, 6: 5}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("cell", [8, 2048])
def test_vector_links_are_counted_once(spark, monkeypatch, cell):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    points = np.repeat(base, 6, axis=0) + rng.normal(size=(240, 16)) * 0.05
    points[100:130] = points[100]
    points = points.astype(np.float32)
    labels = [i // 120 for i in range(240)]
    rows = [(i, p.tolist(), label) for i, (p, label) in enumerate(zip(points, labels))]
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, points[0].tolist(), None), (904, [1.0], 0)]
    monkeypatch.setattr(buckets.split_hot, "__defaults__", (cell,))
    found = {r.vec_id: r for r in pivots.near_duplicates(vectors(spark, rows + odd)).collect()}
    unit = points.astype(float) / np.linalg.norm(points.astype(float), axis=1, keepdims=True)
    near = [(i, j) for i in range(240) for j in range(i) if labels[i] == labels[j] and unit[i] @ unit[j] >= 0.98]
    true = Counter(k for pair in near for k in pair)
    assert sum(found[i].n_links for i in range(240)) >= 0.9 * 2 * len(near)
    assert all(found[i].n_links <= true[i] for i in range(240))
    assert all(found[i].n_links >= 19 and found[i].component_id <= 100 for i in range(100, 120))
    assert all((found[k].n_links, found[k].component_id, found[k].kept) == (0, k, True) for k in range(900, 905))
    assert pivots.near_duplicates(vectors(spark, [])).count() == 0


def test_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(6)
    points = rng.normal(size=(1500, 8)).astype(np.float32)
    points[200:260] = points[200]
    rows = [(i, p.tolist(), None) for i, p in enumerate(points)] + [(5000, None, 1), (5100, [0.0] * 8, 1)]
    monkeypatch.setattr(nearest, "CHUNK_ROWS", 100)
    found = nearest.search(vectors(spark, rows), F.col("vec_id") % 100 == 0).toPandas()
    hits = 0
    for query, part in found.groupby("query_id"):
        distance = np.sqrt(((points.astype(float) - points[query].astype(float)) ** 2).sum(axis=1))
        distance[query] = np.inf
        order = np.lexsort((np.arange(1500), distance))[:10]
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 11))
        assert np.array_equal(part.score, distance[part.vec_id])
        hits += len(set(order) & set(part.vec_id))
    assert hits >= 0.9 * 150 and found.query_id.nunique() == 15
    few = nearest.search(vectors(spark, rows[:4]), F.lit(True))
    assert few.count() == 12
    assert nearest.search(vectors(spark, []), F.lit(True)).count() == 0


def test_shards_have_exact_sizes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 50)
    rows = spark.range(0, 1003, numPartitions=7).selectExpr("id AS doc_id", "IF(id % 3 = 0, NULL, 'é') AS text", "1 AS slot_")
    found = sharding.shuffle_into_shards(rows.withColumns(sharding.text_digests()), 40).toPandas()
    assert sorted(found.doc_id) == list(range(1003))
    sizes = found.groupby("shard").size()
    assert len(sizes) == 40 and sizes.max() - sizes.min() <= 1
    assert all(sorted(part.slot) == list(range(len(part))) for _, part in found.groupby("shard"))
    assert set(found["size"]) == {16, 18}
    assert sharding.shuffle_into_shards(rows.limit(0), 40).count() == 0


def test_communication_matrix_follows_its_law():
    counts, sizes = [5, 9, 6], [8, 7, 5]
    drawn = [sharding.communication_matrix(counts, sizes, seed) for seed in range(4000)]
    for matrix in drawn[:50]:
        assert [sum(row) for row in matrix] == counts and [sum(column) for column in zip(*matrix)] == sizes
    first = np.array([matrix[1][0] for matrix in drawn])
    reference = np.random.default_rng(0).hypergeometric(8, 12, 9, 100_000)
    assert abs(first.mean() - 9 * 8 / 20) < 0.1 and abs(first.var() - reference.var()) < 0.15


def test_op5_shards_the_texts_themselves(spark, tmp_path, monkeypatch):
    from tallyloom.llm import catalog

    texts = [None if i % 7 == 0 else "é" * i for i in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    given, real = [], sharding.shuffle_into_shards
    monkeypatch.setattr(sharding, "shuffle_into_shards", lambda rows, *more: given.append(rows.columns) or real(rows, *more))
    found = catalog.op5_sharding(spark, str(tmp_path)).toPandas().set_index("doc_id")
    assert given == [["doc_id", "text"]]
    for i, text in enumerate(texts):
        data = (text or "").encode()
        assert found["size"][i] == len(data) + 16 and found.text_crc32[i] == zlib.crc32(data)
    sizes = found.groupby("shard").size()
    assert len(sizes) == 40 and sizes.max() - sizes.min() <= 1
    assert all(sorted(part.slot) == list(range(len(part))) for _, part in found.groupby("shard"))
