"""Near copies of the pipeline against brute-force similarity."""

import os
from collections import defaultdict

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import buckets, common, near_copies, simhash
from tallyloom.llm.common import marked_rows, table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def shingles(text):
    found = (text or "").encode().lower().split()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def brute_force_survivors(docs):
    """Smallest id of each group of texts that share 0.8 of their shingles, by comparing every pair with a common one."""
    sets, holders, parent = {i: shingles(t) for i, t in docs}, defaultdict(list), {i: i for i, _ in docs}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, own in sets.items():
        for j in {j for s in own or [None] for j in holders[s]}:
            if len(own & sets[j]) >= 0.8 * len(own | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in own or [None]:
            holders[s].append(i)
    return sorted({find(i) for i in sets})


@pytest.mark.parametrize("cell", [2048, 16])
def test_survivors_are_those_of_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(buckets.split_hot, "__defaults__", (cell,))
    rng = np.random.default_rng(4)
    docs = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    for group in range(6):
        base = [f"w{k}" for k in rng.integers(0, 5000, 200)]
        for copy in range(40):
            text = list(base)
            for k in rng.integers(0, 200, copy // 4):
                text[k] = f"edit{copy}"
            docs.append((10_000 + 100 * group + copy, " ".join(text)))
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = corpus_pipeline.drop_near_copies(spark, rows, SF_DIR)
    assert sorted(r.doc_id for r in found.collect()) == brute_force_survivors(docs)


def test_repeated_ids_are_rows_of_their_own(spark):
    near = " ".join(f"w{k}" for k in range(100))
    rows = [(3, near), (5, "another text of its own, not like the others"), (5, near + " end"), (None, near), (None, "no id here")]
    found = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF_DIR)
    assert sorted((r.doc_id or 0, r.text) for r in found.collect()) == sorted((i or 0, t) for i, t in [rows[0], rows[1], rows[4]])


def test_pairs_at_the_bound_share_a_bucket():
    rng, constants, met = np.random.default_rng(5), near_copies._constants(), 0
    for _ in range(500):
        both, a, b = np.split(rng.integers(0, 2**64, 360 + 2 * 45, dtype=np.uint64), [360, 405])
        bands = [near_copies.bands_of(np.concatenate((both, x)), constants) for x in (a, b)]
        met += bool((bands[0] == bands[1]).any())
    assert met >= 498


@pytest.mark.parametrize("cell", [near_copies.CELL // 2, 3])
def test_fingerprints_find_groups_and_sets_check_them(spark, monkeypatch, cell):
    monkeypatch.setattr(near_copies, "BAND_ROUNDS", ())
    monkeypatch.setattr(near_copies.fingerprint_cells, "__defaults__", (cell,))
    near = " ".join(f"w{k}" for k in range(800))
    copies = [(k, near if k == 1 else f"{near} end{k}") for k in range(1, 21)]
    # Repeats decide the fingerprint, and only a third of the shingles is shared.
    often = " ".join([f"r{k}" for k in range(61)] * 200)
    apart = [(k, " ".join([often, *(f"own{k}x{i}" for i in range(60))])) for k in (31, 32)]
    rows = spark.createDataFrame([*copies, *apart, (41, ""), (42, None), (43, " ")], "row long, text string").repartition(3)
    prints = {simhash.fingerprint_of(text) for _, text in apart}
    assert len(prints) == 1
    found = {r.row: r.component for r in near_copies.groups(rows, 5).collect()}
    linked = [k for k, text in copies if (simhash.fingerprint_of(text) ^ simhash.fingerprint_of(near)).bit_count() <= simhash.MOST_BITS]
    assert len(linked) > 15 and {found[k] for k in linked} == {1}
    assert found[31] == 31 and found[32] == 32
    assert found[41] == found[42] == found[43]


@pytest.fixture
def no_small_tables(spark):
    """Staged tables count as too large to be broadcast, as they are over a large input."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("most", [common.MOST_WORDS, 0])
def test_marked_rows_are_those_of_a_semi_join(spark, monkeypatch, tmp_path, no_small_tables, most):
    monkeypatch.setattr(common, "MOST_WORDS", most)
    keys = [*range(200), *(1 << 40 | k for k in (0, 62, 63, 64)), 2**63 - 1, -1, -64, -65, -(2**63), None]
    rows = spark.createDataFrame([(k, f"text {k}") for k in [*keys, 7, 63]], "row long, text string").repartition(3)
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    wanted = [0, 63, 64, 127, 190, 63, 1 << 40, 1 << 40 | 63, 2**63 - 1, -1, -65, -(2**63), 999, None]
    marks = spark.createDataFrame([(k,) for k in wanted], "row long")
    found = marked_rows(rows, marks, "row")
    assert found.columns == rows.columns
    assert sorted(r.row for r in found.collect()) == sorted(k for k in [*keys, 7, 63] if k is not None and k in wanted)
    assert most == 0 or "hashpartitioning" not in plan_of(found)
    assert marked_rows(rows, marks.limit(0), "row").count() == 0


def test_texts_of_rows_without_partners_are_not_shuffled(spark, monkeypatch, tmp_path, no_small_tables):
    rng = np.random.default_rng(8)
    bases = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 60)) for _ in range(200)]
    docs = [(k, text) for k, text in enumerate(bases)] + [(1000 + k, f"{bases[k]} end") for k in range(5)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    sent, plain = [], near_copies.marked_rows

    def counted(*given):
        found = plain(*given)
        sent.append(found.count())
        return found

    monkeypatch.setattr(near_copies, "marked_rows", counted)
    found = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "docs")), SF_DIR)
    # Neither the rows that stay nor those that are compared bring the other texts to a shuffle.
    assert "hashpartitioning" not in plan_of(found)
    assert sorted(r.doc_id for r in found.collect()) == list(range(200))
    assert 10 <= sum(sent) <= 50
