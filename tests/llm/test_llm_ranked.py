"""Content sort, ranked search and hard negatives against plain versions."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import content_sort, hard_negatives, lexical


def plain_groups(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text or ""), []).append(key)
    return groups


@pytest.mark.parametrize("cell", [content_sort.CELL_BYTES, 3 * content_sort.ROW_BYTES])
def test_content_sort_equals_grouping(spark, cell):
    draw = random.Random(cell)
    texts = [None, "", " ", "a b", "a\t\n b", "a  b ", "A b", "x" * 200 + "1", "x" * 200 + "2", "naïve text", "w " * 30_000]
    rows = [(k, draw.choice(texts), "own") for k in range(300)] + [(k + 1000, "the hot text", "own") for k in range(150)]
    draw.shuffle(rows)
    given = spark.createDataFrame(rows, "doc_id long, text string, keep_id string").repartition(5)
    found = content_sort.deduplicate(given, cell_bytes=cell)
    assert found.columns == ["doc_id", "text", "keep_id", "group_size", "kept"]
    want = {}
    for keys in plain_groups([row[:2] for row in rows]).values():
        want |= {k: (min(keys), len(keys), k == min(keys)) for k in keys}
    got = found.collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got} == want
    assert len(got) == len(rows)
    assert {(r.doc_id, r.text) for r in got} == {row[:2] for row in rows}


@pytest.mark.parametrize("cell", [content_sort.CELL_BYTES, content_sort.ROW_BYTES])
def test_content_sort_with_missing_and_repeated_keys(spark, cell):
    rows = [(None, "a"), (None, "a"), (None, "a"), (7, "b"), (7, "b"), (7, "b "), (None, "b"), (3, "c"), (3, "d")]
    found = content_sort.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), cell_bytes=cell).collect()
    groups = {}
    for row in found:
        groups.setdefault((row.keep_id, row.group_size), []).append(row.kept)
    # "b " keeps its final space, so it is a text of its own.
    assert {k: sorted(v) for k, v in groups.items()} == {
        (None, 3): [False, False, True],
        (7, 3): [False, False, True],
        (7, 1): [True],
        (3, 1): [True, True],
    }
    assert content_sort.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_content_sort_moves_texts_once_and_stays_in_the_jvm(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    plan = content_sort.deduplicate(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
    assert "Python" not in plan and "Arrow" not in plan


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def plain_ranking(docs, items, count=10):
    held = [(key, found) for key, text in docs if (found := plain_terms(text))]
    n_docs, total = len(held), sum(len(found) for _, found in held)
    out = []
    for item, text in items:
        scored = []
        weight = {
            t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in f for _, f in held) + 1))) for t in set(plain_terms(text))
        }
        for key, found in held:
            m = 100 - 75 + 75 * len(found) * n_docs // total
            score = sum(weight[t] * ((1000000000 * found.count(t)) // (1000 * found.count(t) + 8 * m)) for t in plain_terms(text))
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:count], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [lexical.WIDTH, 8])
@pytest.mark.parametrize("sample", [lexical.SAMPLE, 40])
def test_ranked_search_equals_plain_scoring(spark, width, sample):
    draw = random.Random(width + sample)
    words = [f"w{k}" for k in range(60)] + ["É", "été", "ÉTÉ", "naïve", "X9", "x9", "हिन्दी"]
    docs = [(k, draw.choice([" ", "-", "_\n"]).join(draw.choices(words, k=draw.randrange(0, 40)))) for k in range(300)]
    docs += [(400 + k, "w1 w2 w3 hot copy") for k in range(100)] + [(401, "w1 w2 w3 hot copy"), (None, "w5 lost key"), (9, None), (10, "?!")]
    items = [(k, " ".join(draw.choices(words, k=6))) for k in range(20)] + [(50, "w1 W2 w3 hot"), (51, None), (52, ""), (53, "absent"), (54, "lost")]
    given = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, score double").repartition(6)
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    found = lexical.search(lexical.build_index(given, width=width), asked, width=width, sample=sample, block_items=7)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(row) for row in found.collect()), key=str) == plain_ranking(docs, items)


def test_ranked_search_on_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(lexical.build_index(docs), items).count() == 0
    one = lexical.build_index(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert lexical.search(one, items.limit(0)).count() == 0
    # One document that holds the only term: its weight is floor(1000 ln(4/3)).
    assert [tuple(r) for r in lexical.search(one, items).collect()] == [(1, 1, 1, 287 * (1000000000 // (1000 + 8 * 100)))]


def plain_negatives(rows, anchors):
    used = [(i, lab, np.floor(256 * np.array(v, dtype=float)).astype(int)) for i, v, lab in rows]
    out = []
    for own, label, vector in [r for r in used if r[0] is not None and anchors(r[0])]:
        others = [(int(vector @ v), i, lab) for i, lab, v in used if i != own]
        others.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for p, positive, _ in [r for r in others if r[2] == label][:5]:
            fit = [r for r in others if r[2] != label and 30 * p <= 100 * r[0] <= 90 * p][:10]
            out += [(own, positive, rank, r[1], p, r[0]) for rank, r in enumerate(fit, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("floor_sample", [hard_negatives.FLOOR_SAMPLE, 60])
@pytest.mark.parametrize("kind", ["spread", "tied", "hot"])
def test_hard_negatives_equal_plain_mining(spark, monkeypatch, floor_sample, kind):
    monkeypatch.setattr(hard_negatives, "BLOCK", 9)
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(6, 12))
    vectors = centres[draw.integers(0, 6, 400)] + draw.normal(scale=0.4, size=(400, 12))
    vectors[7] = 0
    if kind == "tied":
        vectors = np.round(vectors)
    if kind == "hot":
        vectors[100:250] = vectors[100]
    rows = [(k, vectors[k].tolist(), int(draw.integers(0, 4))) for k in range(400)]
    rows += [rows[5], (None, vectors[3].tolist(), 2)]
    odd = [(1000, None, 1), (1010, [1.0] * 12, None), (1020, [1.0] * 11 + [None], 1), (1030, [float("nan")] * 12, 1), (1040, [float("inf")] * 12, 1), (1050, [1.0], 1)]
    given = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<float>, label int, rank int").repartition(4)
    found = hard_negatives.mine(given, F.col("vec_id") % 10 == 0, floor_sample=floor_sample)
    exact = [(i, np.array(v, dtype=np.float32).astype(float), lab) for i, v, lab in rows]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_negatives(exact, lambda i: i % 10 == 0)


def test_bounds_hold_for_every_pair():
    draw = np.random.default_rng(8)
    rows = np.floor(256 * draw.normal(size=(300, 16)))
    rows[:20] = rows[0]
    rows[20] = -rows[21]
    rows[22] = 0
    size, turned = hard_negatives.angles(rows, hard_negatives.directions_of(rows))
    lower, upper = hard_negatives.score_bounds(turned, size, turned, turned, size, size)
    scores = rows @ rows.T
    assert (lower <= scores).all() and (scores <= upper).all()
    span = (turned.min(axis=0)[None], turned.max(axis=0)[None], size.min()[None], size.max()[None])
    lower, upper = hard_negatives.score_bounds(turned, size, *span)
    assert (lower <= scores).all() and (scores <= upper).all()


def test_hard_negatives_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert hard_negatives.mine(spark.createDataFrame([], schema), F.col("vec_id") % 2 == 0).count() == 0
    same = spark.createDataFrame([(k, [1.0, 2.0], 1) for k in range(5)], schema)
    assert hard_negatives.mine(same, F.col("vec_id") % 2 == 0).count() == 0
    zero = spark.createDataFrame([(k, [0.0, 0.0], k % 2) for k in range(5)], schema)
    # All scores are 0, and 0 lies between the two shares of 0.
    assert hard_negatives.mine(zero, F.col("vec_id") == 0).count() == 2 * 2
    far = spark.createDataFrame([(0, [1e9, 1.0], 1)], schema)
    with pytest.raises(Exception, match="may not fit"):
        hard_negatives.mine(far, F.col("vec_id") == 0).count()
