"""Registered queries and the pipeline against plain versions over a small table."""

import os
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from tallyloom.llm import language, packing, toxicity
from tallyloom.llm.catalog import QUERIES
from tallyloom.llm.common import table, trainable
from tallyloom.llm.word_tokens import word_tokens

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Large enough for toxic documents to be told apart, and for near copies.
PIPELINE_DIR = os.environ.get("TEST_PIPELINE_DIR", "/root/testdata/sf0.01")

COLUMNS = {
    1: ["doc_id", "held_out", "lang_pred", "score"],
    2: ["page_id", "url", "text", "n_chars"],
    3: ["query_id", "rank", "vec_id", "score"],
    4: ["doc_id", "fingerprint", "component_id"],
    5: ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    6: ["doc_id", "held_out", "score", "predicted"],
    7: ["n_tokens", "docs"],
    8: ["vec_id", "n_links", "component_id", "kept"],
    9: ["doc_id", "n_ids", "ids_crc32", "round_trip"],
    10: ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    11: ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    12: ["item_id", "rank", "doc_id", "score"],
    13: ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_columns_and_rows(spark, name):
    number = int(name[2:].split("_")[0])
    found = QUERIES[name](spark, SF_DIR)
    assert found.columns[: len(COLUMNS[number])] == COLUMNS[number]
    rows = found.count()
    if number in (1, 4, 5, 6, 9, 11):
        assert rows == table(spark, SF_DIR, "documents").count()
    assert rows > 0


def test_all_numbers_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert "pipeline" in queries()


def plain_shingles(text, words=5):
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def plain_survivors(texts, least=0.8):
    """Smallest id of each group of texts linked by Jaccard similarity, all pairs of an inverted list compared."""
    shingles, parent = {i: plain_shingles(text) for i, text in texts.items()}, {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    shared, holders = Counter(), defaultdict(list)
    for i in sorted(texts):
        for shingle in shingles[i]:
            shared.update((j, i) for j in holders[shingle])
            holders[shingle].append(i)
    for (j, i), both in shared.items():
        if both >= least * (len(shingles[i]) + len(shingles[j]) - both) - 1e-9:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return sorted(i for i in texts if find(i) == i)


def test_pipeline_keeps_what_plain_versions_keep(spark):
    docs = table(spark, PIPELINE_DIR, "documents")
    rows = {row.doc_id: row for row in docs.collect()}
    labels = table(spark, PIPELINE_DIR, "labels")
    model = toxicity.train(docs.select("doc_id", "text").where(trainable()), labels.where(trainable()))
    scores = dict(zip(rows, model.scores([row.text for row in rows.values()])))
    clean = {i for i in rows if scores[i] < toxicity.THRESHOLD}
    assert 0.8 * len(rows) < len(clean) <= len(rows)
    kept = docs.where(docs.doc_id.isin(clean))
    known = language.train(kept.select("doc_id", "text", "lang").where(trainable()))
    memory = language.KnownWords()
    sure = {i for i in clean for found in known.predict([rows[i].text], memory) if found[0] != "und" and found[1] > 0.5}
    survivors = plain_survivors({i: rows[i].text for i in sure})
    assert 0.5 * len(rows) < len(survivors) < len(sure)
    found = corpus_pipeline.run(spark, PIPELINE_DIR).toPandas()
    assert sorted(set(found.doc_id)) == survivors
    assert (found.groupby("doc_id").length.sum() == found.groupby("doc_id").doc_tokens.first()).all()
    assert (found.ids.str.len() == 4 * found.length).all()


def test_rows_of_files_keep_their_numbers(spark, tmp_path):
    made = spark.range(1000).selectExpr("id % 7 AS doc_id", "'t' AS text").repartition(5)
    made.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    one = corpus_pipeline.numbered(docs)
    assert one.select("__llm_row").distinct().count() == 1000 and one.columns == [*docs.columns, "__llm_row"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        again = corpus_pipeline.numbered(docs.select("doc_id", "text"))
        assert one.exceptAll(again).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stages_take_odd_rows_and_extra_columns(spark):
    rows = [(1, "the same words stand here", "en", "s", 1, "a"), (2, "the same words stand here", None, None, None, "b"),
            (3, None, None, None, None, None), (4, "", "en", "s", 0, "c"), (1, "the same words stand here", "en", "s", 1, "a"),
            (None, "lost id of a text", "en", "s", 1, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for (name, step), want in zip(corpus_pipeline.STAGES, (6, None, 3, None)):
        found = step(spark, docs, SF_DIR)
        if name != "packing":
            assert found.columns == docs.columns
        if want:
            assert found.count() == want, name
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), SF_DIR).count() == 0


def test_workers_keep_no_words_after_packing(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat_ws(' ', 'only', 'packed', id, id * 7) AS text").repartition(8)
    assert packing.pack(docs).agg(F.sum("length")).first()[0] > 400

    def kept(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(word_tokens(None).known)] * batch.num_rows, pa.int64())})

    assert spark.range(400).repartition(8).mapInArrow(kept, "n long").agg(F.max("n")).first()[0] == 0
