"""A training corpus from raw documents, stage by stage.

Every stage takes what the one before it kept, as a table with the columns of ``documents``, and returns the rows it
keeps; the last one packs them. ``run`` writes each stage's rows to the shared folder and reads them back, so
a lost executor never costs more than one stage.

Extra columns pass through, whatever their names. Null and empty texts: not toxic by the curve's value for no evidence, of no language,
so the second stage rejects them. Repeated rows: the third stage keeps one of each group of near copies.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import language, near_copies, packing, toxicity
from tallyloom.llm.common import marked_rows, table, trainable
from tallyloom.sources.workspace import stage

#: Documents whose language is surer than this stay.
LEAST_LANGUAGE_SCORE = 0.5
#: Near copies share at least 0.8 of their shingles of five words (``near_copies.LEAST_TENTHS``).
SHINGLE = 5
#: A row's number is its file's number and its position there; so many files are listed to all tasks, more are joined by shuffle.
ROW_BITS, MOST_FILES = 40, 100_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score reaches the threshold; learned from labelled documents of the input."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text").where(trainable()), labels.where(trainable()))
    return docs.where(toxicity.score(model, "text") < toxicity.THRESHOLD)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those that no learned language explains better than all others together."""
    model = language.train(docs.select("doc_id", "text", "lang").where(trainable()))
    found = language.identify(docs, model, lang="__llm_lang", score="__llm_score")
    sure = (F.col("__llm_lang") != language.UNDETERMINED) & (F.col("__llm_score") > LEAST_LANGUAGE_SCORE)
    return found.where(sure).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the one with the smallest id, a missing id last.

    Groups come from SimHash fingerprints by the general pigeonhole, checked by exact similarity, then from bands of minima.
    Rows are told apart by a key of their own, so rows that repeat an id with other texts are documents of their own.
    """
    rows = numbered(docs)
    groups = near_copies.groups(rows, SHINGLE, row="__llm_row").withColumnRenamed("row", "__llm_row")
    # Among rows of one id the order is by text, not by where they were read.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.col("__llm_row").alias("row"))
    keys = rows.select("__llm_row", order.alias("__llm_order"))
    first = keys.join(groups, "__llm_row").groupBy("component").agg(F.min("__llm_order").alias("first"))
    first = stage(first.select(F.col("first.row").alias("__llm_row")), "pipeline-first")
    return marked_rows(rows, first, "__llm_row").select(*docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique long ``__llm_row`` that is the same at every reading.

    Rows of files are known by file and position, without a copy of the texts; other rows are written once.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("__llm_place")
    try:
        placed = docs.select("*", place)
    except AnalysisException:
        return stage(docs.withColumn("__llm_row", F.monotonically_increasing_id()), "pipeline-rows")
    # One row per file.
    files = placed.select(F.col("__llm_place.file").alias("__llm_file")).distinct()
    number = (F.row_number().over(Window.orderBy("__llm_file")) - 1).cast("long").alias("__llm_number")
    files = stage(files.select("__llm_file", number), "pipeline-files")
    files = F.broadcast(files) if files.count() <= MOST_FILES else files
    joined = placed.join(files, F.col("__llm_place.file") == F.col("__llm_file"))
    row = F.shiftleft("__llm_number", ROW_BITS).bitwiseOR(F.col("__llm_place.row"))
    return joined.select(*docs.columns, row.alias("__llm_row"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_languages),
    ("near_copies", drop_near_copies),
    ("packing", pack),
]

#: Dictionaries, unigram models and fingerprints cannot be stated in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
