"""Scans, manifests, reports and quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.curation import _SELECTED, selected
from tallyloom.catalog.registry import query, table
from tallyloom.catalog.scores import _EVENTS_REPORT, event_counts
from tallyloom.constants import FILE_COLUMN, INSTRUCTION, ORDINAL_COLUMN
from tallyloom.functions import text
from tallyloom.operators import metrics
from tallyloom.sources import manifests, quarantine, reports, shards
from tallyloom.sources.workspace import new_folder


def document_scan(spark, sf_dir, columns=("doc_id", "lang", "source")):
    return shards.scan_metadata(spark, f"{sf_dir}/documents.parquet", columns)


@query(
    "q_a1_metadata_scan",
    """SELECT doc_id, lang, source, 'documents.parquet' AS file, doc_id AS row_idx_in_shard FROM documents""",
)
def metadata_scan(spark, sf_dir):
    scan = document_scan(spark, sf_dir, ("doc_id", "lang", "source", "no_such_column"))
    return scan.select(
        "doc_id", "lang", "source", F.substring_index(FILE_COLUMN, "/", -1).alias("file"), ORDINAL_COLUMN
    )


@query(
    "q_a2_table_profile",
    """SELECT CAST(unnest([0, 1, 2, 3, 4]) AS INT) AS position,
        unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS column_name,
        (SELECT count(*) FROM documents) AS total_rows""",
)
def table_profile(spark, sf_dir):
    return shards.table_profile(table(spark, sf_dir, "documents"))


@query(
    "q_a2_first_rows",
    f"""SELECT doc_id, '<string>' AS text, lang, source, n_chars, doc_id AS row_idx_in_shard,
        concat('{INSTRUCTION}', chr(10), 'Crop: ', lang) AS prompt, concat('Diagnosis: ', source) AS answer
    FROM documents WHERE doc_id < 5""",
)
def first_rows(spark, sf_dir):
    """A preview: the first five rows of the first file with the conversation they would give."""
    return shards.first_rows(spark, f"{sf_dir}/documents.parquet", 5, heavy=["text"]).withColumns(
        {"prompt": text.user_prompt("lang"), "answer": text.answer_text("source")}
    )


@query(
    "q_a3_manifest_write",
    f"{_SELECTED} SELECT split, target, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM selected GROUP BY split, target",
)
def manifest_write(spark, sf_dir):
    path = new_folder(spark, "manifest")
    manifests.write_manifest(selected(spark, sf_dir), path)
    written = spark.read.parquet(path)
    return written.groupBy("split", "target").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


@query(
    "q_a4_manifest_read",
    f"""{_SELECTED} SELECT 'val' AS asked, doc_id, target, 'done' AS state FROM selected WHERE split = 'val'
    UNION ALL SELECT 'test', doc_id, target, NULL FROM selected WHERE split = 'test'""",
)
def manifest_read(spark, sf_dir):
    """val comes from the preprocessed manifest, test from the plain one; the first folder is absent."""
    folder = new_folder(spark, "manifests")
    folders = [f"{folder}-absent", folder]
    manifests.write_manifest(selected(spark, sf_dir), f"{folder}/{manifests.PLAIN}")
    plain = spark.read.parquet(f"{folder}/{manifests.PLAIN}")
    manifests.write_manifest(
        plain.withColumn("state", F.lit("done")), f"{folder}/{manifests.PREPROCESSED}"
    )
    val = manifests.read_manifest(spark, "val", folders)
    test = manifests.read_manifest(spark, "test", folders).withColumn("state", F.lit(None).cast("string"))
    columns = ["doc_id", "target", "state"]
    return (
        val.select(F.lit("val").alias("asked"), *columns)
        .unionByName(test.select(F.lit("test").alias("asked"), *columns))
    )


@query(
    "q_a4_published_manifest",
    f"""{_SELECTED} SELECT 'old' AS asked, split, target, count(*) AS n FROM selected GROUP BY split, target
    UNION ALL SELECT 'new', split, target, count(*) FROM selected WHERE target <> 'en' GROUP BY split, target""",
)
def published_manifest(spark, sf_dir):
    """A reader that opened the manifest before it was published anew, and one that came after."""
    path = f"{new_folder(spark, 'published')}/{manifests.PLAIN}"
    manifests.publish_manifest(selected(spark, sf_dir), path)
    old = manifests.current_manifest(spark, path)
    manifests.publish_manifest(old.where("target <> 'en'"), path)
    both = {"old": old, "new": manifests.current_manifest(spark, path)}
    counted = [
        rows.groupBy("split", "target").agg(F.count(F.lit(1)).alias("n")).select(F.lit(asked).alias("asked"), "*")
        for asked, rows in both.items()
    ]
    return counted[0].unionByName(counted[1])


@query("q_a5_report_sinks", f"{_EVENTS_REPORT} SELECT class, support, precision, recall, f1 FROM report")
def report_sinks(spark, sf_dir):
    """A class report written as CSV and JSON; each column comes back from one of the two."""
    folder = new_folder(spark, "reports")
    report = metrics.class_report(event_counts(spark, sf_dir))
    reports.write_csv(report, f"{folder}/csv", [F.desc("support"), "class"])
    reports.write_json(report, f"{folder}/json")
    csv = spark.read.schema(report.schema).option("header", True).option("nullValue", "\\N").csv(f"{folder}/csv")
    json = spark.read.schema(report.schema).json(f"{folder}/json")
    return csv.select(F.coalesce("class", F.lit("")).alias("class"), "support", "precision").join(
        json.select("class", "recall", "f1"), "class"
    )


@query(
    "q_a6_quarantine",
    """SELECT '2024-01-01 00:00:00' AS timestamp, concat('doc-', doc_id) AS filename, source AS shard_id,
        CAST(doc_id AS VARCHAR) AS row_idx, concat('bad language ', lang) AS error, 'bad' AS kind
    FROM documents WHERE lang <> 'en'
    UNION ALL SELECT NULL, concat('doc-', doc_id), source, CAST(doc_id AS VARCHAR), NULL, 'good'
    FROM documents WHERE lang = 'en'""",
)
def quarantined(spark, sf_dir):
    path = new_folder(spark, "quarantine")
    outcome = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("filename"),
        F.when(F.col("lang") != "en", F.concat(F.lit("bad language "), "lang")).alias("error"),
    )
    stamp = F.lit("2024-01-01").cast("timestamp")
    quarantine.append_quarantine(
        quarantine.bad_rows(outcome, "filename", "source", "doc_id", at=stamp), path
    )
    good = quarantine.good_rows(outcome).select(
        F.lit(None).cast("string").alias("timestamp"),
        "filename",
        F.col("source").alias("shard_id"),
        F.col("doc_id").cast("string").alias("row_idx"),
        F.lit(None).cast("string").alias("error"),
        F.lit("good").alias("kind"),
    )
    return spark.read.parquet(path).withColumn("kind", F.lit("bad")).unionByName(good)
