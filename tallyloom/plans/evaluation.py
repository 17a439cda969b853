"""Generated answers to records, scores and reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import fill_from, is_correct, parse_answer, scoring_truth
from tallyloom.operators import metrics
from tallyloom.operators.records import evaluation_records, failures
from tallyloom.operators.sampling import first_rows_in_order, sample_rows
from tallyloom.operators.scoring import IMAGE_ROWS, Predictor, arrow_batches, score_batches
from tallyloom.sources import reports
from tallyloom.sources.workspace import stage


def evaluate(
    answers: DataFrame,
    key: str | Sequence[str],
    folder: str,
    max_rows: int | None = None,
    shuffle_key: str | None = None,
    **columns: str,
) -> DataFrame:
    """E3-E13 for answered rows; writes every report below ``folder``, returns the metric row.

    Records and pair counts are staged: the answers are parsed once, and each report reads the
    small table of counts. ``columns`` goes to :func:`evaluation_records`.
    """
    folder = folder.rstrip("/")
    asked = first_rows_in_order(answers, max_rows, key, shuffle_key)
    records = stage(evaluation_records(asked, key, **columns), "records")
    counts = stage(metrics.confusion_counts(records, by=["crop"]), "pair-counts")
    bundle = stage(metrics.metric_bundle(counts), "metrics")
    reports.write_json(reports.rounded(bundle), f"{folder}/metrics")
    reports.write_csv(
        reports.rounded(metrics.class_report(counts)), f"{folder}/classification_report", [F.desc("support"), "class"]
    )
    reports.write_csv(
        reports.rounded(metrics.segment_report(counts, "crop")), f"{folder}/crop_metrics", [F.desc("samples"), "crop"]
    )
    reports.write_csv(
        metrics.top_confusions(counts), f"{folder}/top_confusions", [F.desc("n"), "ground_truth", "predicted"]
    )
    reports.write_csv(metrics.confusion_matrix(counts), f"{folder}/confusion_matrix", ["ground_truth", "predicted"])
    reports.write_csv(failures(records), f"{folder}/failures")
    return bundle


def predict_and_evaluate(
    prompts: DataFrame,
    load: Callable[[], Predictor],
    key: str | Sequence[str],
    folder: str,
    batch_rows: int = 8,
    heavy: Sequence[str] = ("image", "payload"),
    **columns: str,
) -> DataFrame:
    """U1 and then :func:`evaluate`. Staging the answers keeps the predictor to one run.

    ``heavy`` columns reach the predictor, in small Arrow batches, but are not kept.
    """
    keep = [name for name in prompts.columns if name not in heavy]
    with arrow_batches(prompts.sparkSession, max(batch_rows, IMAGE_ROWS)):
        answers = stage(score_batches(prompts, load, batch_rows=batch_rows, keep=keep), "answers")
    return evaluate(answers, key, folder, **columns)


def sample_predictions(
    rows: DataFrame,
    load: Callable[[], Predictor],
    key: str | Sequence[str],
    folder: str,
    n: int = 16,
    target: str = "canonical_disease",
    raw_target: str = "disease",
) -> DataFrame:
    """Answers to a few rows for reading, gaps filled from the metadata.

    Here an empty prediction counts as correct when the truth is empty too. Written as JSON.
    """
    scored = stage(score_batches(sample_rows(rows, n, key), load), "sample-answers")

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in rows.columns else F.lit("")

    parsed = scored.withColumn("_parsed", parse_answer("raw_output")).withColumn(
        "_truth", scoring_truth(target, raw_target if raw_target in rows.columns else None)
    )
    shown = parsed.select(
        known("filename").alias("filename"),
        known("crop").alias("crop"),
        F.col("_truth").alias("ground_truth_disease"),
        F.col("_parsed.diagnosis").alias("predicted_disease"),
        is_correct("_truth", "_parsed.diagnosis", require_nonempty=False).alias("is_correct"),
        F.col("_parsed.disease_type").alias("disease_type"),
        *[
            fill_from(f"_parsed.{name}", known(name)).alias(name)
            for name in ("plant_organ", "visual_symptoms", "pathogen")
        ],
        F.col("_parsed.raw_text").alias("raw_output"),
    )
    reports.write_json(shown, f"{folder.rstrip('/')}/demo_predictions")
    return shown


def compare_splits(bundles: dict[str, DataFrame], folder: str) -> DataFrame:
    """Scores side by side, one column per split; writes them rounded, N/A where missing."""
    named = [bundle.withColumn("split", F.lit(name)) for name, bundle in bundles.items()]
    together = named[0]
    for more in named[1:]:
        together = together.unionByName(more)
    table = metrics.side_by_side(together)
    reports.write_json(metrics.as_report_text(table, ["val", "test"]), f"{folder.rstrip('/')}/final_report")
    return table
