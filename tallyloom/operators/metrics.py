"""Scores from counts of (truth, prediction) pairs.

``confusion_counts`` is the only step over the full data: one aggregation that combines on the
map side, so frequent labels do not skew it. All scores derive from its result. Stage it when
several reports are wanted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.constants import UNKNOWN
from tallyloom.functions.text import exact_match, normalize_label
from tallyloom.operators.ordered import exact_sum
from tallyloom.sources.workspace import stage

# Names of the ten summary scores, in report order.
SCORES = [
    "total_samples",
    "num_classes_in_gt",
    "exact_match_accuracy",
    "normalized_accuracy",
    "macro_precision",
    "macro_recall",
    "macro_f1",
    "weighted_precision",
    "weighted_recall",
    "weighted_f1",
]
# Scores of the side-by-side report.
COMPARED = [
    "exact_match_accuracy",
    "normalized_accuracy",
    "macro_precision",
    "macro_recall",
    "macro_f1",
    "weighted_f1",
]
TOP_CONFUSIONS = 50
MATRIX_CLASSES = 20


def confusion_counts(
    pairs: DataFrame,
    truth: str = "ground_truth",
    predicted: str = "predicted",
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts per normalized pair: ``by..., gt, pred, n, n_exact``.

    ``n_exact`` counts rows whose raw texts match (C11); normalizing loses that.
    """
    return (
        pairs.select(
            *by,
            normalize_label(truth).alias("gt"),
            normalize_label(predicted).alias("pred"),
            exact_match(truth, predicted).cast("bigint").alias("_exact"),
        )
        .groupBy(*by, "gt", "pred")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_exact").alias("n_exact"))
    )


def class_tallies(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per class of truth or prediction: support, times predicted, hits, exact hits.

    Each pair adds to the class of its truth and to that of its prediction, so both marginals
    and the diagonal come out of one aggregation; no join is needed.
    """
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    hit = F.col("gt") == F.col("pred")

    def side(label: str, support: Column, predicted: Column, hits: Column, exact: Column) -> Column:
        return F.struct(
            F.col(label).alias("class"),
            support.alias("support"),
            predicted.alias("n_pred"),
            hits.alias("hits"),
            exact.alias("n_exact"),
        )

    halves = F.array(
        side("gt", n, zero, F.when(hit, n).otherwise(zero), F.col("n_exact")),
        side("pred", zero, n, zero, zero),
    )
    return (
        counts.select(*by, F.explode(halves).alias("_side"))
        .select(*by, "_side.*")
        .groupBy(*by, "class")
        .agg(*[F.sum(name).alias(name) for name in ("support", "n_pred", "hits", "n_exact")])
    )


def _ratio(part: Column | str, whole: Column | str) -> Column:
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


PRECISION = ("hits", "n_pred")
RECALL = ("hits", "support")


def _f1() -> Column:
    return _ratio(F.col("hits") * 2, F.col("support") + F.col("n_pred"))


def class_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """E5: class, support, precision, recall, F1; zero where a division has no meaning.

    Holds classes that were only predicted, with support 0, and a class of any name. For a file,
    order by support descending, then class.
    """
    return class_tallies(counts, by).select(
        *by,
        "class",
        "support",
        _ratio(*PRECISION).alias("precision"),
        _ratio(*RECALL).alias("recall"),
        _f1().alias("f1"),
    )


def sample_counts(counts: DataFrame) -> DataFrame:
    """Rows and distinct normalized truths (an empty label is a class)."""
    per_truth = counts.groupBy("gt").agg(F.sum("n").alias("n"))
    return per_truth.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_samples"),
        F.count(F.lit(1)).alias("num_classes_in_gt"),
    )


def accuracies(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of exact and of normalized matches; null when there are no rows."""
    total = F.sum("n").cast("double")
    hits = F.sum(F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0)).cast("double")
    scores = [
        F.try_divide(F.sum("n_exact").cast("double"), total).alias("exact_match_accuracy"),
        F.try_divide(hits, total).alias("normalized_accuracy"),
    ]
    return counts.groupBy(*by).agg(*scores) if by else counts.agg(*scores)


def _macro(value: Column) -> Column:
    return F.try_divide(exact_sum(value), F.count(F.lit(1)).cast("double"))


def _weighted(value: Column) -> Column:
    return F.try_divide(exact_sum(value * F.col("support")), F.sum("support").cast("double"))


def _macro_scores() -> list[Column]:
    return [
        _macro(_ratio(*PRECISION)).alias("macro_precision"),
        _macro(_ratio(*RECALL)).alias("macro_recall"),
        _macro(_f1()).alias("macro_f1"),
    ]


def _weighted_scores() -> list[Column]:
    return [
        _weighted(_ratio(*PRECISION)).alias("weighted_precision"),
        # Recall times support is the number of hits, so the weighted recall needs no rounding.
        F.try_divide(F.sum("hits").cast("double"), F.sum("support").cast("double")).alias("weighted_recall"),
        _weighted(_f1()).alias("weighted_f1"),
    ]


def macro_scores(counts: DataFrame) -> DataFrame:
    """Plain means over the classes of truth and prediction together."""
    return class_tallies(counts).agg(*_macro_scores())


def weighted_scores(counts: DataFrame) -> DataFrame:
    """Means weighted by support."""
    return class_tallies(counts).agg(*_weighted_scores())


def metric_bundle(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All ten scores, unrounded, in one row (per ``by``)."""
    total = F.sum("support").cast("double")
    scores = [
        F.coalesce(F.sum("support"), F.lit(0)).alias("total_samples"),
        F.count_if(F.col("support") > 0).alias("num_classes_in_gt"),
        F.try_divide(F.sum("n_exact").cast("double"), total).alias("exact_match_accuracy"),
        F.try_divide(F.sum("hits").cast("double"), total).alias("normalized_accuracy"),
        *_macro_scores(),
        *_weighted_scores(),
    ]
    tallies = class_tallies(counts, by)
    return tallies.groupBy(*by).agg(*scores) if by else tallies.agg(*scores)


def segment_name(segment: Column | str) -> Column:
    """Segment as text; a missing one is "Unknown"."""
    segment = F.col(segment) if isinstance(segment, str) else segment
    return F.coalesce(segment.cast("string"), F.lit(UNKNOWN))


def segment_report(counts: DataFrame, segment: str = "segment") -> DataFrame:
    """Samples, accuracy and macro F1 per segment, over the classes seen in that segment.

    For a file, order by samples descending, then segment.
    """
    named = counts.withColumn(segment, segment_name(segment))
    total = F.sum("support")
    return (
        class_tallies(named, [segment])
        .groupBy(segment)
        .agg(
            total.alias("samples"),
            F.try_divide(F.sum("hits").cast("double"), total.cast("double")).alias("accuracy"),
            _macro(_f1()).alias("macro_f1"),
        )
    )


def top_confusions(counts: DataFrame, n: int = TOP_CONFUSIONS) -> DataFrame:
    """The ``n`` most frequent pairs that differ; ties in the order of the labels."""
    return (
        counts.where(F.col("gt") != F.col("pred"))
        .groupBy("gt", "pred")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "gt", "pred")
        .limit(n)
        .select(F.col("gt").alias("ground_truth"), F.col("pred").alias("predicted"), "n")
    )


def confusion_matrix(counts: DataFrame, k: int = MATRIX_CLASSES) -> DataFrame:
    """Counts between the ``k`` classes of largest support, zeros included, in long form.

    Pairs with another class are left out; fewer than two classes give no matrix. The frame of
    cells grows from the one array of class names, so it has at most ``k`` squared rows. The pairs
    are counted and written once, as both the ranking and the cells read them.
    """
    sums = [F.sum(name).alias(name) for name in ("n", "n_exact")]
    counts = stage(counts.groupBy("gt", "pred").agg(*sums), "pairs")
    top = (
        class_tallies(counts)
        .orderBy(F.desc("support"), "class")
        .limit(k)
        .agg(F.sort_array(F.collect_list("class")).alias("classes"))
        .where(F.size("classes") >= 2)
    )
    cells = top.select("classes", F.explode("classes").alias("gt")).select(
        "gt", F.explode("classes").alias("pred")
    )
    return cells.join(counts.drop("n_exact"), ["gt", "pred"], "left").select(
        F.col("gt").alias("ground_truth"),
        F.col("pred").alias("predicted"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def side_by_side(
    bundles: DataFrame,
    split: str = "split",
    splits: Sequence[str] = ("val", "test"),
    scores: Sequence[str] = COMPARED,
) -> DataFrame:
    """One row per score, one column per split; null where a split has no scores."""
    long = bundles.unpivot([split], list(scores), "metric", "value")
    return long.groupBy("metric").pivot(split, list(splits)).agg(F.max("value"))


def as_report_text(table: DataFrame, columns: Sequence[str], places: int = 4) -> DataFrame:
    """Scores as text, rounded, with N/A for a missing one."""
    shown = {
        name: F.coalesce(F.bround(F.col(name), places).cast("string"), F.lit("N/A")) for name in columns
    }
    return table.withColumns(shown)
