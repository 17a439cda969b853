"""Scores over (truth, prediction) pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.fixtures import EVENT_PAIRS_SQL, PART_PAIRS_SQL, event_pairs, part_pairs, sql_exact_sum, sql_normalize, sql_strip
from tallyloom.catalog.registry import query
from tallyloom.operators import metrics


def _pairs_sql(source: str) -> str:
    return f"""pairs AS (SELECT *, {sql_normalize('ground_truth')} AS gt, {sql_normalize('predicted')} AS pred,
        lower({sql_strip('ground_truth')}) = lower({sql_strip('predicted')}) AS exact FROM ({source}))"""


def _report_sql(by: str = "") -> str:
    """Class report over ``pairs``, per ``by`` columns (given with a trailing comma)."""
    return f"""tallies AS (SELECT {by} class, sum(s) AS support, sum(p) AS n_pred, sum(h) AS hits, sum(x) AS n_exact FROM (
            SELECT {by} gt AS class, 1 AS s, 0 AS p, CASE WHEN gt = pred THEN 1 ELSE 0 END AS h,
                CASE WHEN exact THEN 1 ELSE 0 END AS x FROM pairs
            UNION ALL SELECT {by} pred, 0, 1, 0, 0 FROM pairs) GROUP BY {by} class),
        report AS (SELECT {by} class, CAST(support AS BIGINT) AS support, CAST(hits AS BIGINT) AS hits,
            CAST(n_exact AS BIGINT) AS n_exact,
            CASE WHEN n_pred = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / n_pred END AS precision,
            CASE WHEN support = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / support END AS recall,
            CAST(2 * hits AS DOUBLE) / (support + n_pred) AS f1 FROM tallies)"""


def _sum_sql(value: str) -> str:
    return sql_exact_sum(value)


_MACRO_SQL = ", ".join(f"{_sum_sql(name)} / count(*) AS macro_{name}" for name in ("precision", "recall", "f1"))
_WEIGHTED_SQL = f"""{_sum_sql('precision * support')} / sum(support) AS weighted_precision,
    CAST(sum(hits) AS DOUBLE) / sum(support) AS weighted_recall,
    {_sum_sql('f1 * support')} / sum(support) AS weighted_f1"""
_BUNDLE_SQL = f"""CAST(sum(support) AS BIGINT) AS total_samples, count(*) FILTER (support > 0) AS num_classes_in_gt,
    CAST(sum(n_exact) AS DOUBLE) / sum(support) AS exact_match_accuracy,
    CAST(sum(hits) AS DOUBLE) / sum(support) AS normalized_accuracy, {_MACRO_SQL}, {_WEIGHTED_SQL}"""

_EVENTS = f"WITH {_pairs_sql(EVENT_PAIRS_SQL)}"
_EVENTS_REPORT = f"{_EVENTS}, {_report_sql()}"
_PARTS = f"WITH {_pairs_sql(PART_PAIRS_SQL)}"
_PARTS_REPORT = f"{_PARTS}, {_report_sql()}"


def event_counts(spark, sf_dir, by=()):
    return metrics.confusion_counts(event_pairs(spark, sf_dir), by=by)


def part_counts(spark, sf_dir):
    return metrics.confusion_counts(part_pairs(spark, sf_dir))


@query(
    "q_e_confusion_counts",
    f"""{_EVENTS} SELECT segment, gt, pred, count(*) AS n, count(*) FILTER (exact) AS n_exact
    FROM pairs GROUP BY ALL""",
)
def confusion_counts(spark, sf_dir):
    return event_counts(spark, sf_dir, ["segment"])


@query(
    "q_e3_sample_counts",
    f"{_EVENTS} SELECT count(*) AS total_samples, count(DISTINCT gt) AS num_classes_in_gt FROM pairs",
)
def sample_counts(spark, sf_dir):
    return metrics.sample_counts(event_counts(spark, sf_dir))


@query(
    "q_e4_accuracies",
    f"""{_EVENTS} SELECT CAST(count(*) FILTER (exact) AS DOUBLE) / count(*) AS exact_match_accuracy,
        CAST(count(*) FILTER (gt = pred) AS DOUBLE) / count(*) AS normalized_accuracy FROM pairs""",
)
def accuracies(spark, sf_dir):
    return metrics.accuracies(event_counts(spark, sf_dir))


@query("q_e5_class_report", f"{_EVENTS_REPORT} SELECT class, support, precision, recall, f1 FROM report")
def class_report(spark, sf_dir):
    return metrics.class_report(event_counts(spark, sf_dir))


@query("q_e5_class_report_wide", f"{_PARTS_REPORT} SELECT class, support, precision, recall, f1 FROM report")
def class_report_wide(spark, sf_dir):
    return metrics.class_report(part_counts(spark, sf_dir))


@query("q_e6_macro_scores", f"{_PARTS_REPORT} SELECT {_MACRO_SQL} FROM report")
def macro_scores(spark, sf_dir):
    return metrics.macro_scores(part_counts(spark, sf_dir))


@query("q_e7_weighted_scores", f"{_PARTS_REPORT} SELECT {_WEIGHTED_SQL} FROM report")
def weighted_scores(spark, sf_dir):
    return metrics.weighted_scores(part_counts(spark, sf_dir))


@query(
    "q_e8_segment_report",
    f"""WITH {_pairs_sql(EVENT_PAIRS_SQL).replace('SELECT *', '''SELECT * REPLACE
        (coalesce(segment, 'Unknown') AS segment)''', 1)}, {_report_sql('segment,')}
    SELECT segment, CAST(sum(support) AS BIGINT) AS samples, CAST(sum(hits) AS DOUBLE) / sum(support) AS accuracy,
        {_sum_sql('f1')} / count(*) AS macro_f1 FROM report GROUP BY segment""",
)
def segment_report(spark, sf_dir):
    return metrics.segment_report(event_counts(spark, sf_dir, ["segment"]))


@query(
    "q_e9_top_confusions",
    f"""{_PARTS} SELECT gt AS ground_truth, pred AS predicted, count(*) AS n FROM pairs WHERE gt <> pred
    GROUP BY gt, pred ORDER BY n DESC, gt, pred LIMIT 50""",
)
def top_confusions(spark, sf_dir):
    return metrics.top_confusions(part_counts(spark, sf_dir))


@query(
    "q_e10_confusion_matrix",
    f"""{_PARTS_REPORT}, top AS (SELECT class FROM report ORDER BY support DESC, class LIMIT 20),
        found AS (SELECT gt, pred, count(*) AS n FROM pairs GROUP BY gt, pred)
    SELECT a.class AS ground_truth, b.class AS predicted, coalesce(n, 0) AS n
    FROM top a CROSS JOIN top b LEFT JOIN found ON gt = a.class AND pred = b.class""",
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(part_counts(spark, sf_dir))


@query("q_e11_metric_bundle", f"{_PARTS_REPORT} SELECT {_BUNDLE_SQL} FROM report")
def metric_bundle(spark, sf_dir):
    return metrics.metric_bundle(part_counts(spark, sf_dir))


@query(
    "q_e14_side_by_side",
    f"""WITH {_pairs_sql(EVENT_PAIRS_SQL)}, {_report_sql('split,')},
        bundles AS (SELECT split, {_BUNDLE_SQL} FROM report GROUP BY split),
        long AS (UNPIVOT (SELECT split, {', '.join(metrics.COMPARED)} FROM bundles)
            ON {', '.join(metrics.COMPARED)} INTO NAME metric VALUE value)
    SELECT metric, max(value) FILTER (split = 'val') AS val, max(value) FILTER (split = 'test') AS test
    FROM long GROUP BY metric""",
)
def side_by_side(spark, sf_dir):
    return metrics.side_by_side(metrics.metric_bundle(event_counts(spark, sf_dir, ["split"]), ["split"]))
