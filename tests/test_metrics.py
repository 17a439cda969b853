"""Scores against direct counting."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import metrics
from tallyloom.operators.records import FIELDS, evaluation_records, failures
from tallyloom.operators.statistics import class_distribution, dataset_statistics, job_tallies

PAIRS = [
    ("Rust", "rust", "a"),
    ("Rust", "Rust.", "a"),
    ("Rust", "blight", "b"),
    ("Leaf-Spot", "leaf spot", None),
    ("Blight", "invented", "b"),
    ("", "", "a"),
    ("accuracy", "accuracy", "c"),
    ("Smut", "", "c"),
]


@pytest.fixture(scope="module")
def counts(spark):
    pairs = spark.createDataFrame(PAIRS, "ground_truth string, predicted string, segment string")
    return metrics.confusion_counts(pairs, by=["segment"]).cache()


NORMAL = [(g.lower().replace("-", " "), p.lower().strip(".")) for g, p, _ in PAIRS]


def scores(pairs):
    support, predicted = Counter(g for g, _ in pairs), Counter(p for _, p in pairs)
    hits = Counter(g for g, p in pairs if g == p)
    report = {}
    for name in set(support) | set(predicted):
        precision = hits[name] / predicted[name] if predicted[name] else 0.0
        recall = hits[name] / support[name] if support[name] else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        report[name] = (support[name], precision, recall, f1)
    return report


def test_class_report(counts):
    found = {row["class"]: (row.support, row.precision, row.recall, row.f1) for row in metrics.class_report(counts).collect()}
    expected = scores(NORMAL)
    assert set(found) == set(expected) and {"invented", "accuracy", ""} <= set(found)
    for name, values in expected.items():
        assert found[name] == pytest.approx(values)


def test_bundle(counts):
    row = metrics.metric_bundle(counts).first()
    report = scores(NORMAL).values()
    total = len(PAIRS)
    assert list(row.asDict()) == metrics.SCORES
    assert row.total_samples == total and row.num_classes_in_gt == 6
    assert row.exact_match_accuracy == 3 / total
    assert row.normalized_accuracy == row.weighted_recall == 5 / total
    for at, name in enumerate(("precision", "recall", "f1"), 1):
        assert row[f"macro_{name}"] == pytest.approx(sum(v[at] for v in report) / len(report))
        assert row[f"weighted_{name}"] == pytest.approx(sum(v[0] * v[at] for v in report) / total)
    small = metrics.sample_counts(counts).first()
    assert (small.total_samples, small.num_classes_in_gt) == (total, 6)
    assert tuple(metrics.accuracies(counts).first()) == (3 / total, 5 / total)


def test_segments(counts):
    groups = defaultdict(list)
    for pair, (_, _, segment) in zip(NORMAL, PAIRS):
        groups[segment or "Unknown"].append(pair)
    found = {row.segment: row for row in metrics.segment_report(counts).collect()}
    assert set(found) == set(groups)
    for name, pairs in groups.items():
        report = scores(pairs).values()
        assert found[name].samples == len(pairs)
        assert found[name].accuracy == pytest.approx(sum(g == p for g, p in pairs) / len(pairs))
        assert found[name].macro_f1 == pytest.approx(sum(v[3] for v in report) / len(report))


def test_confusions_and_matrix(counts):
    found = [tuple(row) for row in metrics.top_confusions(counts).collect()]
    assert found == [("blight", "invented", 1), ("rust", "blight", 1), ("smut", "", 1)]
    matrix = {(row.ground_truth, row.predicted): row.n for row in metrics.confusion_matrix(counts, 3).collect()}
    top = sorted(scores(NORMAL).items(), key=lambda item: (-item[1][0], item[0]))[:3]
    names = [name for name, _ in top]
    assert matrix == {(g, p): Counter(NORMAL)[(g, p)] for g in names for p in names}
    one = counts.where("gt = 'accuracy'")
    assert metrics.confusion_matrix(one).count() == 0


def test_empty_input(spark):
    nothing = metrics.confusion_counts(spark.createDataFrame([], "ground_truth string, predicted string"))
    row = metrics.metric_bundle(nothing).first()
    assert row.total_samples == 0 and row.normalized_accuracy is None and row.macro_f1 is None
    assert metrics.class_report(nothing).count() == 0


def test_counts_add_up_to_rows(counts):
    assert counts.agg(F.sum("n")).first()[0] == len(PAIRS)


def test_side_by_side_with_a_missing_split(counts):
    bundle = metrics.metric_bundle(counts).withColumn("split", F.lit("val"))
    table = metrics.side_by_side(bundle)
    assert table.count() == len(metrics.COMPARED)
    shown = {row.metric: (row.val, row.test) for row in metrics.as_report_text(table, ["val", "test"]).collect()}
    assert shown["normalized_accuracy"] == ("0.625", "N/A")


def test_records(spark):
    answers = spark.createDataFrame(
        [
            (1, "Rice", "Rust", "raw", "Diagnosis: rust.\nOrgan: leaf", "f.jpg"),
            (2, None, "", "Blight", "", None),
            (3, "Rice", None, None, "Diagnosis: smut", "g.jpg"),
        ],
        "id int, crop string, canonical_disease string, disease string, raw_output string, filename string",
    )
    found = {row.id: row for row in evaluation_records(answers, "id").collect()}
    assert list(found[1].asDict()) == ["id", *FIELDS]
    assert (found[1].predicted, found[1].is_correct, found[1].predicted_organ, found[1].plant_organ) == ("rust", True, "leaf", "")
    assert (found[2].crop, found[2].ground_truth, found[2].predicted, found[2].is_correct) == ("Unknown", "Blight", "", False)
    assert found[3].ground_truth == "Unknown"
    unnamed = evaluation_records(answers.drop("filename"), "id")
    assert {row.filename for row in unnamed.collect()} == {"sample_1", "sample_2", "sample_3"}
    assert {row.id for row in failures(evaluation_records(answers, "id")).collect()} == {2, 3}


def test_statistics(spark):
    rows = [("a", "s", "train", "leaf")] * 4 + [("b", None, "val", "n/a")] * 2 + [("c", "t", "test", None), (None, "s", "train", "x")]
    df = spark.createDataFrame(rows, "class string, crop string, split string, organ string")
    row = dataset_statistics(df, 100, "class", "crop", ["organ"]).first()
    assert row.asDict() == {
        "total_source_rows": 100,
        "selected_total_rows": 8,
        "selected_train_rows": 5,
        "selected_val_rows": 2,
        "selected_test_rows": 1,
        "num_classes": 3,
        "median_samples_per_class": 2.0,
        "min_samples_per_class": 1,
        "max_samples_per_class": 4,
        "rows_with_organ": 5,
        "num_segments": 2,
    }
    assert dataset_statistics(df, 1, "class").first().num_segments == 0
    spread = {row["class"]: tuple(row)[1:] for row in class_distribution(df, "class").collect()}
    assert spread == {"a": (4, 4, 0, 0), "b": (2, 0, 2, 0), "c": (1, 0, 0, 1)}


def test_job_tallies(spark):
    outcome = spark.createDataFrame([("p", 10, None), (None, None, "bad"), ("q", 5, None)], "image_path string, n_bytes long, error string")
    assert tuple(job_tallies(outcome).first()) == (2, 3, 15, 1)
