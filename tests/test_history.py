"""Training-log rollups against a direct replay, with chunks small enough to matter."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import history
from tallyloom.operators import ordered
from tallyloom.operators.ordered import exact_sum, running_before
from tallyloom.sources.workspace import stage
from tallyloom.streaming import progress_batches

NAN = float("nan")


@pytest.mark.parametrize("kind", ["sum", "max", "last"])
def test_running_before(spark, kind):
    draw = random.Random(1)
    rows = [(f"r{at % 3 if at % 5 else 0}" if at % 7 else None, at, draw.choice([None, 1, 5, -2, 7])) for at in range(400)]
    df = spark.createDataFrame(rows, "run string, seq long, x int").repartition(5)
    expected = {}
    for run in {row[0] for row in rows}:
        seen = []
        for _, seq, x in [row for row in rows if row[0] == run]:
            known = [value for value in seen if value is not None]
            expected[(run, seq)] = (
                None if not known else sum(known) if kind == "sum" else max(known) if kind == "max" else known[-1]
            )
            seen.append(x)
    for chunk in (7, 100_000):
        found = running_before(df, ["run"], "seq", kind, "x", "before", chunk).collect()
        assert {(row.run, row.seq): row.before for row in found} == expected


def test_sparse_steps_give_few_ranges(spark, monkeypatch):
    rows = [("hot" if at % 3 else f"r{at}", at * 1_000_000, float(at % 97)) for at in range(900)]
    df = spark.createDataFrame(rows, "run string, step long, x double")
    staged = []
    monkeypatch.setattr(ordered, "stage", lambda df, name, compact=False: staged.append(stage(df, name, compact)) or staged[-1])
    monkeypatch.setattr(ordered, "TEAM", 3)
    found = running_before(df, ["run"], "step", "max", "x", "before", 100).collect()
    assert staged[0].select("_range").distinct().count() <= 10
    assert staged[0].where("run = 'hot'").select("_range").distinct().count() >= 5
    best = None
    for row in sorted((row for row in found if row.run == "hot"), key=lambda row: row.step):
        assert row.before == best
        best = row.x if best is None else max(best, row.x)


@pytest.mark.parametrize("kind", ["sum", "max", "last"])
def test_small_ranges_share_a_task(spark, monkeypatch, kind):
    rows = [("hot" if at % 3 else f"r{at % 11}", at, None if at % 5 == 0 else (at * 37) % 97) for at in range(900)]
    df = spark.createDataFrame(rows, "run string, step long, x int")
    dealt = []
    by_range = type(df).repartitionByRange
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, n, *cols: dealt.append(n) or by_range(self, n, *cols))
    staged = []
    monkeypatch.setattr(ordered, "stage", lambda df, name, compact=False: staged.append(stage(df, name, compact)) or staged[-1])
    monkeypatch.setattr(ordered, "CHUNK", 200)
    monkeypatch.setattr(ordered, "TEAM", 3)
    found = running_before(df, ["run"], "step", kind, "x", "before", 10).collect()
    assert dealt == [5]
    ranges = staged[0].groupBy("_range").agg(F.count("*").alias("n"), F.min("step"), F.max("step")).collect()
    assert len(ranges) >= 90 and max(row.n for row in ranges) <= 10
    assert len(found) == 900
    for run in {row[0] for row in rows}:
        seen = []
        for row in sorted((row for row in found if row.run == run), key=lambda row: row.step):
            expected = {"sum": sum, "max": max, "last": lambda values: values[-1]}[kind](seen) if seen else None
            assert row.before == expected
            seen += [] if row.x is None else [row.x]


@pytest.mark.parametrize("kind", ["timestamp", "date", "string", "double"])
def test_order_of_any_type(spark, kind):
    made = {"timestamp": "timestamp_seconds(id * 3601)", "date": "date_add(DATE'2020-01-01', cast(id as int))",
            "string": "lpad(id, 5, '0')", "double": "id / 7D"}[kind]
    df = spark.range(60).selectExpr("'r' AS run", f"{made} AS at", "id AS x")
    assert {row.x: row.before for row in running_before(df, ["run"], "at", "last", "x", "before", 9).collect()} == {
        x: x - 1 if x else None for x in range(60)
    }


def test_exact_sum_is_the_same_in_any_order(spark):
    draw = random.Random(6)
    values = [draw.choice([1, -1]) * draw.random() * 2.0 ** draw.randrange(-30, 50) for _ in range(3000)] + [0.1] * 500 + [1e17, 1e-12]
    sums = set()
    for seed in range(3):
        draw.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(seed + 1)
        sums.add(df.agg(exact_sum("x")).first()[0])
    assert sums == {math.fsum(values)}
    odd = spark.createDataFrame([("a", None), ("b", 1e300), ("b", 2.0), ("c", -0.5), ("c", None)], "g string, x double")
    assert {r[0]: r[1] for r in odd.groupBy("g").agg(exact_sum("x")).collect()} == {"a": None, "b": 1e300, "c": -0.5}


def test_a_window_that_never_closes_stays_split(spark):
    """Batches 1, 11, 21, ... never fall on a closing position: one step, added without gathering its losses."""
    df = spark.range(5000).selectExpr("'r' AS run", "0 AS epoch", "id * 10 + 1 AS batch", "CAST(0.1 AS DOUBLE) AS loss")
    found = history.accumulation_windows(df, 4, chunk=300)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    assert [tuple(r) for r in found.collect()] == [("r", 0, 49991, math.fsum([0.1] * 5000) / 4)]


def test_best_checkpoint(spark):
    log = [("a", 1, 0.5), ("a", 2, NAN), ("a", 3, 0.7), ("a", 4, 0.7), ("a", 5, 0.1), ("b", 1, NAN), ("c", 9, 0.0), ("d", 1, -1.0)]
    df = spark.createDataFrame(log, "run string, step int, macro_f1 double")
    best = {row.run: (row.best_step, row.best_metric) for row in history.best_checkpoint(df).collect()}
    assert best == {"a": (3, 0.7), "c": (9, 0.0)}
    running = {(row.run, row.step): (row.improved, row.best_so_far) for row in history.running_best(df, chunk=2).collect()}
    assert [running[("a", step)] for step in range(1, 6)] == [(True, 0.5), (False, 0.5), (True, 0.7), (False, 0.7), (False, 0.7)]
    assert running[("b", 1)] == (False, -1.0) and running[("d", 1)] == (False, -1.0)


def replay(batches, accumulate, total):
    """Losses of the optimizer steps of one epoch."""
    steps, pending = [], 0.0
    for number, loss, rejected in batches:
        if loss is None or not math.isfinite(loss):
            continue
        pending += loss
        if number % accumulate == 0 or number == total:
            if not rejected:
                steps.append((number, pending / accumulate))
            pending = 0.0
    return steps


@pytest.mark.parametrize("accumulate", [1, 3, 4])
@pytest.mark.parametrize("planned", [None, 50])
def test_accumulation_windows(spark, accumulate, planned):
    draw = random.Random(accumulate)
    rows, expected = [], {}
    for epoch in range(12):
        length = draw.choice([1, 2, 7, 12, 50])
        batches = [
            (at, draw.choice([1.0, 0.5, 2.25, NAN, float("inf"), None]), draw.random() < 0.2) for at in range(1, length + 1)
        ]
        rows += [("r", epoch, *batch) for batch in batches]
        for number, loss in replay(batches, accumulate, planned or length):
            expected[(epoch, number)] = loss
    df = spark.createDataFrame(rows, "run string, epoch int, batch int, loss double, bad boolean").repartition(4)
    found = history.accumulation_windows(df, accumulate, rejected="bad", total_batches=planned, chunk=3).collect()
    assert {(row.epoch, row.last_batch): row.step_loss for row in found} == pytest.approx(expected)
    assert len(found) == len(expected)


def test_progress(spark):
    start = datetime(2024, 1, 1)
    log = [("a", 0, start), ("a", 5, start + timedelta(seconds=10)), ("a", 20, start + timedelta(seconds=40))]
    df = spark.createDataFrame(log, "run string, step int, ts timestamp")
    rows = {row.step: row for row in history.progress(df, 20, 30.0).collect()}
    middle, last = rows[5], rows[20]
    assert (middle.elapsed_seconds, middle.pct, middle.steps_per_second, middle.eta_seconds) == (10.0, 25.0, 0.5, 30.0)
    assert (middle.remaining_seconds, middle.budget_exceeded) == (20.0, False)
    assert (last.remaining_seconds, last.budget_exceeded, last.eta_seconds) == (0.0, True, 0.0)
    assert rows[0].eta_seconds == pytest.approx(20 / 1e-5)
    given = history.progress(df.withColumn("begun", F.lit(start - timedelta(seconds=5))), 0, 30.0, start="begun")
    assert {row.step: row.elapsed_seconds for row in given.collect()} == {0: 5.0, 5: 15.0, 20: 45.0}
    assert {row.step: row.pct for row in given.collect()}[5] == 500.0


def test_wait_share(spark):
    start = datetime(2024, 1, 1)
    seconds = [0, 3, 4, 10, 10]
    marks = [("a", at, start + timedelta(seconds=second), at % 2 == 1) for at, second in enumerate(seconds)]
    marks += [("b", 0, start, True)]
    df = spark.createDataFrame(marks, "run string, seq int, ts timestamp, ready boolean")
    for chunk in (2, 1000):
        rows = {row.run: tuple(row)[1:] for row in history.wait_share(df, F.col("ready"), chunk=chunk).collect()}
        assert rows["a"] == (9.0, 1.0, 90.0)
        assert rows["b"] == (0.0, 0.0, 0.0)


def test_accumulation_of_huge_and_tiny_losses(spark):
    rows = [("r", 0, 1, 1e17), ("r", 0, 2, 1.0), ("r", 0, 3, 1e-13), ("r", 0, 4, 2e-13)]
    df = spark.createDataFrame(rows, "run string, epoch int, batch int, loss double")
    found = sorted(row.step_loss for row in history.accumulation_windows(df, 2, total_batches=4).collect())
    assert found == [(1e-13 + 2e-13) / 2, (1e17 + 1.0) / 2]


def arriving(spark, tmp_path, rows, splits, **options):
    """Rows through ``progress_batches`` in the given parts, the second part twice."""
    schema = "run string, step long, ts timestamp, score double"
    write = progress_batches(f"{tmp_path}/out", f"{tmp_path}/state", 40, 30.0, metric="score", **options)
    for number, (low, high) in enumerate(zip(splits, splits[1:])):
        for _ in range(2 if number == 1 else 1):
            write(spark.createDataFrame(rows[low:high], schema), number)
    return spark.createDataFrame(rows, schema), spark.read.parquet(f"{tmp_path}/out").drop("batch")


@pytest.mark.parametrize("splits", [(0, 40), (0, 1, 7, 40), (0, 20, 20, 39, 40)])
def test_progress_of_arriving_rows_equals_the_batch_operators(spark, tmp_path, splits):
    base = datetime(2024, 1, 1)
    names = ["a", None, "a", "b"]
    scores = [0.2, float("nan"), None, 0.1, 0.7, 0.7, -3.0]
    rows = [(names[i % 4], i, base + timedelta(seconds=3 * i), scores[i % 7] and scores[i % 7] * (1 + i // 14)) for i in range(40)]
    log, found = arriving(spark, tmp_path, rows, splits)
    whole = history.running_best(history.progress(log, 40, 30.0), metric="score")
    assert found.columns == whole.columns
    text = [F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")]
    assert sorted(r.row for r in found.select(text).collect()) == sorted(r.row for r in whole.select(text).collect())


def test_silent_runs_are_forgotten(spark, tmp_path):
    base = datetime(2024, 1, 1)
    rows = [("a", 1, base, 0.5), ("b", 2, base + timedelta(seconds=100), 0.5), ("b", 3, base + timedelta(seconds=110), 0.4), ("a", 4, base + timedelta(seconds=120), 0.1)]
    log, found = arriving(spark, tmp_path, rows, (0, 2, 3, 4), timeout_seconds=60.0)
    got = {row.step: (row.elapsed_seconds, row.improved, row.best_so_far) for row in found.collect()}
    assert got == {1: (0.0, True, 0.5), 2: (0.0, True, 0.5), 3: (10.0, False, 0.5), 4: (0.0, True, 0.1)}
    state = spark.read.parquet(f"{tmp_path}/state")
    assert {row.run for row in state.where("batch = 1").collect()} == {"b"}
