"""Rollups over training logs.

One long run may hold most of a log, so no step gathers a run in one task: totals are plain
aggregates and running values go through :func:`tallyloom.operators.ordered.running_before`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordered import CHUNK, exact_sum, join_groups, running_before
from tallyloom.sources.workspace import stage


def _finite(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def _usable(metric: str) -> Column:
    # NaN sorts above every number in Spark, while a comparison with NaN never wins.
    return F.col(metric).isNotNull() & ~F.isnan(metric)


def best_checkpoint(
    log: DataFrame, by: Sequence[str] = ("run",), step: str = "step", metric: str = "macro_f1", floor: float = -1.0
) -> DataFrame:
    """The earliest row of the largest metric above ``floor`` per run."""
    best = F.max(F.struct(F.col(metric).alias("metric"), (-F.col(step)).alias("late")))
    return (
        log.where(_usable(metric) & (F.col(metric) > floor))
        .groupBy(*by)
        .agg(best.alias("_best"))
        .select(*by, (-F.col("_best.late")).alias("best_step"), F.col("_best.metric").alias("best_metric"))
    )


def running_best(
    log: DataFrame,
    by: Sequence[str] = ("run",),
    step: str = "step",
    metric: str = "macro_f1",
    floor: float = -1.0,
    chunk: int = CHUNK,
) -> DataFrame:
    """Every evaluation with the best metric so far and whether it improved on it. ``step``: a number or a time."""
    value = F.when(_usable(metric), F.col(metric))
    before = running_before(log, by, step, "max", value, "_before", chunk)
    bar = F.greatest(F.col("_before"), F.lit(floor))
    return before.select(
        *log.columns,
        F.coalesce(value > bar, F.lit(False)).alias("improved"),
        F.greatest(bar, value).alias("best_so_far"),
    )


def accumulation_windows(
    log: DataFrame,
    accumulate: int,
    by: Sequence[str] = ("run", "epoch"),
    batch: str = "batch",
    loss: str = "loss",
    rejected: str | None = None,
    total_batches: int | Column | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per optimizer step with its loss, the sum of its batches over ``accumulate``.

    A batch whose loss is not finite is skipped and, when it falls on the closing position, leaves
    its window open: the window then runs on to the next closing batch. A short last window is
    closed by the last batch and still divided by ``accumulate``. ``rejected`` marks batches whose
    gradient was refused; at a closing position the window ends without a step.

    ``total_batches`` is the planned number of batches per epoch; without it the last logged batch
    counts as the last.
    """
    planned = F.lit(total_batches) if total_batches is None or isinstance(total_batches, int) else total_batches
    finite = _finite(loss)
    refused = F.lit(False) if rejected is None else F.coalesce(F.col(rejected), F.lit(False))
    # Batch number and its two flags as one number: its maximum tells about the last batch, and
    # a plain maximum keeps the aggregation hash-based.
    mark = F.col(batch).cast("bigint") * 4 + F.when(finite, 2).otherwise(0) + F.when(refused, 1).otherwise(0)
    rows = log.select(
        *by,
        F.col(batch).cast("bigint").alias("_batch"),
        F.when(finite, F.col(loss).cast("double")).alias("_loss"),
        mark.alias("_mark"),
        planned.cast("bigint").alias("_planned"),
    )
    last, is_finite, is_refused = (
        F.shiftright("_mark", 2),
        F.col("_mark").bitwiseAND(F.lit(2)) > 0,
        F.col("_mark").bitwiseAND(F.lit(1)) > 0,
    )
    rows = rows.withColumn("_window", F.expr(f"(_batch + {accumulate - 1}) div {accumulate}"))
    # Which nominal windows close: one flag per window, combined on the map side.
    nominal = (
        rows.groupBy(*by, "_window")
        .agg(F.max("_mark").alias("_mark"))
        .select(*by, "_window", (is_finite & (last % accumulate == 0)).cast("bigint").alias("_closes"))
    )
    # An open window joins the following ones up to the first that closes.
    joined = running_before(nominal, by, "_window", "sum", "_closes", "_closed_before", chunk)
    joined = joined.select(*by, "_window", "_closes", F.coalesce("_closed_before", F.lit(0)).alias("_step"))
    # Losses meet the number of their step; a step without end is a sum like any other, added on the map side.
    numbered = join_groups(rows, joined, [*by, "_window"])
    steps = numbered.groupBy(*by, "_step").agg(
        exact_sum("_loss").alias("_total"),
        F.max("_mark").alias("_mark"),
        F.max("_closes").alias("_closes"),
        F.max("_planned").alias("_planned"),
    )
    ended = (F.col("_closes") == 1) | F.coalesce(last == F.col("_planned"), F.col("_planned").isNull())
    return steps.where(ended & is_finite & ~is_refused).select(
        *by, last.alias("last_batch"), (F.col("_total") / accumulate).alias("step_loss")
    )


def _micros(start: Column, end: Column, kind: str) -> Column:
    """Microseconds from ``start`` to ``end``, whatever the time zone of the session."""
    if kind == "timestamp":
        return F.unix_micros(end) - F.unix_micros(start)
    # Times without a zone: their difference is an interval, free of daylight saving.
    span = end - start

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), span)

    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("bigint")


def progress(
    log: DataFrame,
    total_steps: int | Column,
    budget_seconds: float,
    by: Sequence[str] = ("run",),
    step: str = "step",
    ts: str = "ts",
    start: str | None = None,
) -> DataFrame:
    """Elapsed and remaining seconds, percentage, rate and time to go for every log row.

    ``start`` names a column with the start of the run; without it a run starts with its first
    row, found by an aggregate and joined back. The starts are staged: the join then broadcasts
    them when they are small, and otherwise reads two plain shuffles, which adaptive execution can
    split where one run is hot.
    """
    if start is None:
        starts = stage(log.groupBy(*by).agg(F.min(ts).alias("_start")), "run-starts")
        timed = join_groups(log, starts, by)
    else:
        timed = log.withColumn("_start", F.col(start))
    total = total_steps if isinstance(total_steps, Column) else F.lit(total_steps)
    done = F.col(step).cast("double")
    timed = timed.withColumn("elapsed_seconds", _micros(F.col("_start"), F.col(ts), dict(log.dtypes)[ts]) / F.lit(1e6))
    elapsed = F.col("elapsed_seconds")
    rate = done / F.greatest(elapsed, F.lit(1e-5))
    return timed.select(
        *log.columns,
        "elapsed_seconds",
        (done / F.greatest(total, F.lit(1)).cast("double") * F.lit(100.0)).alias("pct"),
        rate.alias("steps_per_second"),
        ((total.cast("double") - done) / F.greatest(rate, F.lit(1e-5))).alias("eta_seconds"),
        F.greatest(F.lit(0.0), F.lit(float(budget_seconds)) - elapsed).alias("remaining_seconds"),
        (elapsed >= F.lit(float(budget_seconds))).alias("budget_exceeded"),
    )


def wait_share(
    marks: DataFrame,
    data_ready: Column,
    by: Sequence[str] = ("run",),
    order: str = "seq",
    ts: str = "ts",
    start: str | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """T4: seconds spent before "data ready" and before "compute finished" marks, per run.

    Each mark ends the span since the mark before it; ``order`` numbers the marks of a run.
    Without ``start`` the first mark of a run ends no span.
    """
    timed = running_before(marks.withColumn("_ready", data_ready), by, order, "last", ts, "_previous", chunk)
    previous = F.col("_previous") if start is None else F.coalesce("_previous", start)
    spans = timed.select(*by, "_ready", F.coalesce(_micros(previous, F.col(ts), dict(marks.dtypes)[ts]), F.lit(0)).alias("_span"))
    sums = spans.groupBy(*by).agg(
        F.sum(F.when(F.col("_ready"), F.col("_span")).otherwise(0)).alias("_wait"),
        F.sum(F.when(F.col("_ready"), 0).otherwise(F.col("_span"))).alias("_compute"),
    )
    wait, compute = F.col("_wait") / F.lit(1e6), F.col("_compute") / F.lit(1e6)
    both = (F.col("_wait") + F.col("_compute")) / F.lit(1e6)
    return sums.select(
        *by,
        wait.alias("data_wait_seconds"),
        compute.alias("compute_seconds"),
        F.when(both <= 1e-6, F.lit(0.0))
        .otherwise(F.try_divide(F.col("_wait").cast("double"), (F.col("_wait") + F.col("_compute")).cast("double")) * 100.0)
        .alias("data_wait_pct"),
    )
