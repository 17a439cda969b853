"""Training logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.fixtures import EVAL_ROWS_SQL, LOSS_ROWS_SQL, eval_rows, loss_rows, sql_exact_sum
from tallyloom.catalog.registry import query, table
from tallyloom.operators import history
from tallyloom.sources.workspace import new_folder
from tallyloom.streaming import progress_batches, stream_metadata


@query(
    "q_t1_best_checkpoint",
    f"""SELECT run, step AS best_step, macro_f1 AS best_metric FROM (SELECT *, row_number() OVER (
        PARTITION BY run ORDER BY macro_f1 DESC, step) AS rn FROM ({EVAL_ROWS_SQL}) WHERE NOT isnan(macro_f1))
    WHERE rn = 1""",
)
def best_checkpoint(spark, sf_dir):
    return history.best_checkpoint(eval_rows(spark, sf_dir))


@query(
    "q_t1_running_best",
    f"""WITH usable AS (SELECT *, CASE WHEN isnan(macro_f1) THEN NULL ELSE macro_f1 END AS v FROM ({EVAL_ROWS_SQL})),
        bars AS (SELECT *, greatest(-1.0, max(v) OVER (PARTITION BY run ORDER BY step
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS bar FROM usable)
    SELECT run, step, macro_f1, coalesce(v > bar, false) AS improved, greatest(bar, v) AS best_so_far FROM bars""",
)
def running_best(spark, sf_dir):
    return history.running_best(eval_rows(spark, sf_dir))


@query(
    "q_t1_running_best_by_time",
    """WITH log AS (SELECT user_id AS run, ts AS moment, max(value) AS score FROM events GROUP BY user_id, ts),
        bars AS (SELECT *, greatest(CAST(10 AS DOUBLE), max(score) OVER (PARTITION BY run ORDER BY moment
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS bar FROM log)
    SELECT run, moment, score, coalesce(score > bar, false) AS improved, greatest(bar, score) AS best_so_far FROM bars""",
)
def running_best_by_time(spark, sf_dir):
    """Times in place of step numbers: ranges hold as many rows however far apart the times are."""
    log = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("run"), F.col("ts").alias("moment"))
    log = log.agg(F.max("value").alias("score"))
    return history.running_best(log, step="moment", metric="score", floor=10.0, chunk=500)


ACCUMULATE = 4


@query(
    "q_t2_accumulation_windows",
    f"""WITH rows AS (SELECT *, NOT isnan(loss) AS finite, max(batch) OVER (PARTITION BY run, epoch) AS last
            FROM ({LOSS_ROWS_SQL})),
        marked AS (SELECT *, finite AND (batch % {ACCUMULATE} = 0 OR batch = last) AS closes FROM rows),
        numbered AS (SELECT *, coalesce(sum(CASE WHEN closes THEN 1 ELSE 0 END) OVER (PARTITION BY run, epoch
            ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS step FROM marked)
    SELECT run, epoch, max(batch) AS last_batch,
        {sql_exact_sum('CASE WHEN finite THEN loss END')} / {ACCUMULATE} AS step_loss
    FROM numbered GROUP BY run, epoch, step
    HAVING bool_or(closes) AND NOT bool_or(closes AND rejected)""",
)
def accumulation_windows(spark, sf_dir):
    return history.accumulation_windows(loss_rows(spark, sf_dir), ACCUMULATE, rejected="rejected")


_PROGRESS_SQL = """WITH timed AS (SELECT user_id AS run, event_id AS step, ts,
            date_diff('microsecond', min(ts) OVER (PARTITION BY user_id), ts) / CAST(1000000 AS DOUBLE) AS elapsed_seconds FROM events),
        rated AS (SELECT *, step / greatest(elapsed_seconds, CAST(0.00001 AS DOUBLE)) AS steps_per_second FROM timed)
    SELECT run, step, ts, elapsed_seconds, CAST(step AS DOUBLE) / 20000 * 100 AS pct, steps_per_second,
        (20000 - step) / greatest(steps_per_second, CAST(0.00001 AS DOUBLE)) AS eta_seconds,
        greatest(CAST(0 AS DOUBLE), 1000000 - elapsed_seconds) AS remaining_seconds,
        elapsed_seconds >= 1000000 AS budget_exceeded FROM rated"""


@query("q_t3_progress", _PROGRESS_SQL)
def progress(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), "ts")
    return history.progress(log, 20000, 1_000_000)


@query("q_t3_progress_stream", _PROGRESS_SQL)
def progress_stream(spark, sf_dir):
    """The log arrives in three parts by time; each part meets a stream that was stopped and goes on."""
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), "ts")
    micros, folder = F.unix_micros(F.col("ts").cast("timestamp")), new_folder(spark, "progress")
    first, second = log.agg(F.percentile_approx(micros, [1 / 3, 2 / 3])).first()[0] or (0, 0)
    handle = progress_batches(f"{folder}/out", f"{folder}/state", 20000, 1_000_000)
    part = F.when(micros <= first, 0).when(micros <= second, 1).otherwise(2)
    for number in range(3):
        log.where(part == number).write.mode("append").parquet(f"{folder}/log")
        arriving = stream_metadata(spark, f"{folder}/log", log.schema, log.columns)
        arriving = arriving.writeStream.foreachBatch(handle).option("checkpointLocation", f"{folder}/offsets")
        arriving.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


@query(
    "q_t4_wait_share",
    """WITH spans AS (SELECT user_id AS run, event_type IN ('view', 'click', 'signup') AS ready,
            coalesce(date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY event_id), ts), 0) AS span
            FROM events),
        sums AS (SELECT run, CAST(sum(CASE WHEN ready THEN span ELSE 0 END) AS BIGINT) AS wait,
            CAST(sum(CASE WHEN ready THEN 0 ELSE span END) AS BIGINT) AS compute FROM spans GROUP BY run)
    SELECT run, wait / CAST(1000000 AS DOUBLE) AS data_wait_seconds, compute / CAST(1000000 AS DOUBLE) AS compute_seconds,
        CASE WHEN (wait + compute) / CAST(1000000 AS DOUBLE) <= 0.000001 THEN 0
             ELSE CAST(wait AS DOUBLE) / CAST(wait + compute AS DOUBLE) * 100 END AS data_wait_pct FROM sums""",
)
def wait_share(spark, sf_dir):
    marks = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("event_id").alias("seq"), "ts", "event_type"
    )
    return history.wait_share(marks, F.col("event_type").isin("view", "click", "signup"))
