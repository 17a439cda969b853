"""Sampling, splitting and dataset statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.fixtures import DOCUMENT_ROWS_SQL, document_rows, sql_informative, sql_rank, sql_strip
from tallyloom.catalog.registry import query, table
from tallyloom.functions.text import class_name
from tallyloom.operators import sampling
from tallyloom.operators.statistics import class_distribution, dataset_statistics

MIN_ROWS, MAX_ROWS = 20, 120

_NAMED = f"named AS (SELECT doc_id, {sql_strip('''coalesce(target, 'Unknown')''')} AS target, segment, organ FROM ({DOCUMENT_ROWS_SQL}))"
_BALANCED = f"""{_NAMED}, ranked AS (SELECT *, {sql_rank('doc_id', 'balance', 'target')} AS rn,
    count(*) OVER (PARTITION BY target) AS n FROM named),
    balanced AS (SELECT doc_id, target, segment, organ FROM ranked
    WHERE n <= {MIN_ROWS} OR rn <= {MAX_ROWS})"""


def _ladder_sql(source: str, key: str, target: str, val: float, test: float) -> str:
    """Splits of ``source`` by the ladder; adds column ``split``."""
    return f"""(SELECT * EXCLUDE (n, rn, v0, t0, v, t),
        CASE WHEN n = 1 THEN 'train'
             WHEN n = 2 THEN CASE WHEN rn = 1 THEN 'train' ELSE 'val' END
             WHEN rn <= v THEN 'val' WHEN rn <= v + t THEN 'test' ELSE 'train' END AS split
    FROM (SELECT *, CASE WHEN n <= 5 THEN 1 WHEN v0 + t0 >= n THEN greatest(1, (n - 1) // 2) ELSE v0 END AS v,
                    CASE WHEN n <= 5 THEN 1 WHEN v0 + t0 >= n
                         THEN greatest(1, n - 1 - greatest(1, (n - 1) // 2)) ELSE t0 END AS t
          FROM (SELECT *, greatest(1, CAST(round_even(n * CAST({val} AS DOUBLE), 0) AS BIGINT)) AS v0,
                          greatest(1, CAST(round_even(n * CAST({test} AS DOUBLE), 0) AS BIGINT)) AS t0
                FROM (SELECT *, count(*) OVER (PARTITION BY {target}) AS n,
                             {sql_rank(key, 'split', target)} AS rn FROM {source}))))"""


_SELECTED = f"WITH {_BALANCED}, selected AS (SELECT * FROM {_ladder_sql('balanced', 'doc_id', 'target', 0.05, 0.05)})"


def balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.balance_classes(document_rows(spark, sf_dir), "target", "doc_id", MIN_ROWS, MAX_ROWS)


def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced and split documents. The cap bounds the classes that are split."""
    return sampling.stratified_split(balanced(spark, sf_dir), "target", "doc_id", class_bound=MAX_ROWS)


@query(
    "q_b1_class_cleanup",
    f"WITH {_NAMED} SELECT target, count(*) AS n FROM named GROUP BY target",
)
def class_cleanup(spark, sf_dir):
    rows = document_rows(spark, sf_dir).withColumn("target", class_name("target"))
    return rows.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query("q_b2_balance_classes", f"WITH {_BALANCED} SELECT * FROM balanced")
def balance(spark, sf_dir):
    return balanced(spark, sf_dir)


@query("q_b2_balance_by_edges", f"WITH {_BALANCED} SELECT * FROM balanced")
def balance_by_edges(spark, sf_dir):
    """The path for caps too large to keep the first rows of every part: cuts found by counting."""
    rows = document_rows(spark, sf_dir)
    return sampling.balance_classes(rows, "target", "doc_id", MIN_ROWS, MAX_ROWS, top_rows=0)


@query(
    "q_b2_balance_high_minimum",
    f"""WITH ranked AS (SELECT o_orderkey, o_custkey, {sql_rank('o_orderkey', 'balance', 'o_custkey')} AS rn,
        count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey FROM ranked WHERE n <= 10 OR rn <= 4""",
)
def balance_high_minimum(spark, sf_dir):
    """Many small classes and a minimum above the cap: small ones stay whole, others shrink."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return sampling.balance_classes(orders, "o_custkey", "o_orderkey", 10, 4)


@query(
    "q_b3_global_cap",
    f"SELECT event_id, event_type FROM (SELECT *, {sql_rank('event_id', 'cap')} AS rn FROM events) WHERE rn <= 2500",
)
def global_cap(spark, sf_dir):
    return sampling.cap_rows(table(spark, sf_dir, "events").select("event_id", "event_type"), 2500, "event_id")


@query(
    "q_b3_global_cap_by_edge",
    f"SELECT event_id, event_type FROM (SELECT *, {sql_rank('event_id', 'cap')} AS rn FROM events) WHERE rn <= 2500",
)
def global_cap_by_edge(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return sampling.cap_rows(events, 2500, "event_id")


@query(
    "q_b4_split_ladder",
    f"SELECT s_suppkey, s_nationkey, split FROM {_ladder_sql('supplier', 's_suppkey', 's_nationkey', 0.05, 0.05)}",
)
def split_ladder(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return sampling.stratified_split(supplier, "s_nationkey", "s_suppkey")


@query(
    "q_b4_split_crowded",
    f"SELECT s_suppkey, s_nationkey, split FROM {_ladder_sql('supplier', 's_suppkey', 's_nationkey', 0.5, 0.5)}",
)
def split_crowded(spark, sf_dir):
    """Fractions so large that the over-allocation rule applies."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return sampling.stratified_split(supplier, "s_nationkey", "s_suppkey", 0.5, 0.5)


@query(
    "q_b4_stratified_split",
    f"SELECT p_partkey, p_name, split FROM {_ladder_sql('part', 'p_partkey', 'p_name', 0.05, 0.1)}",
)
def stratified_split(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return sampling.stratified_split(part, "p_name", "p_partkey", 0.05, 0.1)


@query(
    "q_b4_split_by_edges",
    f"SELECT p_partkey, p_name, split FROM {_ladder_sql('part', 'p_partkey', 'p_name', 0.05, 0.1)}",
)
def split_by_edges(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return sampling.stratified_split(part, "p_name", "p_partkey", 0.05, 0.1)


@query("q_b4_balance_then_split", f"{_SELECTED} SELECT doc_id, target, segment, organ, split FROM selected")
def balance_then_split(spark, sf_dir):
    return selected(spark, sf_dir)


@query(
    "q_b5_shuffle_key",
    f"""{_SELECTED} SELECT doc_id, split, md5(concat_ws('|', '42', 'shuffle', CAST(doc_id AS VARCHAR))) AS shuffle_key
    FROM selected""",
)
def shuffle_key(spark, sf_dir):
    return sampling.with_shuffle_key(selected(spark, sf_dir), "doc_id").select("doc_id", "split", "shuffle_key")


def _subset_sql(source: str, key: str, target: str, n: int) -> str:
    return f"""WITH src AS (SELECT {target}, {key}, count(*) OVER () AS total,
            count(*) OVER (PARTITION BY {target}) AS n FROM {source}),
        picked AS (SELECT *, {sql_rank(key, 'subset', target)} AS rn FROM src WHERE {target} IS NOT NULL),
        kept AS (SELECT * FROM picked
            WHERE total > {n} AND rn <= greatest(1, CAST(round_even(n / total * {n}, 0) AS BIGINT))),
        trimmed AS (SELECT *, {sql_rank(key, 'trim')} AS trn FROM kept)
        SELECT {target}, {key} FROM trimmed WHERE trn <= {n}
        UNION ALL SELECT {target}, {key} FROM src WHERE total <= {n}"""


@query("q_b6_proportional_subset", _subset_sql("orders", "o_orderkey", "o_orderpriority", 3000))
def proportional_subset(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    return sampling.proportional_subset(orders, 3000, "o_orderkey", "o_orderpriority")


@query("q_b6_subset_with_trim", _subset_sql("part", "p_partkey", "p_name", 100))
def subset_with_trim(spark, sf_dir):
    """Many classes at least one row each: the sum exceeds the target and is trimmed."""
    part = table(spark, sf_dir, "part").select("p_name", "p_partkey")
    return sampling.proportional_subset(part, 100, "p_partkey", "p_name")


@query("q_b6_subset_by_edges", _subset_sql("part", "p_partkey", "p_name", 100))
def subset_by_edges(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_name", "p_partkey")
    return sampling.proportional_subset(part, 100, "p_partkey", "p_name")


@query("q_b7_subset_first_column", _subset_sql("events", "event_id", "event_type", 1000))
def subset_first_column(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    return sampling.proportional_subset(events, 1000, "event_id")


@query(
    "q_b8_sample",
    f"SELECT doc_id, lang FROM (SELECT *, {sql_rank('doc_id', 'sample')} AS rn FROM documents) WHERE rn <= 16",
)
def sample(spark, sf_dir):
    return sampling.sample_rows(table(spark, sf_dir, "documents").select("doc_id", "lang"), 16, "doc_id")


@query(
    "q_b9_first_in_order",
    f"SELECT event_id, user_id FROM (SELECT *, {sql_rank('event_id', 'shuffle')} AS rn FROM events) WHERE rn <= 1500",
)
def first_in_order(spark, sf_dir):
    events = sampling.with_shuffle_key(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id")
    return sampling.first_rows_in_order(events, 1500, "event_id", "shuffle_key").drop("shuffle_key")


@query(
    "q_b9_first_by_number",
    """SELECT event_id, user_id, value FROM (SELECT *, row_number() OVER (ORDER BY user_id, event_id) AS rn FROM events)
    WHERE rn <= 777""",
)
def first_by_number(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return sampling.first_rows_in_order(events, 777, "event_id", "user_id", range_rows=500)


@query(
    "q_b9_first_by_key",
    "SELECT event_id, value FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM events) WHERE rn <= 650",
)
def first_by_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return sampling.first_rows_in_order(events, 650, "event_id", range_rows=500)


@query(
    "q_e1_dataset_statistics",
    f"""{_SELECTED}, sizes AS (SELECT target, count(*) AS n FROM selected GROUP BY target)
    SELECT (SELECT count(*) FROM documents) AS total_source_rows, count(*) AS selected_total_rows,
        count(*) FILTER (split = 'train') AS selected_train_rows,
        count(*) FILTER (split = 'val') AS selected_val_rows,
        count(*) FILTER (split = 'test') AS selected_test_rows,
        count(DISTINCT target) AS num_classes, count(DISTINCT segment) AS num_segments,
        (SELECT median(n) FROM sizes) AS median_samples_per_class,
        (SELECT min(n) FROM sizes) AS min_samples_per_class,
        (SELECT max(n) FROM sizes) AS max_samples_per_class,
        count(*) FILTER ({sql_informative('segment')}) AS rows_with_segment,
        count(*) FILTER ({sql_informative('organ')}) AS rows_with_organ
    FROM selected""",
)
def statistics(spark, sf_dir):
    source = table(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()
    return dataset_statistics(selected(spark, sf_dir), source, "target", "segment", ["segment", "organ"])


@query(
    "q_e2_class_distribution",
    f"""{_SELECTED} SELECT target, count(*) AS total_samples,
        count(*) FILTER (split = 'train') AS train_samples, count(*) FILTER (split = 'val') AS val_samples,
        count(*) FILTER (split = 'test') AS test_samples FROM selected GROUP BY target""",
)
def distribution(spark, sf_dir):
    return class_distribution(selected(spark, sf_dir), "target")
