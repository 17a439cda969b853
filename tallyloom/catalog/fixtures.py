"""Shared tables in the shape the operators expect, once for Spark and once as SQL.

The expressions are plain SQL that both engines read alike, so each is written once. They work
row by row: no fixture shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.catalog.registry import table
from tallyloom.constants import PUNCTUATION

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

# Event types as truth; some predictions agree, in other spelling, some do not, some are empty.
EVENT_PAIRS = {
    "event_id": "event_id",
    "ground_truth": "event_type",
    "predicted": f"""CASE WHEN {_K} % 13 = 0 THEN ''
        WHEN {_K} % 11 = 0 THEN concat('invented_', event_type)
        WHEN {_K} % 3 = 0 THEN concat('"', upper(event_type), '".')
        WHEN {_K} % 3 = 1 THEN concat(' ', event_type)
        WHEN {_K} % 5 = 0 THEN 'view' WHEN {_K} % 5 = 1 THEN 'click'
        WHEN {_K} % 5 = 2 THEN 'signup' WHEN {_K} % 5 = 3 THEN 'purchase' ELSE 'error' END""",
    "segment": "CASE WHEN user_id % 10 = 9 THEN NULL ELSE concat('u', user_id % 10) END",
    "split": "CASE WHEN event_id % 3 = 0 THEN 'test' ELSE 'val' END",
}

# Many classes: part names, decorated, with invented predictions.
PART_PAIRS = {
    "p_partkey": "p_partkey",
    "ground_truth": """CASE WHEN p_partkey % 4 = 0 THEN p_name WHEN p_partkey % 4 = 1 THEN upper(p_name)
        WHEN p_partkey % 4 = 2 THEN concat('"', replace(p_name, ' ', '-'), '"')
        ELSE concat('  ', p_name, '. ') END""",
    "predicted": """CASE WHEN p_partkey % 7 = 0 THEN concat('invented ', p_type)
        WHEN p_size % 5 < 3 THEN replace(p_name, ' ', '_')
        ELSE concat(split_part(p_name, ' ', 1), ' bolt') END""",
    "segment": "p_type",
}

# Metadata rows: some fields missing, blank or uninformative.
PART_ROWS = {
    "p_partkey": "p_partkey",
    "crop": r"""CASE WHEN p_partkey % 9 = 0 THEN 'N/A' WHEN p_partkey % 9 = 1 THEN NULL
        ELSE concat('  ', p_type, chr(9), chr(10), 'field ') END""",
    "canonical_disease": """CASE WHEN p_partkey % 8 = 0 THEN ' Unknown' WHEN p_partkey % 8 = 1 THEN ''
        WHEN p_partkey % 8 = 2 THEN NULL ELSE p_name END""",
    "disease": """CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 'none'
        ELSE concat('raw  ', p_name) END""",
    "plant_organ": """CASE WHEN p_size % 7 = 0 THEN 'unknown' WHEN p_size % 5 = 0 THEN '   ' ELSE p_brand END""",
    "visual_symptoms": "CASE WHEN p_size % 4 = 0 THEN NULL ELSE concat('size ', p_size) END",
    "pathogen": "CASE WHEN p_size % 6 = 0 THEN 'NaN' ELSE p_brand END",
    "disease_type": "CASE WHEN p_size % 10 = 0 THEN 'undefined' ELSE lower(p_type) END",
}

# Generated answers in several layouts.
ANSWER = """CASE
    WHEN p_partkey % 8 = 0 THEN concat('Crop: ', p_type, chr(10), 'Diagnosis: ', p_name, '.', chr(10), 'Plant organ: ', p_brand)
    WHEN p_partkey % 8 = 1 THEN concat('identified disease : ', p_name, ' ;', chr(10), 'HOST CROP: ', p_type)
    WHEN p_partkey % 8 = 2 THEN concat('Diagnosis:', chr(10), 'Crop: ', p_type)
    WHEN p_partkey % 8 = 3 THEN p_name
    WHEN p_partkey % 8 = 4 THEN concat(chr(10), '  ', chr(10), 'Answer: ', p_name, ': sure', chr(10), 'more')
    WHEN p_partkey % 8 = 5 THEN concat('Genotype: ', p_brand, chr(10), 'Counterpart: leaf, ', chr(10), 'Diagnosis:   ', chr(10), 'Symptoms: spots;')
    WHEN p_partkey % 8 = 6 THEN ''
    ELSE concat('Visual signs: ', p_name, chr(10), 'Causal agent: ', p_brand, '.,;', chr(10), 'DISEASE TYPE: fungal') END"""

# Documents as labelled rows: languages as classes, some missing or badly spelled.
DOCUMENT_ROWS = {
    "doc_id": "doc_id",
    "target": "CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 17 = 1 THEN concat(' ', lang, ' ') ELSE lang END",
    "segment": "CASE WHEN doc_id % 19 = 0 THEN NULL ELSE source END",
    "organ": "CASE WHEN doc_id % 3 = 0 THEN 'unknown' ELSE source END",
}

# Events as a training log.
LOSS_ROWS = {
    "run": "event_id // 1000",
    "epoch": "event_id % 1000 // 250",
    "batch": "event_id % 250 + 1",
    "loss": "CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END",
    "rejected": "event_type = 'signup' AND value > 40",
}
EVAL_ROWS = {
    "run": "user_id",
    "step": "event_id",
    "macro_f1": "CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END",
}


def _shape(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, str]) -> DataFrame:
    # DuckDB writes whole-number division as //, Spark as div.
    return table(spark, sf_dir, name).selectExpr(
        *[f"{expression.replace('//', 'div')} AS {alias}" for alias, expression in columns.items()]
    )


def _sql(name: str, columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f"{expression} AS {alias}" for alias, expression in columns.items()) + f" FROM {name}"


def event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark, sf_dir, "events", EVENT_PAIRS)


def part_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark, sf_dir, "part", PART_PAIRS)


def part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark, sf_dir, "part", PART_ROWS)


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark, sf_dir, "part", {**PART_ROWS, "raw_output": ANSWER})


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark, sf_dir, "documents", DOCUMENT_ROWS)


def loss_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark, sf_dir, "events", LOSS_ROWS)


def eval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark, sf_dir, "events", EVAL_ROWS)


EVENT_PAIRS_SQL = _sql("events", EVENT_PAIRS)
PART_PAIRS_SQL = _sql("part", PART_PAIRS)
PART_ROWS_SQL = _sql("part", PART_ROWS)
ANSWERS_SQL = _sql("part", {**PART_ROWS, "raw_output": ANSWER})
DOCUMENT_ROWS_SQL = _sql("documents", DOCUMENT_ROWS)
LOSS_ROWS_SQL = _sql("events", LOSS_ROWS)
EVAL_ROWS_SQL = _sql("events", EVAL_ROWS)


def sql_strip(value: str) -> str:
    return rf"regexp_replace({value}, '^\s+|\s+$', '', 'g')"


def sql_informative(value: str) -> str:
    return (
        f"({value} IS NOT NULL AND lower({sql_strip(value)}) NOT IN "
        "('', 'nan', 'none', 'null', 'undefined', 'n/a', 'unknown'))"
    )


def sql_clean(value: str) -> str:
    collapsed = sql_strip(rf"regexp_replace({value}, '\s+', ' ', 'g')")
    return f"CASE WHEN {sql_informative(value)} THEN {collapsed} ELSE '' END"


def sql_normalize(value: str) -> str:
    punctuation = PUNCTUATION.replace("'", "''")
    bare = f"trim(lower({sql_strip(value)}), '{punctuation} ')"
    return f"coalesce({sql_strip(rf'''regexp_replace({bare}, '[\s\-_]+', ' ', 'g')''')}, '')"


def sql_rank(key: str, purpose: str, by: str = "", seed: int = 42) -> str:
    partition = f"PARTITION BY {by} " if by else ""
    return (
        f"row_number() OVER ({partition}ORDER BY md5(concat_ws('|', '{seed}', '{purpose}', "
        f"CAST({key} AS VARCHAR))), {key})"
    )


def sql_exact_sum(value: str) -> str:
    """Sum of doubles below 2**62 that does not depend on the order of the rows: whole multiples of powers of two are added."""
    parts, usual = [], f"CAST({value} AS DOUBLE)"
    for above, exponent in ((0, 0), (0, -32), (-32, -64), (-64, -96)):
        rest = usual if exponent == 0 else f"({usual} % pow(2.0::DOUBLE, {above}))"
        unit = f"pow(2.0::DOUBLE, {exponent})"
        parts.append(f"coalesce(CAST(sum(CAST(trunc({rest} / {unit}) AS BIGINT)) AS DOUBLE), 0) * {unit}")
    return "(" + " + ".join(reversed(parts)) + ")"
