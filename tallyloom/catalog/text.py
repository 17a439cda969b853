"""Text, prompts, conversations, tokens, answer parsing and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.fixtures import (
    ANSWERS_SQL,
    PART_PAIRS_SQL,
    PART_ROWS_SQL,
    answers,
    part_pairs,
    part_rows,
    sql_clean,
    sql_informative,
    sql_normalize,
    sql_strip,
)
from tallyloom.catalog.registry import query, table
from tallyloom.constants import ANSWER_LABELS, FIELD_ALIASES, INSTRUCTION
from tallyloom.functions import chat, text, tokens
from tallyloom.operators.conversations import render_turns
from tallyloom.operators.records import FIELDS, evaluation_records, failures

_FIELDS = ["crop", "canonical_disease", "disease", "plant_organ", "pathogen"]
_CONTEXT = ["crop", "disease_type", "plant_organ", "visual_symptoms", "pathogen"]


@query(
    "q_c1_informative",
    f"SELECT p_partkey, {', '.join(f'{sql_informative(name)} AS has_{name}' for name in _FIELDS)} FROM ({PART_ROWS_SQL})",
)
def informative(spark, sf_dir):
    return part_rows(spark, sf_dir).select(
        "p_partkey", *[text.informative(name).alias(f"has_{name}") for name in _FIELDS]
    )


@query(
    "q_c2_collapse_whitespace",
    f"SELECT p_partkey, {', '.join(f'{sql_clean(name)} AS {name}' for name in _FIELDS)} FROM ({PART_ROWS_SQL})",
)
def collapse_whitespace(spark, sf_dir):
    return part_rows(spark, sf_dir).select("p_partkey", *[text.clean(name).alias(name) for name in _FIELDS])


_TARGET_SQL = (
    f"CASE WHEN {sql_informative('canonical_disease')} THEN {sql_clean('canonical_disease')} "
    f"ELSE {sql_clean('disease')} END"
)
_TRUTH_SQL = "coalesce(nullif(canonical_disease, ''), disease, 'Unknown')"


@query(
    "q_c3_target_resolution",
    f"""SELECT p_partkey, {_TARGET_SQL} AS training_target, {_TRUTH_SQL} AS scoring_truth,
        CASE WHEN {sql_informative('canonical_disease')} THEN {sql_clean('canonical_disease')}
            ELSE 'Unknown Disease' END AS target_without_raw
    FROM ({PART_ROWS_SQL})""",
)
def target_resolution(spark, sf_dir):
    return part_rows(spark, sf_dir).select(
        "p_partkey",
        text.training_target("canonical_disease", "disease").alias("training_target"),
        text.scoring_truth("canonical_disease", "disease").alias("scoring_truth"),
        text.training_target("canonical_disease").alias("target_without_raw"),
    )


def _line_sql(field: str) -> str:
    return f"CASE WHEN {sql_informative(field)} THEN concat('{ANSWER_LABELS[field]}: ', {sql_clean(field)}) END"


_PROMPT_SQL = f"concat_ws(chr(10), '{INSTRUCTION}', {_line_sql('crop')}, {_line_sql('plant_organ')})"
_ANSWER_SQL = "concat_ws(chr(10), " + ", ".join(
    f"concat('Diagnosis: ', {_TARGET_SQL})" if field == "diagnosis" else _line_sql(field) for field in ANSWER_LABELS
) + ")"


@query("q_c4_user_prompt", f"SELECT p_partkey, {_PROMPT_SQL} AS prompt FROM ({PART_ROWS_SQL})")
def user_prompt(spark, sf_dir):
    return part_rows(spark, sf_dir).select("p_partkey", text.user_prompt("crop", "plant_organ").alias("prompt"))


def _answer_column():
    return text.answer_text("canonical_disease", "disease", {name: name for name in _CONTEXT})


@query("q_c5_answer_text", f"SELECT p_partkey, {_ANSWER_SQL} AS answer FROM ({PART_ROWS_SQL})")
def answer_text(spark, sf_dir):
    return part_rows(spark, sf_dir).select("p_partkey", _answer_column().alias("answer"))


@query(
    "q_c6_conversation",
    f"""WITH rows AS (SELECT p_partkey, {_PROMPT_SQL} AS prompt, {_ANSWER_SQL} AS answer FROM ({PART_ROWS_SQL}))
    SELECT p_partkey, 0 AS message, 'user' AS role, 0 AS part, 'image' AS type, NULL AS text,
        concat('img-', p_partkey) AS image FROM rows
    UNION ALL SELECT p_partkey, 0, 'user', 1, 'text', prompt, NULL FROM rows
    UNION ALL SELECT p_partkey, 1, 'assistant', 0, 'text', answer, NULL FROM rows""",
)
def conversation(spark, sf_dir):
    """Built as nested messages, shown flat: one row per content part."""
    built = part_rows(spark, sf_dir).select(
        "p_partkey",
        chat.conversation(
            F.concat(F.lit("img-"), F.col("p_partkey").cast("string")),
            text.user_prompt("crop", "plant_organ"),
            _answer_column(),
        ).alias("messages"),
    )
    messages = built.select("p_partkey", F.posexplode("messages").alias("message", "_message"))
    return messages.select(
        "p_partkey", "message", "_message.role", F.posexplode("_message.content").alias("part", "_part")
    ).select("p_partkey", "message", "role", "part", "_part.type", "_part.text", "_part.image")


_RENDERED_SQL = """SELECT conv_id, string_agg(
    concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)), '' ORDER BY turn) AS body
    FROM conversations GROUP BY conv_id"""


@query("q_c7_render_chat", f"SELECT conv_id, body AS rendered FROM ({_RENDERED_SQL})")
def render_chat(spark, sf_dir):
    return render_turns(table(spark, sf_dir, "conversations"))


@query(
    "q_c7_render_for_generation",
    f"SELECT conv_id, concat(body, '<|im_start|>assistant', chr(10)) AS rendered FROM ({_RENDERED_SQL})",
)
def render_for_generation(spark, sf_dir):
    return render_turns(table(spark, sf_dir, "conversations"), add_generation_prompt=True)


@query(
    "q_c7_render_rows",
    f"""SELECT p_partkey, concat('<|im_start|>user', chr(10), '<image>', {_PROMPT_SQL}, '<|im_end|>', chr(10),
        '<|im_start|>assistant', chr(10)) AS prompt_only,
        concat('<|im_start|>user', chr(10), '<image>', {_PROMPT_SQL}, '<|im_end|>', chr(10),
        '<|im_start|>assistant', chr(10), {_ANSWER_SQL}, '<|im_end|>', chr(10)) AS training_text
    FROM ({PART_ROWS_SQL})""",
)
def render_rows(spark, sf_dir):
    prompt, image = text.user_prompt("crop", "plant_organ"), F.lit("img")
    return part_rows(spark, sf_dir).select(
        "p_partkey",
        chat.render_conversation(chat.conversation(image, prompt), add_generation_prompt=True).alias("prompt_only"),
        chat.render_conversation(chat.conversation(image, prompt, _answer_column())).alias("training_text"),
    )


@query(
    "q_c8_normalize_label",
    f"""SELECT p_partkey, {sql_normalize('ground_truth')} AS gt, {sql_normalize('predicted')} AS pred
    FROM ({PART_PAIRS_SQL})""",
)
def normalize_label(spark, sf_dir):
    return part_pairs(spark, sf_dir).select(
        "p_partkey",
        text.normalize_label("ground_truth").alias("gt"),
        text.normalize_label("predicted").alias("pred"),
    )


def _extract_sql(field: str) -> str:
    names = "|".join(name.replace(" ", r"\s*") for name in FIELD_ALIASES[field])
    value = sql_strip(rf"regexp_extract(raw_output, '(?:{names})\s*:\s*([^\n]+)', 1, 'i')")
    return f"rtrim({value}, '.,;')"


_FIRST_SQL = (
    "coalesce(list_filter(list_transform(string_split(raw_output, chr(10)), lambda x: "
    + sql_strip("x")
    + "), lambda x: x <> '')[1], '')"
)
_FALLBACK_SQL = (
    f"CASE WHEN contains({_FIRST_SQL}, ':') THEN "
    + sql_strip(f"substr({_FIRST_SQL}, instr({_FIRST_SQL}, ':') + 1)")
    + f" ELSE {_FIRST_SQL} END"
)
_DIAGNOSIS_SQL = f"coalesce(nullif({_extract_sql('diagnosis')}, ''), {_FALLBACK_SQL})"


@query(
    "q_c9_extract_fields",
    f"SELECT p_partkey, {', '.join(f'{_extract_sql(name)} AS {name}' for name in FIELD_ALIASES)} FROM ({ANSWERS_SQL})",
)
def extract_fields(spark, sf_dir):
    return answers(spark, sf_dir).select(
        "p_partkey", *[text.extract_field("raw_output", names).alias(name) for name, names in FIELD_ALIASES.items()]
    )


@query(
    "q_c10_first_line_fallback",
    f"""SELECT p_partkey, {_FIRST_SQL} AS first_line, {_FALLBACK_SQL} AS fallback, {_DIAGNOSIS_SQL} AS diagnosis
    FROM ({ANSWERS_SQL})""",
)
def first_line_fallback(spark, sf_dir):
    return answers(spark, sf_dir).select(
        "p_partkey",
        text.first_line("raw_output").alias("first_line"),
        text.fallback_class("raw_output").alias("fallback"),
        text.parse_answer("raw_output")["diagnosis"].alias("diagnosis"),
    )


@query(
    "q_c10_conversation_first_line",
    f"""SELECT conv_id, turn, {_FALLBACK_SQL} AS fallback
    FROM (SELECT conv_id, turn, text AS raw_output FROM conversations)""",
)
def conversation_first_line(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.fallback_class("text").alias("fallback"))


_EXACT_SQL = f"lower({sql_strip('ground_truth')}) = lower({sql_strip('predicted')})"
_NORMAL_SQL = f"{sql_normalize('ground_truth')} = {sql_normalize('predicted')}"


@query("q_c11_exact_match", f"SELECT p_partkey, {_EXACT_SQL} AS exact FROM ({PART_PAIRS_SQL})")
def exact_match(spark, sf_dir):
    return part_pairs(spark, sf_dir).select("p_partkey", text.exact_match("ground_truth", "predicted").alias("exact"))


@query(
    "q_c12_correctness_flag",
    f"""SELECT p_partkey, {_NORMAL_SQL} AND {sql_normalize('predicted')} <> '' AS strict, {_NORMAL_SQL} AS lenient
    FROM (SELECT p_partkey, ground_truth, CASE WHEN p_partkey % 6 = 0 THEN ' ?' ELSE predicted END AS predicted
        FROM (SELECT p_partkey, predicted, CASE WHEN p_partkey % 12 = 0 THEN '' ELSE ground_truth END AS ground_truth
            FROM ({PART_PAIRS_SQL})))""",
)
def correctness_flag(spark, sf_dir):
    key = F.col("p_partkey")
    pairs = part_pairs(spark, sf_dir).select(
        key,
        F.when(key % 12 == 0, "").otherwise(F.col("ground_truth")).alias("ground_truth"),
        F.when(key % 6 == 0, " ?").otherwise(F.col("predicted")).alias("predicted"),
    )
    return pairs.select(
        key,
        text.is_correct("ground_truth", "predicted").alias("strict"),
        text.is_correct("ground_truth", "predicted", require_nonempty=False).alias("lenient"),
    )


@query(
    "q_c13_fill_from_metadata",
    f"""SELECT p_partkey, coalesce(nullif({_extract_sql('plant_organ')}, ''), plant_organ, '') AS plant_organ,
        coalesce(nullif({_extract_sql('visual_symptoms')}, ''), visual_symptoms, '') AS visual_symptoms,
        coalesce(nullif({_extract_sql('pathogen')}, ''), pathogen, '') AS pathogen FROM ({ANSWERS_SQL})""",
)
def fill_from_metadata(spark, sf_dir):
    parsed = answers(spark, sf_dir).withColumn("_parsed", text.parse_answer("raw_output"))
    return parsed.select(
        "p_partkey",
        *[
            text.fill_from(F.col(f"_parsed.{name}"), name).alias(name)
            for name in ("plant_organ", "visual_symptoms", "pathogen")
        ],
    )


MARKER = [2, 3]
_IDS_SQL = """SELECT conv_id, turn, list_transform(string_split(text, ' '), lambda w: CAST(length(w) AS INT)) AS ids,
    CAST(turn % 4 AS INT) AS pad FROM conversations"""


def _token_rows(spark, sf_dir):
    """Word lengths as token ids; the first tokens of some rows count as padding."""
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.transform(F.split("text", " ", -1), F.length).alias("ids"),
        (F.col("turn") % 4).cast("int").alias("pad"),
    )
    return rows.withColumn(
        "mask", F.transform("ids", lambda _, at: F.when(at < F.col("pad"), 0).otherwise(1))
    )


@query(
    "q_c14_loss_mask",
    f"""WITH rows AS (SELECT *, list_filter(range(1, len(ids)), lambda j: ids[j] = {MARKER[0]} AND ids[j + 1] = {MARKER[1]})[1] AS j
            FROM ({_IDS_SQL})),
        cut AS (SELECT *, coalesce(j + 1, least(5, len(ids))) AS kept FROM rows)
    SELECT conv_id, turn, array_to_string(list_transform(range(1, len(ids) + 1),
        lambda i: CASE WHEN i <= kept OR i <= pad THEN -100 ELSE ids[i] END), ',') AS labels FROM cut""",
)
def loss_mask(spark, sf_dir):
    labels = tokens.loss_labels("ids", "mask", MARKER, F.lit(5))
    return _token_rows(spark, sf_dir).select(
        "conv_id", "turn", F.array_join(F.transform(labels, lambda x: x.cast("string")), ",").alias("labels")
    )


@query(
    "q_c15_drop_prompt",
    f"""SELECT conv_id, turn, array_to_string(ids[CAST(turn * 9 + 1 AS BIGINT):], ',') AS generated
    FROM ({_IDS_SQL})""",
)
def drop_prompt(spark, sf_dir):
    rows = _token_rows(spark, sf_dir)
    prompt = F.array_repeat(F.lit(0), (F.col("turn") * 9).cast("int"))
    generated = tokens.drop_prompt("ids", prompt)
    return rows.select(
        "conv_id", "turn", F.array_join(F.transform(generated, lambda x: x.cast("string")), ",").alias("generated")
    )


@query(
    "q_c16_formatters",
    """SELECT o_orderkey, format('{:,}', CAST(trunc(o_totalprice) AS BIGINT)) AS price,
        CASE WHEN o_orderkey % 5 = 0 THEN 'N/A' ELSE format('{:,}', o_orderkey * 1000) END AS key_text,
        CASE WHEN s >= 3600 THEN printf('%dh %02dm', s // 3600, s % 3600 // 60)
             ELSE printf('%02dm %02ds', s // 60, s % 60) END AS duration_text
    FROM (SELECT *, CAST(floor(o_totalprice / 50) AS BIGINT) AS s FROM orders)""",
)
def formatters(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") * 1000)
    return orders.select(
        "o_orderkey",
        text.thousands("o_totalprice").alias("price"),
        text.thousands(key).alias("key_text"),
        text.duration(F.col("o_totalprice") / 50).alias("duration_text"),
    )


_RECORDS_SQL = f"""SELECT p_partkey, concat('sample_', p_partkey) AS filename, coalesce(crop, 'Unknown') AS crop,
    {_TRUTH_SQL} AS ground_truth, {_DIAGNOSIS_SQL} AS predicted, {_extract_sql('disease_type')} AS predicted_type,
    {_extract_sql('plant_organ')} AS predicted_organ, {_extract_sql('visual_symptoms')} AS predicted_symptoms,
    {_extract_sql('pathogen')} AS predicted_pathogen, plant_organ, visual_symptoms, pathogen,
    {sql_normalize(_TRUTH_SQL)} = {sql_normalize(_DIAGNOSIS_SQL)} AND {sql_normalize(_DIAGNOSIS_SQL)} <> '' AS is_correct,
    raw_output FROM ({ANSWERS_SQL})"""


@query("q_e12_evaluation_records", _RECORDS_SQL)
def records(spark, sf_dir):
    return evaluation_records(answers(spark, sf_dir), "p_partkey").select("p_partkey", *FIELDS)


@query("q_e13_failures", f"SELECT * FROM ({_RECORDS_SQL}) WHERE NOT is_correct")
def failed(spark, sf_dir):
    return failures(evaluation_records(answers(spark, sf_dir), "p_partkey"))
