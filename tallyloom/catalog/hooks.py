"""User-supplied Python in Arrow batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.fixtures import PART_ROWS_SQL, part_rows
from tallyloom.catalog.registry import query, table
from tallyloom.catalog.text import _PROMPT_SQL
from tallyloom.functions import text
from tallyloom.operators.scoring import score_batches, transcode_batches


def load_echo():
    """Stand-in for a model: answers with the last line of the prompt."""

    def predict(batch):
        return [f"Diagnosis: {prompt.rsplit(chr(10), 1)[-1]}" for prompt in batch["prompt"]]

    return predict


@query(
    "q_u1_batch_scoring",
    f"""SELECT p_partkey, prompt, concat('Diagnosis: ', string_split(prompt, chr(10))[-1]) AS raw_output
    FROM (SELECT p_partkey, {_PROMPT_SQL} AS prompt FROM ({PART_ROWS_SQL}))""",
)
def batch_scoring(spark, sf_dir):
    prompts = part_rows(spark, sf_dir).select("p_partkey", text.user_prompt("crop", "plant_organ").alias("prompt"))
    return score_batches(prompts, load_echo)


def invert(data: bytes) -> bytes:
    """Stand-in for a codec: empty input is an error, the rest is reversed twice and cut nowhere."""
    if data.startswith(b"T"):
        raise ValueError("cannot decode")
    return data[::-1][::-1] + b"!"


@query(
    "q_u2_transcode",
    """SELECT doc_id, CASE WHEN NOT starts_with(text, 'T') THEN octet_length(encode(text)) + 1 END AS n_bytes,
        CASE WHEN starts_with(text, 'T') THEN 'ValueError: cannot decode' END AS error,
        CASE WHEN NOT starts_with(text, 'T') THEN md5(concat(text, '!')) END AS digest FROM documents""",
)
def transcode(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("payload"))
    done = transcode_batches(rows, invert, keep=["doc_id"])
    return done.select("doc_id", "n_bytes", "error", F.md5("output").alias("digest"))
