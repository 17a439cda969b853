"""Manifest rows to converted images, and to a table that is ready for training."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.constants import ANSWER_LABELS, FILE_COLUMN, INSTRUCTION
from tallyloom.functions import chat, text
from tallyloom.functions.payload import BASE64_LENGTH, payload_of_binary, payload_of_string, payload_of_struct
from tallyloom.operators.images import cell_passes, paths_below, resolve_pointers
from tallyloom.operators.preprocess import FileReader, preprocess_images, with_image_path
from tallyloom.operators.sampling import proportional_subset
from tallyloom.operators.scoring import Transcode
from tallyloom.operators.statistics import job_tallies
from tallyloom.plans.curation import POINTER
from tallyloom.sources.manifests import PREPROCESSED, publish_manifest, read_manifest
from tallyloom.sources.quarantine import append_quarantine, bad_rows
from tallyloom.sources.workspace import stage

# Where the rows that failed are kept, next to the manifests.
BAD_SAMPLES = "bad_samples"


def image_payloads(
    pending: DataFrame,
    source_paths: str | Sequence[str],
    image: str = "image",
    image_paths: str | Sequence[str] = (),
    listing: DataFrame | None = None,
    data_dir: str | None = None,
) -> Iterator[DataFrame]:
    """``pending`` with ``payload`` and ``places``, in passes, whatever form the cells have; rows without a cell may be missing.

    ``places`` are the files below ``image_paths`` that a cell may name; nothing is opened here.
    """
    if image in pending.columns:
        passes = iter([pending])
    elif listing is None:
        passes = cell_passes(pending, source_paths, image)
    else:
        # The reference given is part of the row key, so it comes back after the reading.
        placed = resolve_pointers(pending.withColumn("_given", F.col(FILE_COLUMN)), listing, data_dir)
        found = cell_passes(placed, source_paths, image)
        passes = (cells.drop(FILE_COLUMN).withColumnRenamed("_given", FILE_COLUMN) for cells in found)
    roots = [image_paths] if isinstance(image_paths, str) else list(image_paths)
    for cells in passes:
        kind = dict(cells.dtypes)[image]
        if kind == "binary":
            cell, ref = payload_of_binary(image), F.lit(None).cast("string")
        elif kind == "string":
            cell, ref = payload_of_string(image), F.when(F.length(image) <= BASE64_LENGTH, F.col(image))
        else:
            cell = payload_of_struct(image)
            ref = F.when(cell["kind"] == "path", cell["path"])
        yield cells.select("*", cell["payload"].alias("payload"), paths_below(ref, roots, data_dir).alias("places")).drop(image)


def preprocess_manifest(
    spark: SparkSession,
    manifest_folder: str,
    source_paths: str | Sequence[str],
    image_folder: str,
    transcode: Transcode,
    max_rows: int | None = None,
    target: str = "canonical_disease",
    image: str = "image",
    image_paths: str | Sequence[str] = (),
    listing: DataFrame | None = None,
    data_dir: str | None = None,
    filename: str = "filename",
) -> DataFrame:
    """D6 for the train split (a subset of it, if asked) and the whole val split.

    Cells may be structs, bytes, or texts (a path or base64), in the source files or in the manifest itself. Paths
    in cells are opened where they lie below the folders ``image_paths``, each by the task that converts it; source files that moved are found
    in ``listing`` (D5), both below ``data_dir`` as well. Publishes ``manifest_folder``/preprocessed_manifest and appends the rows
    that failed to ``manifest_folder``/bad_samples (A6); returns the tallies of the job. A broken source file costs its own rows only.
    """
    folder = manifest_folder.rstrip("/")
    train = proportional_subset(
        read_manifest(spark, "train", [folder]).drop("image_path"), max_rows, POINTER, target
    )
    val = read_manifest(spark, "val", [folder]).drop("image_path")
    rows = stage(train.unionByName(val), "to-preprocess")

    def payloads(pending: DataFrame) -> Iterator[DataFrame]:
        return image_payloads(pending, source_paths, image, image_paths, listing, data_dir)

    named = [name for name in (filename,) if name in rows.columns]
    keys = rows.select(*POINTER, *named, *([image] if image in rows.columns else []))
    outcome = preprocess_images(keys, payloads, POINTER, transcode, image_folder, keep=named, fetch=FileReader())
    publish_manifest(with_image_path(rows, outcome, POINTER, image_folder), f"{folder}/{PREPROCESSED}")
    append_quarantine(bad_rows(outcome, named[0] if named else None, *POINTER), f"{folder}/{BAD_SAMPLES}")
    # The outcome has every row, so the tallies need no join.
    return job_tallies(outcome.withColumn("image_path", F.when(F.col("error").isNull(), F.col("output_path"))))


def training_rows(
    manifest: DataFrame,
    image: str = "image_path",
    target: str = "canonical_disease",
    raw_target: str | None = "disease",
    instruction: str = INSTRUCTION,
    with_answer: bool = True,
) -> DataFrame:
    """The manifest plus prompt, answer, messages and rendered chat; no shuffle."""

    def known(name: str) -> str | None:
        return name if name in manifest.columns else None

    context = {name: name for name in ANSWER_LABELS if name != "diagnosis" and name in manifest.columns}
    texts = manifest.withColumns(
        {
            "prompt": text.user_prompt(known("crop"), known("plant_organ"), instruction),
            "answer": text.answer_text(target, known(raw_target) if raw_target else None, context),
        }
    )
    messages = chat.conversation(image, "prompt", "answer" if with_answer else None)
    return texts.withColumn("messages", messages).withColumn(
        "rendered", chat.render_conversation(F.col("messages"), add_generation_prompt=not with_answer)
    )
