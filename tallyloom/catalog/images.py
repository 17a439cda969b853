"""Image payloads (D1-D6, E15). Document texts play the image bytes."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, table
from tallyloom.catalog.scans import document_scan
from tallyloom.constants import FILE_COLUMN, ORDINAL_COLUMN
from tallyloom.functions import payload
from tallyloom.operators import images
from tallyloom.operators.preprocess import FolderStore, output_contents, preprocess_images, with_image_path
from tallyloom.operators.scoring import transcode_batches
from tallyloom.operators.statistics import job_tallies
from tallyloom.plans.preprocessing import BAD_SAMPLES, preprocess_manifest
from tallyloom.sources.manifests import PREPROCESSED, current_manifest, write_manifest
from tallyloom.sources.shards import scan_metadata
from tallyloom.sources.workspace import new_folder, stage


def _bytes(name="text"):
    return F.encode(F.col(name), "UTF-8")


@query(
    "q_d1_struct_payload",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'bytes' WHEN doc_id % 4 = 1 THEN 'path' ELSE 'error' END AS kind,
        CASE WHEN doc_id % 4 = 0 THEN md5(text) END AS digest,
        CASE WHEN doc_id % 4 = 1 THEN concat('/images/', doc_id) END AS path,
        CASE WHEN doc_id % 4 = 2 THEN 'image struct holds neither bytes nor path'
             WHEN doc_id % 4 = 3 THEN 'image is null' END AS error FROM documents""",
)
def struct_payload(spark, sf_dir):
    kind = F.col("doc_id") % 4
    cell = F.when(
        kind != 3,
        F.struct(
            F.when(kind == 0, _bytes()).alias("bytes"),
            F.when(kind < 2, F.concat(F.lit("/images/"), F.col("doc_id").cast("string"))).alias("path"),
        ),
    )
    found = table(spark, sf_dir, "documents").select("doc_id", payload.payload_of_struct(cell).alias("_cell"))
    # Bytes win over the path, so the path of those rows is not reported.
    return found.select("doc_id", "_cell.kind", F.md5("_cell.payload").alias("digest"), "_cell.path", "_cell.error")


@query(
    "q_d1_string_payload",
    """WITH cells AS (SELECT doc_id, text, CASE WHEN doc_id % 5 = 0 THEN concat('/images/', doc_id)
            WHEN doc_id % 5 = 1 THEN concat('data:image/png;base64,', to_base64(encode(text)))
            WHEN doc_id % 5 = 2 THEN to_base64(encode(text))
            WHEN doc_id % 5 = 3 THEN 'data:image/png;base64,###' END AS cell FROM documents),
        kinds AS (SELECT *, CASE WHEN doc_id % 10 = 0 THEN 'path' WHEN doc_id % 5 = 1 THEN 'base64'
            WHEN doc_id % 5 = 2 AND length(cell) > 256 THEN 'base64' ELSE 'error' END AS kind FROM cells)
    SELECT doc_id, kind, CASE WHEN kind = 'base64' THEN md5(text) END AS digest,
        CASE WHEN kind = 'path' THEN cell END AS path,
        CASE WHEN cell IS NULL THEN 'image is null'
             WHEN kind = 'error' THEN concat('no such image path: ', cell) END AS error FROM kinds""",
)
def string_payload(spark, sf_dir):
    kind = F.col("doc_id") % 5
    cells = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(kind == 0, F.concat(F.lit("/images/"), F.col("doc_id").cast("string")))
        .when(kind == 1, F.concat(F.lit("data:image/png;base64,"), F.base64(_bytes())))
        .when(kind == 2, F.regexp_replace(F.base64(_bytes()), r"\s", ""))
        .when(kind == 3, F.lit("data:image/png;base64,###"))
        .alias("cell"),
        (F.col("doc_id") % 10 == 0).alias("there"),
    )
    found = cells.select("doc_id", payload.payload_of_string("cell", "there").alias("_cell"))
    return found.select("doc_id", "_cell.kind", F.md5("_cell.payload").alias("digest"), "_cell.path", "_cell.error")


def _hex(value, digits):
    return F.lpad(F.hex(value), digits, "0")


def _hex_le(value, width):
    """Little-endian hexadecimal digits."""
    return F.concat(*[_hex(F.shiftright(value, 8 * place).bitwiseAND(F.lit(255)), 2) for place in range(width)])


@query(
    "q_d2_header_check",
    """SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'png' WHEN 1 THEN 'jpeg' WHEN 2 THEN 'webp' WHEN 3 THEN 'webp'
            WHEN 4 THEN 'webp' WHEN 5 THEN 'png' END AS kind,
        CASE WHEN doc_id % 7 < 5 THEN 1 + n_chars % 9000 END AS width,
        CASE WHEN doc_id % 7 < 5 THEN 1 + doc_id % 3000 END AS height,
        CASE doc_id % 7 WHEN 5 THEN 'truncated image header' WHEN 6 THEN 'unknown image format' END AS error
    FROM documents""",
)
def header_check(spark, sf_dir):
    """Headers of every format, built from the table: width and height come from two of its columns."""
    kind = F.col("doc_id") % 7
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (1 + F.col("n_chars") % 9000).alias("w"), (1 + F.col("doc_id") % 3000).alias("h"), "text"
    )
    w, h = F.col("w"), F.col("h")
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), _hex(w, 8), _hex(h, 8))
    jpeg = F.concat(
        F.lit("FFD8FFE000104A46494600010100000100010000FFDB0004AAAAFFC0001108"), _hex(h, 4), _hex(w, 4), F.lit("03")
    )
    riff = F.lit("524946460000000057454250")
    lossy = F.concat(riff, F.lit("56503820" + "00000000" + "000000" + "9D012A"), _hex_le(w, 2), _hex_le(h, 2))
    bits = (w - 1).bitwiseOR(F.shiftleft(h - 1, 14))
    lossless = F.concat(riff, F.lit("5650384C" + "00000000" + "2F"), _hex_le(bits, 4))
    extended = F.concat(riff, F.lit("56503858" + "0A000000" + "00000000"), _hex_le(w - 1, 3), _hex_le(h - 1, 3))
    header = (
        F.when(kind == 0, png)
        .when(kind == 1, jpeg)
        .when(kind == 2, lossy)
        .when(kind == 3, lossless)
        .when(kind == 4, extended)
        .when(kind == 5, F.lit("89504E470D0A1A0A0000"))
        .otherwise(F.lit("4D4D"))
    )
    # Real payloads go on after the header.
    body = F.when(kind < 5, _bytes()).otherwise(F.lit(b""))
    data = rows.select("doc_id", F.concat(F.unhex(header), body).alias("data")).select(
        "doc_id",
        payload.image_format("data").alias("kind"),
        payload.fixed_header_size("data").alias("_fixed"),
        payload.jpeg_size("data").alias("_jpeg"),
    )
    sized = data.select(
        "doc_id",
        "kind",
        F.coalesce("_fixed.width", "_jpeg.width").alias("width"),
        F.coalesce("_fixed.height", "_jpeg.height").alias("height"),
    )
    return sized.withColumn("error", payload.header_check("kind", "width", "height"))


@query(
    "q_d3_source_precedence",
    """SELECT doc_id, CASE WHEN k < 2 AND doc_id % 3 <> 0 THEN 'image_path' WHEN k = 2 THEN 'image'
            WHEN k = 3 THEN 'shard' ELSE 'none' END AS source_kind,
        CASE WHEN k < 2 AND doc_id % 3 <> 0 THEN CASE WHEN doc_id % 7 <> 0 THEN md5(text) END
             WHEN k = 2 THEN CASE WHEN doc_id % 4 <> 0 THEN md5(concat('inline ', lang)) END
             WHEN k = 3 THEN md5(text) END AS digest,
        CASE WHEN k < 2 AND doc_id % 3 <> 0 THEN CASE WHEN doc_id % 7 = 0 THEN 'cannot open preprocessed image' END
             WHEN k = 2 THEN CASE WHEN doc_id % 4 = 0 THEN 'image struct holds neither bytes nor path' END
             WHEN k <> 3 THEN 'no image source in row' END AS error
    FROM (SELECT *, doc_id % 5 AS k FROM documents)""",
)
def source_precedence(spark, sf_dir):
    """Existence of a file and readability of its content are separate: some listed files are broken."""
    kind = F.col("doc_id") % 5
    path = F.concat(F.lit("/images/"), F.col("doc_id").cast("string"))
    scan = document_scan(spark, sf_dir, ("doc_id", "lang"))
    rows = scan.select(
        "doc_id",
        F.when(kind < 2, path).alias("image_path"),
        F.when(
            kind == 2,
            F.struct(
                F.when(F.col("doc_id") % 4 != 0, F.encode(F.concat(F.lit("inline "), "lang"), "UTF-8")).alias("bytes"),
                F.lit(None).cast("string").alias("path"),
            ),
        ).alias("image"),
        F.when(kind == 3, F.col(FILE_COLUMN)).alias(FILE_COLUMN),
        ORDINAL_COLUMN,
        (F.col("doc_id") % 3 != 0).alias("there"),
    )
    chosen = rows.withColumn(
        "source_kind", images.source_kind("image_path", "there", "image", FILE_COLUMN, F.lit(True))
    )
    files = table(spark, sf_dir, "documents").select(
        path.alias("path"), F.when(F.col("doc_id") % 7 != 0, _bytes()).alias("content")
    )
    pointers = chosen.where(F.col("source_kind") == "shard").select(FILE_COLUMN, ORDINAL_COLUMN)
    cells = images.fetch_cells(spark, pointers, f"{sf_dir}/documents.parquet", "text").select(
        FILE_COLUMN, ORDINAL_COLUMN, payload.payload_of_binary(_bytes()).alias("cell")
    )
    resolved = images.resolve_images(chosen, files, cells, payload.payload_of_struct("image"))
    return resolved.select("doc_id", "source_kind", F.md5("payload").alias("digest"), "error")


@query("q_d4_read_in_tasks", "SELECT doc_id, md5(text) AS digest FROM documents")
def read_in_passes(spark, sf_dir):
    """Cells pass by pass through Spark's scan, for manifests whose pointers are too many for one broadcast."""
    manifest = document_scan(spark, sf_dir, ("doc_id",))
    passes = images.cell_passes(manifest, f"{sf_dir}/documents.parquet", "text")
    parts = [stage(cells.select("doc_id", F.md5("text").alias("digest")), "cells") for cells in passes]
    return reduce(DataFrame.unionByName, parts)


@query("q_d4_pointer_lookup", "SELECT doc_id, md5(text) AS digest FROM documents")
def pointer_lookup(spark, sf_dir):
    manifest = document_scan(spark, sf_dir, ("doc_id",))
    cells = images.fetch_cells(spark, manifest, f"{sf_dir}/documents.parquet", "text")
    return cells.select("doc_id", F.md5("text").alias("digest"))


def _manifest_by_path(spark, sf_dir):
    """Pointers with paths as a user writes them, without a scheme."""
    return document_scan(spark, sf_dir, ("doc_id",)).withColumn(FILE_COLUMN, images.plain_path(FILE_COLUMN))


@query("q_d4_plain_paths", "SELECT doc_id, md5(text) AS digest FROM documents")
def plain_paths(spark, sf_dir):
    cells = images.fetch_cells(spark, _manifest_by_path(spark, sf_dir), f"{sf_dir}/documents.parquet", "text")
    return cells.select("doc_id", F.md5("text").alias("digest"))


@query(
    "q_d5_resolve_then_fetch",
    "SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN md5(text) END AS digest FROM documents",
)
def resolve_then_fetch(spark, sf_dir):
    """References below the data folder, some of them wrong, resolved against its listing and then read."""
    root = re.sub("^file:/+", "/", sf_dir).rstrip("/")
    below = F.replace(FILE_COLUMN, F.lit(f"{root}/"), F.lit(""))
    refs = F.when(F.col("doc_id") % 5 != 0, below).otherwise(F.concat(F.lit("gone/"), below, F.lit(".old")))
    manifest = _manifest_by_path(spark, sf_dir).withColumn(FILE_COLUMN, refs)
    listing = document_scan(spark, sf_dir, ()).select(FILE_COLUMN).distinct()
    found = images.resolve_pointers(manifest, listing, root, FILE_COLUMN)
    cells = images.fetch_cells(spark, found, f"{sf_dir}/documents.parquet", "text")
    return cells.select("doc_id", F.md5("text").alias("digest"))


_TAIL = "concat(CAST(page_id % 40 AS VARCHAR), '-', length(url), '.parquet')"


@query(
    "q_d5_resolve_paths",
    f"""WITH names AS (SELECT page_id, {_TAIL} AS name FROM pages),
        refs AS (SELECT DISTINCT CASE page_id % 5 WHEN 0 THEN concat('/data/', name) WHEN 1 THEN concat('sub/', name)
            WHEN 2 THEN concat('elsewhere/', name) WHEN 3 THEN concat('/gone/', name) ELSE concat('lost/', name) END AS ref,
            page_id % 5 AS k, name FROM names),
        listed AS (SELECT DISTINCT CASE page_id % 5 WHEN 1 THEN concat('/data/sub/', name)
            WHEN 4 THEN concat('/data/other/', name) ELSE concat('/data/', name) END AS path FROM names),
        tried AS (SELECT ref, [ref, concat('/data/', ref), concat('/data/', name)] AS paths FROM refs),
        hits AS (SELECT ref, min_by(path, place) AS path FROM (SELECT ref, unnest(paths) AS path,
            unnest(range(1, 4)) AS place FROM tried) JOIN listed USING (path) GROUP BY ref)
    SELECT ref, coalesce(path, ref) AS resolved, path IS NOT NULL AS found FROM tried LEFT JOIN hits USING (ref)""",
)
def resolve_paths(spark, sf_dir):
    kind = F.col("page_id") % 5
    names = table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat((F.col("page_id") % 40).cast("string"), F.lit("-"), F.length("url").cast("string"), F.lit(".parquet")).alias("name"),
    )

    def under(folder):
        return F.concat(F.lit(folder), "name")

    refs = names.select(
        F.when(kind == 0, under("/data/"))
        .when(kind == 1, under("sub/"))
        .when(kind == 2, under("elsewhere/"))
        .when(kind == 3, under("/gone/"))
        .otherwise(under("lost/"))
        .alias("ref")
    )
    listing = names.select(
        F.when(kind == 1, under("/data/sub/")).when(kind == 4, under("/data/other/")).otherwise(under("/data/")).alias("path")
    )
    return images.resolve_paths(refs, "ref", listing, "/data")


def shrink(data: bytes) -> bytes:
    """Stand-in for a codec: refuses long inputs, marks the others."""
    if len(data) > 60_000:
        raise ValueError("too large")
    return b"IMG0" + data


def _preprocess(spark, sf_dir, folder):
    """Converts all documents in two runs; the second run finds most outputs in place."""
    rows = document_scan(spark, sf_dir, ("doc_id", "lang"))

    def payloads(pending):
        cells = images.fetch_cells(spark, pending, f"{sf_dir}/documents.parquet", "text")
        return cells.withColumn("payload", _bytes())

    preprocess_images(rows.where("lang = 'en'"), payloads, "doc_id", shrink, folder)
    return rows, preprocess_images(rows, payloads, "doc_id", shrink, folder)


def _mixed_source(spark, sf_dir, folder):
    """Source files whose cells hold bytes, a path, a path to nothing, neither, or null; and one file that is no table.

    Returns the pointers with ``doc_id``, ``lang`` and ``split``.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    kind = F.col("doc_id") % 6
    name = F.concat(F.lit("by-path/"), F.col("doc_id").cast("string"), F.lit(".img"))
    written = docs.where(kind == 1).select(name.alias("path"), _bytes().alias("payload"))
    written = transcode_batches(written, bytes, store=FolderStore(folder), path="path")
    stage(written, "by-path")
    path = F.when(kind == 1, name).when(kind == 2, F.concat(name, F.lit(".gone")))
    cell = F.when(kind != 5, F.struct(F.when((kind == 0) | (kind == 3), _bytes()).alias("bytes"), path.alias("path")))
    docs.select("doc_id", "lang", cell.alias("image")).write.parquet(f"{folder}/source")
    rows = scan_metadata(spark, f"{folder}/source", ["doc_id", "lang"])
    broken = spark.range(1).select(F.lit("broken.parquet").alias("path"), F.lit(b"no table").alias("payload"))
    stage(transcode_batches(broken, bytes, store=FolderStore(f"{folder}/source"), path="path"), "broken")
    lost = F.col("doc_id") % 6 == 3
    file = F.when(lost, F.lit(f"{folder}/source/broken.parquet")).otherwise(F.col(FILE_COLUMN))
    # No two rows lie at one place of the broken file, whichever files they come from: the pointer is the key of the plan.
    place = F.when(lost, F.monotonically_increasing_id()).otherwise(F.col(ORDINAL_COLUMN))
    split = F.when(F.col("doc_id") % 4 == 0, "val").otherwise("train")
    return rows.withColumns({FILE_COLUMN: file, ORDINAL_COLUMN: place, "split": split, "filename": F.col("doc_id").cast("string")})


_SIZE = "octet_length(encode(text))"


@query(
    "q_d6_mixed_cells",
    f"""SELECT doc_id, lang, CASE WHEN doc_id % 4 = 0 THEN 'val' ELSE 'train' END AS split,
        CASE WHEN doc_id % 6 < 2 AND {_SIZE} <= 60000 THEN md5(concat('IMG0', text)) END AS digest,
        CASE WHEN doc_id % 6 < 2 AND {_SIZE} <= 60000 THEN NULL WHEN doc_id % 6 < 2 THEN 'ValueError: too large'
             WHEN doc_id % 6 = 2 THEN 'FileNotFoundError' WHEN doc_id % 6 = 3 THEN 'cannot read source row'
             ELSE 'ValueError: no payload' END AS error FROM documents""",
)
def mixed_cells(spark, sf_dir):
    """The whole plan over cells of every form: contents of the written images, and the quarantined rows with their errors."""
    folder = new_folder(spark, "mixed")
    write_manifest(_mixed_source(spark, sf_dir, folder), f"{folder}/manifest")
    preprocess_manifest(
        spark, folder, f"{folder}/source", f"{folder}/images", shrink, target="lang", image_paths=f"{folder}/by-path", data_dir=folder
    )
    rows = current_manifest(spark, f"{folder}/{PREPROCESSED}").select("doc_id", "lang", "split", images.plain_path("image_path").alias("path"))
    path = F.concat(F.lit(images.plain_root(f"{folder}/images") + "/"), "output_path")
    # Staged, so that the files are opened once.
    digests = stage(output_contents(spark, f"{folder}/images").select(path.alias("path"), F.md5("content").alias("digest")), "digests")
    bad = spark.read.parquet(f"{folder}/{BAD_SAMPLES}").select(
        F.col("filename").cast("long").alias("doc_id"),
        F.when(F.col("error").startswith("FileNotFoundError"), "FileNotFoundError").otherwise(F.col("error")).alias("error"),
    )
    return rows.join(digests, "path", "left").drop("path").join(bad, "doc_id", "left")


@query(
    "q_d6_preprocess_images",
    f"""SELECT doc_id, lang, CASE WHEN {_SIZE} <= 60000 THEN concat(substr(md5(CAST(doc_id AS VARCHAR)), 1, 3), '/',
        md5(CAST(doc_id AS VARCHAR)), '.jpg') END AS image_path FROM documents""",
)
def preprocess(spark, sf_dir):
    folder = new_folder(spark, "images")
    rows, outcome = _preprocess(spark, sf_dir, folder)
    manifest = with_image_path(rows, outcome, "doc_id", folder)
    return manifest.select("doc_id", "lang", F.substring_index("image_path", "/", -2).alias("image_path"))


@query(
    "q_e15_job_tallies",
    f"""SELECT count(*) FILTER ({_SIZE} <= 60000) AS valid_rows, count(*) AS total_rows,
        CAST(sum(CASE WHEN {_SIZE} <= 60000 THEN {_SIZE} + 4 ELSE 0 END) AS BIGINT) AS total_bytes,
        count(*) FILTER ({_SIZE} > 60000) AS bad_rows FROM documents""",
)
def tallies(spark, sf_dir):
    folder = new_folder(spark, "images")
    rows, outcome = _preprocess(spark, sf_dir, folder)
    sized = with_image_path(rows, outcome, "doc_id", folder).join(outcome.select("doc_id", "n_bytes", "error"), "doc_id")
    return job_tallies(sized)
