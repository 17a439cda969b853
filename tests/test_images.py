"""Payloads, headers, path resolution and the resumable conversion."""

import base64
import os
import struct
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import plan_of
from tallyloom.functions import payload
from tallyloom.operators import images
from tallyloom.operators.preprocess import finished_outputs, preprocess_images, with_image_path
from tallyloom.operators.scoring import score_batches, transcode_batches
from tallyloom.sources.shards import list_files, scan_metadata

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_string_payloads(spark):
    long = base64.b64encode(b"x" * 300).decode()
    broken = "\n".join(long[at : at + 76] for at in range(0, len(long), 76))
    values = [None, "/there", "/gone", "data:image/png;base64," + base64.b64encode(b"abc").decode(), long, broken]
    values += ["data:image/png;base64,%%%", "short", "data:image/png;base64,QQ"]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, s string")
    cells = rows.orderBy("id").select(payload.payload_of_string("s", F.col("s") == "/there").alias("c")).collect()
    kinds = [(cell.c.kind, cell.c.payload and bytes(cell.c.payload)) for cell in cells]
    assert kinds[:7] == [
        ("error", None),
        ("path", None),
        ("error", None),
        ("base64", b"abc"),
        ("base64", b"x" * 300),
        ("base64", b"x" * 300),
        ("error", None),
    ]
    assert kinds[7] == ("error", None)
    assert all((cell.c.error is None) == (cell.c.kind != "error") for cell in cells)


def test_binary_and_struct_payloads(spark):
    rows = spark.createDataFrame(
        [(b"a", (b"b", "p")), (None, (None, "p")), (b"", (None, None)), (b"x", None)],
        "raw binary, cell struct<bytes:binary,path:string>",
    )
    out = rows.select(payload.payload_of_binary("raw").alias("r"), payload.payload_of_struct("cell").alias("c")).collect()
    assert [row.r.kind for row in out] == ["bytes", "error", "bytes", "bytes"]
    assert [row.c.kind for row in out] == ["bytes", "path", "error", "error"]


def jpeg(width, height, marker=0xC0, lead=b""):
    frame = struct.pack(">BBHBHHB", 0xFF, marker, 17, 8, height, width, 3) + b"\0" * 9
    return b"\xff\xd8" + lead + frame


def segment(code, size):
    return struct.pack(">BBH", 0xFF, code, size + 2) + b"\xaa" * size


def test_headers(spark):
    png = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 70000, 3)
    cases = [
        (png, "png", 70000, 3),
        (png[:20], "png", None, None),
        (jpeg(640, 480), "jpeg", 640, 480),
        (jpeg(12, 7, 0xC2, segment(0xE1, 60000) + segment(0xE2, 60000) + segment(0xC4, 20)), "jpeg", 12, 7),
        (jpeg(5, 6, lead=b"\xff\xff" + segment(0xDB, 65)[1:]), "jpeg", 5, 6),
        (b"\xff\xd8\xff", "jpeg", None, None),
        (b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (99).to_bytes(3, "little") + (16777215).to_bytes(3, "little"), "webp", 100, 16777216),
        (b"RIFF\0\0\0\0WEBPVP8 " + b"\0" * 7 + b"\x9d\x01\x2a" + struct.pack("<HH", 320 | 0x4000, 200), "webp", 320, 200),
        (b"RIFF\0\0\0\0WEBPVP8L" + b"\0" * 4 + b"\x2f" + (16383 | (4 << 14)).to_bytes(4, "little"), "webp", 16384, 5),
        (b"GIF89a", None, None, None),
        (b"", None, None, None),
    ]
    rows = spark.createDataFrame([(at, case[0]) for at, case in enumerate(cases)], "id int, data binary")
    out = rows.select(
        "id",
        payload.image_format("data").alias("kind"),
        payload.fixed_header_size("data").alias("fixed"),
        payload.jpeg_size("data").alias("jpeg"),
    ).orderBy("id")
    for row, (_, kind, width, height) in zip(out.collect(), cases):
        size = row.fixed or row.jpeg
        assert (row.kind, size and size.width, size and size.height) == (kind, width, height)


def test_resolve_paths(spark):
    listing = spark.createDataFrame([("file:/data/a",), ("/data/sub/b",), ("/data/b",), ("/abs/c",), ("d",)], "path string")
    refs = ["/data/a", "a", "x/a", "sub/b", "/old/b", "/abs/c", "d", "none", None]
    rows = spark.createDataFrame([(ref,) for ref in refs] * 3, "ref string")
    found = {row.ref: (row.resolved, row.found) for row in images.resolve_paths(rows, "ref", listing, "/data/").collect()}
    assert found == {
        "/data/a": ("/data/a", True),
        "a": ("/data/a", True),
        "x/a": ("/data/a", True),
        "sub/b": ("/data/sub/b", True),
        "/old/b": ("/data/b", True),
        "/abs/c": ("/abs/c", True),
        "d": ("d", True),
        "none": ("none", False),
    }


def test_resolved_pointers_lead_to_cells(spark, tmp_path):
    shards = write_shards(spark, tmp_path)
    scan = scan_metadata(spark, shards, ["label"])
    moved = scan.withColumn("shard_path", F.concat(F.lit("/old/place/"), F.substring_index("shard_path", "/", -1)))
    listing = scan.select("shard_path").distinct()
    found = images.resolve_pointers(moved, listing, shards, "shard_path")
    cells = images.fetch_cells(spark, found, shards).collect()
    assert len(cells) == 40 and all(row.image is not None for row in cells)
    unknown = images.resolve_pointers(moved, listing, "/nowhere", "shard_path")
    assert [row.image for row in images.fetch_cells(spark, unknown, shards).collect()] == [None] * 40


def in_passes(rows, shards, **limits):
    return [row for cells in images.cell_passes(rows, shards, **limits) for row in cells.collect()]


def test_a_broken_file_costs_its_own_rows(spark, tmp_path):
    shards = write_shards(spark, tmp_path)
    scan = scan_metadata(spark, shards, ["label"])
    rows = scan.unionByName(scan.limit(2).withColumn("shard_path", F.lit(f"{shards}/broken.parquet")))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    with open(f"{shards}/broken.parquet", "wb") as broken:
        broken.write(b"no table at all")
    assert len(in_passes(rows, shards)) == 40


def write_shards(spark, folder, n=40, files=4):
    rows = [(f"name {at}", bytes([at]) * (600 if at % 10 else 0)) for at in range(n)]
    df = spark.createDataFrame(rows, "label string, image binary").repartition(files, "label")
    df.write.parquet(f"{folder}/shards")
    return f"{folder}/shards"


def test_pointers_lead_back_to_their_rows(spark, tmp_path):
    shards = write_shards(spark, tmp_path)
    scan = scan_metadata(spark, shards, ["label", "missing"])
    assert scan.columns == ["label", "shard_path", "row_idx_in_shard"]
    assert "image" not in scan._jdf.queryExecution().executedPlan().toString()
    ways = [images.fetch_cells(spark, scan, shards, "image", listed) for listed in (0, 1, 1000)]
    ways += [images.fetch_cells(spark, scan, shards, pointer_bytes=0)]
    by_path = scan.withColumn("shard_path", images.plain_path("shard_path"))
    assert not by_path.where("shard_path LIKE 'file:%'").count()
    ways += [images.fetch_cells(spark, by_path, shards, "image", listed) for listed in (0, 1000)]
    for way in ways:
        assert way.columns[-1] == "image"
        cells = way.collect()
        assert len(cells) == 40
        for row in cells:
            at = int(row.label.split()[1])
            assert bytes(row.image) == bytes([at]) * (600 if at % 10 else 0)
    gone = scan.limit(3).withColumn("row_idx_in_shard", F.lit(10**9).cast("bigint"))
    assert [row.image for row in images.fetch_cells(spark, gone, shards).collect()] == [None] * 3


@pytest.mark.parametrize("limits", [{}, {"pointer_bytes": 3000}])
def test_passes_bring_every_cell_once(spark, tmp_path, limits):
    shards = write_shards(spark, tmp_path)
    scan = scan_metadata(spark, shards, ["label"])
    by_path = scan.withColumn("shard_path", images.plain_path("shard_path")).limit(20)
    rows = scan.where("row_idx_in_shard < 5").unionByName(by_path)
    lost = scan.limit(2).withColumn("row_idx_in_shard", F.lit(10**9).cast("bigint"))
    lost = lost.unionByName(scan.limit(2).withColumn("row_idx_in_shard", F.lit(None).cast("bigint")))
    lost = lost.unionByName(scan.limit(2).withColumn("shard_path", F.lit("file:///nowhere/x.parquet")))
    found = in_passes(rows.unionByName(lost), shards, **limits)
    assert sorted(row.label for row in found) == sorted(row.label for row in rows.collect())
    for row in found:
        at = int(row.label.split()[1])
        assert bytes(row.image) == bytes([at]) * (600 if at % 10 else 0)
    assert in_passes(scan.limit(0), shards, **limits) == []


def test_cells_of_a_pass_are_not_shuffled(spark, tmp_path):
    shards = write_shards(spark, tmp_path)
    cells = next(images.cell_passes(scan_metadata(spark, shards, ["label"]), shards))
    plan = plan_of(cells)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_columns_that_only_some_files_have(spark, tmp_path):
    spark.range(3).withColumn("a", F.lit("x")).write.parquet(f"{tmp_path}/t/p1")
    spark.range(2).withColumn("b", F.lit("y")).write.parquet(f"{tmp_path}/t/p2")
    scan = scan_metadata(spark, f"{tmp_path}/t", ["a", "b", "c"])
    assert scan.columns == ["a", "b", "shard_path", "row_idx_in_shard"]
    assert {(row.a, row.b) for row in scan.collect()} == {("x", None), (None, "y")}
    assert scan.count() == 5


def double(data: bytes) -> bytes:
    if not data:
        raise ValueError("empty")
    return data * 2


def test_preprocess_resumes(spark, tmp_path):
    shards = write_shards(spark, tmp_path)
    key = ["shard_path", "row_idx_in_shard"]
    rows = scan_metadata(spark, shards, ["label"])
    folder, asked = f"{tmp_path}/out", []

    def payloads(pending):
        asked.append(pending.count())
        return images.fetch_cells(spark, pending, shards).withColumnRenamed("image", "payload")

    first = preprocess_images(rows, payloads, key, double, folder)
    again = preprocess_images(rows, payloads, key, double, folder)
    assert asked == [40, 4]
    for outcome in (first, again):
        assert outcome.count() == 40
        assert outcome.where("error is null").agg(F.sum("n_bytes")).first()[0] == 36 * 1200
        assert {row.error for row in outcome.where("error is not null").collect()} == {"ValueError: empty"}
    manifest = with_image_path(rows, again, key, folder).collect()
    assert sum(row.image_path is None for row in manifest) == 4
    for row in manifest:
        if row.image_path is not None:
            assert os.path.getsize(row.image_path) == 1200
    assert finished_outputs(spark, folder).count() == 36
    assert finished_outputs(spark, f"{tmp_path}/nowhere").count() == 0
    assert list_files(spark, folder, "*.part").count() == 0


def test_sources_in_order(spark):
    kind = images.source_kind("path", "there", "image", "shard", "listed")
    rows = spark.createDataFrame(
        [("p", True, b"i", "s", True), ("p", False, b"i", "s", True), (None, None, None, "s", True), ("", True, None, "s", False)],
        "path string, there boolean, image binary, shard string, listed boolean",
    )
    assert [row[0] for row in rows.select(kind).collect()] == ["image_path", "image", "shard", "none"]


def test_broken_source_is_final_and_gets_the_stand_in(spark):
    chosen = spark.createDataFrame(
        [(1, "image_path", "/a", b"inline"), (2, "image_path", "/b", b"inline"), (3, "image", None, b"c"), (4, "none", None, None)],
        "id int, source_kind string, image_path string, image binary",
    )
    files = spark.createDataFrame([("file:/a", b"A")], "path string, content binary")
    out = images.resolve_images(chosen, files, None, payload.payload_of_binary("image"), stand_in=b"grey")
    found = {row.id: (bytes(row.payload), row.error) for row in out.collect()}
    assert found == {
        1: (b"A", None),
        2: (b"grey", "cannot open preprocessed image"),
        3: (b"c", None),
        4: (b"grey", "no image source in row"),
    }


def test_predictor_loads_once_per_task_and_sees_small_batches(spark):
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)

        def predict(batch):
            assert len(batch) <= 4
            return [f"Diagnosis: {x}" for x in batch["id"]]

        return predict

    out = score_batches(spark.range(0, 50, 1, 3), load, batch_rows=4).collect()
    assert {row.raw_output for row in out} == {f"Diagnosis: {at}" for at in range(50)}
    assert loads.value == 3
    heavy = spark.range(3).withColumn("image", F.lit(b"x"))
    assert score_batches(heavy, load, keep=["id"]).columns == ["id", "raw_output"]


def test_transcode_reports_errors(spark):
    rows = spark.createDataFrame([(1, b"ab"), (2, b""), (3, None)], "id int, payload binary")
    out = {row.id: (row.n_bytes, row.error, row.output) for row in transcode_batches(rows, double, keep=["id"]).collect()}
    assert out[1] == (4, None, bytearray(b"abab"))
    assert out[2] == (None, "ValueError: empty", None)
    assert out[3] == (None, "ValueError: no payload", None)
