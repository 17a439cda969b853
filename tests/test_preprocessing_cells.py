"""Cells of every form through the preprocessing plan."""

import base64
import os

import pytest

from tallyloom.operators.preprocess import FileReader, output_name, preprocess_images
from tallyloom.plans.preprocessing import image_payloads

DATA = b"image bytes " * 40


@pytest.mark.parametrize("kind", ["struct<bytes:binary,path:string>", "string", "binary"])
@pytest.mark.parametrize("inline", [False, True])
def test_payload_of_every_form(spark, tmp_path, kind, inline):
    if kind == "binary":
        cells, want = [bytearray(DATA), None], [DATA, None]
    elif kind == "string":
        cells, want = ["a.jpg", base64.b64encode(DATA).decode(), "gone.jpg", None], [DATA, DATA, None, None]
    else:
        cells, want = [(None, "a.jpg"), (bytearray(DATA), None), (None, "gone.jpg"), None], [DATA, DATA, None, None]
    source = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"row_idx_in_shard int, image {kind}").coalesce(1)
    source.sortWithinPartitions("row_idx_in_shard").write.parquet(f"{tmp_path}/source")
    file = next(f"{tmp_path}/source/{n}" for n in os.listdir(tmp_path / "source") if n.endswith(".parquet"))
    listing = spark.createDataFrame([(file,)], "path string")
    moved = f"/former/place/{os.path.basename(file)}"
    rows = spark.createDataFrame([(moved, i) for i in range(len(cells))], "shard_path string, row_idx_in_shard int")
    pending = rows.join(source, "row_idx_in_shard") if inline else rows
    # A moved source file is found by its base name, an image by its path below the folder.
    folder = f"{tmp_path}/source"
    (tmp_path / "source/a.jpg").write_bytes(DATA)

    def payloads(some):
        return image_payloads(some, f"{tmp_path}/source", "image", folder, listing, folder)

    key = ["shard_path", "row_idx_in_shard"]
    outcome = preprocess_images(pending, payloads, key, bytes, f"{tmp_path}/out", fetch=FileReader()).collect()
    got = {r.row_idx_in_shard: (r.shard_path, None if r.error else (tmp_path / "out" / r.output_path).read_bytes()) for r in outcome}
    assert got == {i: (moved, each) for i, each in enumerate(want)}


def test_only_paths_below_the_given_folders_are_opened(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a").write_bytes(DATA)
    (tmp_path / "b").write_bytes(DATA)
    named = [f"{tmp_path}/in/a", f"file://{tmp_path}/in/a", "a", f"{tmp_path}/b", f"{tmp_path}/in/../b", "../b"]
    rows = spark.createDataFrame([(i, (None, p)) for i, p in enumerate(named)], "id int, image struct<bytes:binary,path:string>")
    folder = f"{tmp_path}/in"
    outcome = preprocess_images(
        rows, lambda some: image_payloads(some, (), "image", folder, None, folder), "id", bytes, f"{tmp_path}/out", fetch=FileReader()
    )
    assert {r.id for r in outcome.collect() if r.error is None} == {0, 1, 2}


def test_composite_keys_share_no_name(spark):
    keys = [("a", "b|c"), ("a|b", "c"), ("ab", None), (None, "ab"), ("a", None)]
    rows = spark.createDataFrame(keys, "x string, y string")
    assert rows.select(output_name(["x", "y"])).distinct().count() == len(keys)
