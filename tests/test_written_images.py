"""Reading back what the preprocessing wrote: by tasks, without a list of all images on the driver."""

import hashlib

from tallyloom.catalog import QUERIES
from tallyloom.operators import preprocess
from tallyloom.operators.preprocess import FolderStore, output_contents


DOCS = [(i, f"text {i}", "en" if i % 2 else "de") for i in range(36)]


def mixed_cells(spark, tmp_path, files):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string")
    docs.repartition(files, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    return QUERIES["q_d6_mixed_cells"](spark, str(tmp_path))


def test_mixed_cells_keeps_no_list_of_images_on_the_driver(spark, tmp_path):
    result = mixed_cells(spark, tmp_path, 1)
    assert not [file for file in result.inputFiles() if file.endswith(".jpg")]


def test_mixed_cells_has_each_row_once_whatever_the_number_of_source_files(spark, tmp_path):
    errors = [None, None, "FileNotFoundError", "cannot read source row", "ValueError: no payload", "ValueError: no payload"]
    digests = [hashlib.md5(f"IMG0{text}".encode()).hexdigest() if i % 6 < 2 else None for i, text, _ in DOCS]
    rows = mixed_cells(spark, tmp_path, 4).collect()
    want = [(i, lang, "train" if i % 4 else "val", digests[i], errors[i % 6]) for i, _, lang in DOCS]
    assert sorted((r.doc_id, r.lang, r.split, r.digest, r.error) for r in rows) == want


def test_contents_of_every_output_once(spark, tmp_path, monkeypatch):
    # Each file counts as more than half a task, so they are dealt into several.
    monkeypatch.setattr(preprocess, "TASK_BYTES", 100_000)
    want = {f"{at:03x}/{at % 3}-{at}.jpg": bytes([at]) * at for at in range(20)}
    store = FolderStore(str(tmp_path / "images"))
    for path, data in want.items():
        store(path, data)
    (tmp_path / "images/000/half.jpg.0f.part").write_bytes(b"half")
    for folder in (f"{tmp_path}/images", f"file://{tmp_path}/images/"):
        contents = output_contents(spark, folder, batch_rows=2)
        assert contents.rdd.getNumPartitions() > 5
        rows = contents.collect()
        assert len(rows) == len(want) and {row.output_path: bytes(row.content) for row in rows} == want


def test_no_outputs_no_contents(spark, tmp_path):
    assert output_contents(spark, f"{tmp_path}/none").collect() == []
