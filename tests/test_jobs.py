"""Whole jobs, sinks and streams."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import plan_of
from tallyloom.plans import curation, evaluation, inspection, preprocessing
from tallyloom.sources import manifests, quarantine, reports, workspace
from tallyloom.streaming import quarantine_batches, stream_metadata

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_source(spark, folder):
    rows = spark.range(900).select(
        F.concat(F.lit("crop"), F.col("id") % 4).alias("crop"),
        F.when(F.col("id") % 3 == 0, "Rust")
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("Spot "), F.col("id") % 17))
        .alias("canonical_disease"),
        F.lit("raw").alias("disease"),
        F.when(F.col("id") % 2 == 0, "leaf").otherwise("n/a").alias("plant_organ"),
        F.concat(F.lit("f"), "id").alias("filename"),
        F.struct(F.encode(F.repeat("id", 400), "UTF-8").alias("bytes"), F.lit(None).cast("string").alias("path")).alias("image"),
    )
    rows.repartition(3).write.parquet(folder)
    return folder


SELECTION = curation.Selection(min_class_rows=5, max_class_rows=60, max_train_rows=400)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("job"))
    source = write_source(spark, f"{root}/source")
    manifest = curation.build_manifest(spark, source, f"{root}/data", SELECTION)
    return root, source, manifest


def test_manifest(spark, built):
    root, source, manifest = built
    rows = manifest.collect()
    assert len(rows) == min(444, len(rows)) and "image" not in manifest.columns
    assert len({(row.shard_path, row.row_idx_in_shard) for row in rows}) == len(rows)
    assert {row.split for row in rows} == {"train", "val", "test"}
    assert max(row["count"] for row in manifest.groupBy("canonical_disease").count().collect()) <= 60
    statistics = spark.read.json(f"{root}/data/data_statistics").first()
    assert statistics.total_source_rows == 900 and statistics.selected_total_rows == len(rows)
    spread = spark.read.option("header", True).csv(f"{root}/data/class_distribution")
    assert spread.agg(F.sum("total_samples")).first()[0] == len(rows)
    val = manifests.read_manifest(spark, "val", ["/nowhere", f"{root}/data"])
    assert val.count() == sum(row.split == "val" for row in rows)
    assert "PartitionFilters: [isnotnull(split#" in plan_of(val)
    opened = {row[0] for row in val.select(F.input_file_name()).collect()}
    assert opened and all("split=val" in name for name in opened)
    with pytest.raises(FileNotFoundError):
        manifests.read_manifest(spark, "val", ["/nowhere"])


def test_published_manifests(spark, tmp_path):
    path = str(tmp_path / "manifest")
    rows = spark.range(40).select("id", F.when(F.col("id") % 4 == 0, "val").otherwise("train").alias("split"))
    manifests.write_manifest(rows.where("id < 4"), path)
    assert not os.path.exists(f"{path}-versions")
    assert manifests.read_manifest(spark, "train", [str(tmp_path)]).count() == 3  # plain, until one is published
    assert manifests.publish_manifest(rows, path) == 1
    old = manifests.read_manifest(spark, "train", [str(tmp_path)])
    # A version may be made from the one before; open readers keep what they opened.
    assert manifests.publish_manifest(manifests.current_manifest(spark, path).where("id >= 20"), path) == 2
    assert old.count() == 30 and manifests.read_manifest(spark, "train", [str(tmp_path)]).count() == 15
    assert manifests.current_manifest(spark, path, 1).count() == 40
    with pytest.raises(FileNotFoundError):
        manifests.current_manifest(spark, path, 7)


def test_failed_publication_stays_unseen(spark, tmp_path):
    path = str(tmp_path / "manifest")
    rows = spark.range(8).select("id", F.lit("val").alias("split"))
    broken = rows.withColumn("id", F.expr("IF(id = 5, raise_error('lost'), id)"))
    with pytest.raises(Exception, match="lost"):
        manifests.publish_manifest(broken, path)
    with pytest.raises(FileNotFoundError):
        manifests.read_manifest(spark, "val", [str(tmp_path)])
    manifests.publish_manifest(rows, path)
    with pytest.raises(Exception, match="lost"):
        manifests.publish_manifest(broken, path)
    assert manifests.read_manifest(spark, "val", [str(tmp_path)]).count() == 8
    # Two writers that took one number: every reader picks the same of them.
    log = manifests.manifest_versions(spark, path)
    log.withColumn("folder", F.lit("0")).write.mode("append").parquet(f"{path}-versions/log")
    assert manifests.read_manifest(spark, "val", [str(tmp_path)]).count() == 8
    manifests.publish_manifest(rows.limit(0), path)
    assert manifests.current_manifest(spark, path).count() == 0


def shout(data: bytes) -> bytes:
    return b"JPEG" + data


def test_preprocessing_and_training_rows(spark, built):
    root, source, manifest = built
    tallies = preprocessing.preprocess_manifest(spark, f"{root}/data", source, f"{root}/images", shout, max_rows=100).first()
    val = manifest.where("split = 'val'").count()
    train = manifests.read_manifest(spark, "train", [f"{root}/data"])
    assert train.count() <= 100 and "image_path" in train.columns
    assert tallies.total_rows == tallies.valid_rows == train.count() + val and tallies.bad_rows == 0
    row = train.first()
    assert os.path.getsize(row.image_path) > 400
    assert "image_path" not in manifests.read_manifest(spark, "test", [f"{root}/data"]).columns
    ready = preprocessing.training_rows(train).first()
    assert ready.rendered.endswith(f"{ready.answer}<|im_end|>\n") and ready.answer.startswith("Crop: ")
    asked = preprocessing.training_rows(train, with_answer=False).first()
    assert asked.rendered.endswith("<|im_start|>assistant\n") and asked.answer not in asked.rendered


def load_guess():
    def predict(batch):
        return [f"Diagnosis: {name}." if name != "Rust" else "Disease: rot" for name in batch["canonical_disease"]]

    return predict


def test_evaluation(spark, built):
    root, source, manifest = built
    key, bundles = ["shard_path", "row_idx_in_shard"], {}
    for split in ("val", "test"):
        rows = manifest.where(F.col("split") == split)
        bundles[split] = evaluation.predict_and_evaluate(rows, load_guess, key, f"{root}/{split}", shuffle_key="shuffle_key")
    rows = manifest.where("split = 'val'")
    right = rows.where("canonical_disease <> 'Rust'").count()
    row = bundles["val"].first()
    assert row.total_samples == rows.count() and row.normalized_accuracy == right / rows.count()
    assert row.weighted_recall == row.normalized_accuracy
    failed = spark.read.option("header", True).csv(f"{root}/val/failures")
    assert failed.count() == rows.count() - right
    report = evaluation.compare_splits(bundles, f"{root}/report")
    assert report.count() == 6
    shown = spark.read.json(f"{root}/report/final_report").where("metric = 'normalized_accuracy'").first()
    assert float(shown.val) == pytest.approx(row.normalized_accuracy, abs=5e-5)
    few = evaluation.evaluate(
        rows.withColumn("raw_output", F.lit("x")), key, f"{root}/few", max_rows=4, shuffle_key="shuffle_key"
    )
    assert few.first().total_samples == 4


def test_inspection_and_sample(spark, built):
    root, source, manifest = built
    profile, preview = inspection.inspect_source(spark, source, f"{root}/look", 3)
    assert {row.total_rows for row in profile.collect()} == {900} and profile.count() == 6
    rows = preview.orderBy("row_idx_in_shard").collect()
    assert [row.row_idx_in_shard for row in rows] == [0, 1, 2]
    assert rows[0].image == "<struct<bytes:binary,path:string>>" and "Diagnosis: " in rows[0].answer
    assert spark.read.json(f"{root}/look/sample_preview").count() == 3
    shown = evaluation.sample_predictions(manifest, load_guess, ["shard_path", "row_idx_in_shard"], f"{root}/demo", 9)
    for row in shown.collect():
        assert row.is_correct == (row.ground_truth_disease != "Rust") and row.plant_organ in ("leaf", "n/a")
    assert spark.read.json(f"{root}/demo/demo_predictions").count() == 9


def test_report_files(spark, tmp_path):
    report = spark.createDataFrame([("b", 0.12345), ("a", None)], "name string, score double")
    reports.write_json(reports.rounded(report), f"{tmp_path}/j")
    lines = [json.loads(row.value) for row in spark.read.text(f"{tmp_path}/j").collect()]
    assert {"name": "a", "score": None} in lines and {"name": "b", "score": 0.1234} in lines
    reports.write_csv(report, f"{tmp_path}/c", ["name"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").columns == ["name", "score"]
    odd = spark.createDataFrame([('a "b",\nc',)], "name string")
    reports.write_csv(odd, f"{tmp_path}/o")
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    assert reader.csv(f"{tmp_path}/o").first()[0] == 'a "b",\nc'


def test_shared_folder_is_the_one_of_the_session(spark):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    staged = workspace.stage(spark.range(5).where("id > 9"), "empty")
    assert staged.count() == 0 and staged.columns == ["id"]


def test_stream_with_quarantine(spark, tmp_path):
    df = spark.createDataFrame([(at, "ok" if at % 3 else None) for at in range(30)], "id long, state string")
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    rows = stream_metadata(spark, f"{tmp_path}/in", df.schema, ["id", "state"], max_files=1)
    checked = rows.withColumn("error", F.when(F.col("state").isNull(), F.lit("no state")))
    write = quarantine_batches(f"{tmp_path}/good", f"{tmp_path}/bad", "id")
    for attempt in range(2):  # the second stream starts over, as after a lost checkpoint
        query = (
            checked.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{tmp_path}/check{attempt}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/good").count() == 20
    bad = spark.read.parquet(f"{tmp_path}/bad")
    assert bad.count() == 10 and {row.error for row in bad.collect()} == {"no state"}


def test_quarantine_appends(spark, tmp_path):
    outcome = spark.createDataFrame([("a", None), ("b", "broken")], "name string, error string")
    for _ in range(2):
        quarantine.append_quarantine(quarantine.bad_rows(outcome, "name"), f"{tmp_path}/q")
    rows = spark.read.parquet(f"{tmp_path}/q").collect()
    assert [row.filename for row in rows] == ["b", "b"] and all(row.timestamp for row in rows)
    assert [row[0] for row in quarantine.good_rows(outcome).collect()] == ["a"]
