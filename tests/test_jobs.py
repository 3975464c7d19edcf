"""The two programs from end to end, and the stream."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions.losses import argmax
from sluice.plans import jobs
from sluice.plans.training import train
from sluice.plans.jobs import ml_classes, prepare_flows, read_split, train_flows, train_frames
from sluice.plans.networks import create_network, initial
from sluice.plans.preprocess import FlowPreprocessor
from sluice.plans.scoring import score
from sluice.sources import reports, tables
from sluice.sources.staging import path_exists, app_folder
from sluice.streaming.scoring import stream_score


@pytest.fixture(scope="module")
def prepared(spark, folder, tmp_path_factory):
    base = tmp_path_factory.mktemp("flows")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").withColumn("row", F.monotonically_increasing_id())
    raw = lines.select(
        F.col("row").cast("string").alias("row"), F.col("l_quantity").cast("string").alias("IN_PKTS"),
        F.col("l_extendedprice").cast("string").alias("IN_BYTES"),
        F.when(F.col("l_quantity") > 25, "big").otherwise("small").alias("PROTO"),
        F.lit("x").alias("Dataset"), F.lit("1").alias("Label"),
        F.when(F.col("l_quantity") > 25, "Bot").when(F.col("l_discount") > 0.02, "Benign")
        .otherwise("Rare").alias("Attack"),
    )
    raw.write.option("header", "true").csv(str(base / "csv"))
    settings = FlowPreprocessor(min_class_rows=1500, key="row")
    return prepare_flows(spark, str(base / "csv"), str(base / "out"), settings)


def test_preparation_writes_disjoint_whole_splits(spark, prepared):
    assert sum(prepared.rows.values()) == prepared.fitted.labels.total
    frames = {name: read_split(spark, prepared.path, name) for name in prepared.rows}
    keys = [r.row for f in frames.values() for r in f.collect()]
    assert len(keys) == len(set(keys)) == prepared.fitted.labels.total
    assert prepared.fitted.features == ["IN_PKTS", "IN_BYTES", "PROTO_index"]


def test_training_program(spark, prepared, tmp_path):
    outcome = train_flows(
        spark, prepared.path, str(tmp_path), "gru", num_processes=2, epochs=3, batch_size=128,
        local_steps=8, learning_rate=0.02, hidden_size=8, num_layers=1, dropout=0.0,
        scheduler={"factor": 0.1, "patience": 3, "min_lr": 1e-6},
    )
    assert outcome.evaluation.accuracy > 0.9
    assert outcome.evaluation.rows == prepared.rows["test"]
    history = reports.read_history(spark, str(tmp_path / "training_history"))
    assert history.count() == 3
    report = reports.read_report_json(spark, str(tmp_path / "final_test_report"))
    assert {r["class"] for r in report.select("class").distinct().collect()} == {
        "Bot", "Benign", "accuracy", "macro avg", "weighted avg"
    }


def test_a_stopped_program_goes_on(spark, prepared, tmp_path, monkeypatch):
    """Called again after a stop, it uses the staged shards it finds and goes on after the last epoch."""
    options = dict(num_processes=2, batch_size=256, local_steps=2, dtype="float64", resume=True,
                   hidden_size=4, num_layers=1, dropout=0.1)
    whole = train_flows(spark, prepared.path, str(tmp_path / "whole"), "rnn", epochs=3, **options)
    assert not path_exists(spark, str(tmp_path / "whole" / "unfinished"))
    out = str(tmp_path / "stopped")

    def stopping(net, shards, rows, epochs, *args, **rest):
        train(net, shards, rows, 1, *args, **rest)
        raise KeyboardInterrupt

    monkeypatch.setattr(jobs, "train", stopping)
    with pytest.raises(KeyboardInterrupt):
        train_flows(spark, prepared.path, out, "rnn", epochs=3, **options)
    monkeypatch.undo()
    assert path_exists(spark, f"{out}/unfinished/state/epoch-000001")
    monkeypatch.setattr(jobs, "stage_shards", None)  # nothing is staged again
    again = train_flows(spark, prepared.path, out, "rnn", epochs=3, **options)
    drop = lambda x: x.training.history.drop("run_id").orderBy("epoch").collect()
    assert drop(again) == drop(whole) and (again.training.weights == whole.training.weights).all()
    assert not path_exists(spark, f"{out}/unfinished")


def test_keyless_preparation(spark, folder, tmp_path):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    lines.select(F.col("l_quantity").alias("IN_PKTS"), F.col("l_returnflag").alias("Attack")).write.option(
        "header", "true").csv(str(tmp_path / "csv"))
    found = prepare_flows(spark, str(tmp_path / "csv"), str(tmp_path / "out"), FlowPreprocessor(min_class_rows=1))
    assert sum(found.rows.values()) == lines.count()
    assert found.split("train").columns == ["scaled_features", "label", "weight"]


def test_unknown_network_and_empty_split_stop(spark, prepared, tmp_path):
    with pytest.raises(ValueError, match="no network of kind"):
        train_flows(spark, prepared.path, str(tmp_path), "cnn")


def left_behind(spark, work) -> set[str]:
    """Tables in the shared folder after ``work`` that were not there before."""
    import os

    held = lambda: set(os.listdir(app_folder(spark))) if os.path.isdir(app_folder(spark)) else set()
    before = held()
    work()
    return held() - before


def test_programs_leave_nothing_in_the_shared_folder(spark, prepared, folder, tmp_path):
    def work():
        settings = FlowPreprocessor(min_class_rows=1, max_side_rows=0)
        lines = spark.read.parquet(f"{folder}/lineitem.parquet")
        lines.select(
            F.col("l_quantity").alias("IN_PKTS"), F.col("l_returnflag").alias("Attack"),
            F.col("l_linestatus").alias("PROTO"),
        ).write.option("header", "true").csv(str(tmp_path / "csv"))
        found = prepare_flows(spark, str(tmp_path / "csv"), str(tmp_path / "prepared"), settings)
        assert sum(found.rows.values()) == lines.count()
        train_flows(
            spark, str(tmp_path / "prepared"), str(tmp_path / "run"), "linear", num_processes=2, epochs=1
        )

    assert left_behind(spark, work) == set()


def test_a_large_fit_is_dropped_when_it_is_closed(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_quantity", "l_linestatus", F.col("l_returnflag").alias("Attack")
    )
    settings = FlowPreprocessor(numeric=["l_quantity"], min_class_rows=1, max_side_rows=0)

    def work():
        with settings.fit(lines) as fitted:
            assert fitted.written and not fitted.labels.small
            assert fitted.transform(lines).count() == lines.count()

    assert left_behind(spark, work) == set()


def test_training_on_three_folders_with_a_saved_indexer(spark, prepared, tmp_path):
    """Prepared rows as vectors in folders of their own, classes from an ML label indexer."""
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.functions import array_to_vector

    for name in ("train", "val", "test"):
        rows = read_split(spark, prepared.path, name).drop("row")
        vectors = rows.withColumn("scaled_features", array_to_vector("scaled_features"))
        vectors.write.parquet(str(tmp_path / f"{name}_df"))
    names = spark.createDataFrame([("Benign",), ("Bot",), ("Bot",)], "Attack string")
    indexer = StringIndexer(inputCol="Attack", outputCol="label").fit(names)
    indexer.write().overwrite().save(str(tmp_path / "indexer"))
    classes = ml_classes(str(tmp_path / "indexer"))
    assert [tuple(r) for r in classes.orderBy("index").collect()] == [(0, "Bot"), (1, "Benign")]
    frames = [spark.read.parquet(str(tmp_path / f"{name}_df")) for name in ("train", "val", "test")]
    outcome = train_frames(
        *frames, classes, str(tmp_path / "run"), "rnn", num_processes=3, epochs=2, batch_size=64,
        local_steps=8, learning_rate=0.02, hidden_size=8, num_layers=1, dropout=0.0, drop_remainder=True,
    )
    assert outcome.evaluation.accuracy > 0.9
    report = reports.read_report_json(spark, str(tmp_path / "run" / "final_test_report"))
    assert {"Bot", "Benign"} <= {r["class"] for r in report.collect()}


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    spark.createDataFrame([("1", "x", "y")], "a string, b string, c string").coalesce(1).write.option(
        "header", "true").csv(str(tmp_path / "c"))
    found = tables.scan_csv(spark, str(tmp_path / "c"), ["b", "a"])
    assert found.columns == ["b", "a"] and found.first() == ("x", "1")
    with pytest.raises(Exception, match="absent"):
        tables.scan_csv(spark, str(tmp_path / "c"), ["absent"])


def test_csv_scan_is_untyped(spark, tmp_path):
    spark.createDataFrame([(1, None, "a,b"), (2, 0.5, 'q"q')], "a int, b double, c string").write.option(
        "header", "true").csv(str(tmp_path / "c"))
    frame = tables.scan_csv(spark, str(tmp_path / "c"))
    assert frame.dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    assert sorted(map(tuple, frame.collect())) == [("1", None, "a,b"), ("2", "0.5", 'q"q')]


def test_stream_equals_batch_and_reads_new_files_only(spark, tmp_path):
    net = create_network("lstm", 2, 3, hidden_size=4, num_layers=2)
    flat = initial(net, 2)
    rows = spark.range(900).select("id", F.array(F.sin("id"), F.cos("id")).alias("scaled_features"))
    place = [str(tmp_path / n) for n in ("in", "out", "state")]

    def run():
        return stream_score(spark, place[0], rows.schema, net, flat, *place[1:], keep=["id"])

    def expected(frame):
        scored = score(frame, net, flat, keep=["id"])
        scored = scored.withColumn("prediction", argmax(scored["scores"]))
        return sorted((r.id, r.prediction, tuple(np.round(r.scores, 9))) for r in scored.collect())

    def got(frame):
        return sorted((r.id, r.prediction, tuple(np.round(r.scores, 9))) for r in frame.collect())

    rows.filter("id < 600").repartition(3).write.parquet(place[0])
    assert got(run()) == expected(rows.filter("id < 600"))
    assert run().count() == 600
    rows.filter("id >= 600").write.mode("append").parquet(place[0])
    assert got(run()) == expected(rows)
