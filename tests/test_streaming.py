"""The running confusion table against one count of all files."""

import pytest
from pyspark.sql import functions as F

from sluice.plans.networks import create_network, initial
from sluice.plans.scoring import score_counts
from sluice.sources.staging import names_in
from sluice.streaming import evaluation


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 900, 1, 3).select(
        "id", F.array(F.sin("id"), F.cos("id")).alias("scaled_features"), (F.col("id") % 3).cast("double").alias("label")
    ).persist()


def cells(counts):
    return {(r.label, r.prediction): (r.n, pytest.approx(r.loss)) for r in counts.collect()}


def run(spark, rows, tmp_path, net, flat, **options):
    return evaluation.stream_evaluate(
        spark, str(tmp_path / "in"), rows.schema, net, flat, str(tmp_path / "out"), str(tmp_path / "state"), **options
    )


def test_totals_follow_the_files(spark, rows, tmp_path):
    net = create_network("gru", 2, 3, hidden_size=4, num_layers=1)
    flat = initial(net, 3)
    source = str(tmp_path / "in")
    for i in range(3):
        rows.filter(F.col("id") % 3 == i).write.mode("append").parquet(source)
        found = run(spark, rows, tmp_path, net, flat, files_per_trigger=2)
        assert cells(found) == cells(score_counts(spark.read.parquet(source), net, flat))
        assert cells(found) == cells(evaluation.running_counts(spark, str(tmp_path / "out")))
    before = cells(found)
    assert cells(run(spark, rows, tmp_path, net, flat)) == before  # no new file
    assert len([n for n in names_in(spark, str(tmp_path / "out")) if n.startswith("batch-")]) <= 2


def test_a_trigger_that_runs_twice_counts_once(spark, rows, tmp_path, monkeypatch):
    """It stops after its totals are written and before the stream knows, as when a driver is lost."""
    net = create_network("linear", 2, 3)
    flat = initial(net, 3)
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    plain, calls = evaluation.drop_path, []

    def stopping(spark, path):
        calls.append(path)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return plain(spark, path)

    monkeypatch.setattr(evaluation, "drop_path", stopping)
    with pytest.raises(Exception, match="lost"):
        run(spark, rows, tmp_path, net, flat)
    assert 0 < evaluation.running_counts(spark, str(tmp_path / "out")).agg(F.sum("n")).first()[0] < 900
    assert cells(run(spark, rows, tmp_path, net, flat)) == cells(score_counts(rows, net, flat))


def test_nothing_read_yet(spark, tmp_path):
    assert evaluation.running_counts(spark, str(tmp_path / "none")).count() == 0
