"""Staging, assignment to workers, and batches."""

import os

import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sluice.sources import shards
from sluice.sources.staging import new_path, scratch, shared_folder, staging, write_out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 10007, 1, 5).select(
        F.array(F.col("id") * 1.0, F.lit(2.0)).alias("scaled_features"),
        (F.col("id") % 3).cast("double").alias("label"),
        F.lit(1.0).alias("weight"),
    )


@pytest.mark.parametrize("file_rows", [300, 100_000])
def test_shards_are_balanced_and_whole(spark, rows, tmp_path, file_rows):
    staged = shards.stage_shards(rows, 4, str(tmp_path / "s"), file_rows=file_rows)
    held = staged.frame.select("shard", "pos", "number", F.get("scaled_features", F.lit(0)).alias("x")).collect()
    assert staged.rows == len(held) == 10007 and staged.longest == 2502
    assert sorted(r.x for r in held) == list(range(10007))
    assert sorted(r.number for r in held) == list(range(10007))
    for shard in range(4):
        places = sorted(r.pos for r in held if r.shard == shard)
        assert places == list(range(2502 if shard < 3 else 2501))


def test_staging_shuffles_nothing(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    staged = shards.stage_shards(source, 4, str(tmp_path / "s"))
    assert len(staged.parts) == source.rdd.getNumPartitions()


def test_a_round_reads_only_its_files(spark, rows, tmp_path):
    staged = shards.stage_shards(rows, 4, str(tmp_path / "s"), file_rows=500)
    assert len(staged.parts) == 25
    part = staged.window(500, 600)
    assert part.count() == 400
    starts = [start for _, start, _ in staged.parts] + [10007]
    overlapping = [a for a, b in zip(starts, starts[1:]) if a < 2400 and b > 2000]
    assert len(part.inputFiles()) == len(overlapping)
    assert staged.window(2502, 3000).count() == 0 and staged.window(2400, 9999).count() == 10007 - 9600


def test_the_scan_of_a_window_is_bounded_by_its_marks(spark, rows, tmp_path, capsys):
    """Rows before and after the window are left out by the scan, over task borders too."""
    staged = shards.stage_shards(rows, 4, str(tmp_path / "s"), file_rows=100_000)
    for first, end in ((0, 1), (100, 700), (2000, 2502), (499, 503)):
        part = staged.window(first, end)
        numbers = sorted(r.number for r in part.select("number").collect())
        assert numbers == list(range(first * 4, min(end * 4, 10007)))
        part.explain("formatted")
        pushed = next(line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line)
        assert "GreaterThanOrEqual(__at," in pushed and "LessThanOrEqual(__at," in pushed


def test_a_shard_is_one_partition_in_order(spark, rows, tmp_path):
    staged = shards.stage_shards(rows, 3, str(tmp_path / "s"), file_rows=500)
    whole = shards.together(staged.frame.repartition(9), 3)
    found = whole.select("shard", "pos", F.spark_partition_id().alias("p")).collect()
    assert {(r.shard, r.p) for r in found} == {(0, 0), (1, 1), (2, 2)}
    for shard in range(3):
        places = [r.pos for r in found if r.shard == shard]
        assert places == sorted(places)


def test_vectors_are_staged_as_arrays(spark, rows, tmp_path):
    vectors = rows.withColumn("scaled_features", array_to_vector("scaled_features"))
    staged = shards.stage_shards(vectors, 2, str(tmp_path / "s"))
    assert staged.frame.schema["scaled_features"].dataType.simpleString() == "array<double>"


def test_plan_deals_shards_in_turn(spark):
    plan = shards.shard_plan(spark, 5, 1000, 2, 64)
    found = {r.worker: r for r in plan.collect()}
    assert found[0].shards == [0, 2, 4] and found[1].shards == [1, 3]
    assert found[0].samples == 500 and found[0].steps_per_epoch == 1000 // 128
    assert shards.shard_plan(spark, 0, 10, 1, 0).first().steps_per_epoch == 0
    idle = shards.shard_plan(spark, 1, 10, 3, 1).collect()
    assert sorted(len(r.shards) for r in idle) == [0, 0, 1]


def test_batch_count_rules():
    assert shards.batch_count(10, 3) == 4
    assert shards.batch_count(9, 3) == 3
    assert shards.batch_count(0, 3) == 1
    assert shards.batch_count(10, 0) == 0
    assert shards.batch_count(2, 100) == 1


def batch(ids, values):
    return pa.RecordBatch.from_pydict({"shard": pa.array(ids, pa.int32()), "v": pa.array(values)})


def test_blocks_join_small_batches_and_stop_at_shards():
    source = [batch([0, 0], [1, 2]), batch([0, 0, 0, 1], [3, 4, 5, 6]), batch([], []), batch([1], [7])]
    source[2] = batch([], pa.array([], pa.int64()))
    out = [(s, t["v"].to_pylist()) for s, t in shards.blocks(iter(source), 2)]
    assert out == [(0, [1, 2]), (0, [3, 4]), (0, [5]), (1, [6, 7])]
    assert list(shards.blocks(iter([]), 2)) == []


@pytest.mark.parametrize("size", [1000, 4096, 50000])
def test_batch_scan_counts(spark, rows, tmp_path, size):
    staged = shards.stage_shards(rows, 3, str(tmp_path / "s"))
    out = shards.batch_scan(shards.together(staged.frame, 3), size, 2)
    sizes = {r.shard: r.n for r in staged.frame.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    got = out.groupBy("shard").agg(F.count("*").alias("b"), F.sum("rows").alias("n")).collect()
    assert {r.shard: r.n for r in got} == sizes
    assert {r.shard: r.b for r in got} == {s: -(-n // size) for s, n in sizes.items()}


def test_short_vectors_stop_the_scan(spark, rows, tmp_path):
    staged = shards.stage_shards(rows, 2, str(tmp_path / "s"))
    with pytest.raises(Exception, match="every feature vector must hold 3"):
        shards.batch_scan(staged.frame, 100, 3).collect()


def test_staging_is_dropped_also_after_an_error(spark):
    with pytest.raises(KeyError):
        with staging(spark, "gone") as path:
            spark.range(3).write.parquet(path)
            assert os.path.exists(path)
            raise KeyError
    assert not os.path.exists(path)


def test_scratch_tables_are_dropped_also_after_an_error(spark):
    with pytest.raises(KeyError):
        with scratch(spark):
            path = write_out(spark.range(3), "a").inputFiles()[0]
            raise KeyError
    assert not os.path.exists(path.removeprefix("file://"))


def test_paths_lie_in_the_shared_folder(spark):
    a, b = new_path(spark, "t"), new_path(spark, "t")
    assert a != b and a.startswith(shared_folder(spark))
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert a.startswith(named.rstrip("/"))
