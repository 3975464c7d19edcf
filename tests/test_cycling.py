"""Endless batches: what a step holds, that passes follow each other, and going on after a stop."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.sources import shards
from sluice.streaming import cycling


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    rows = spark.range(0, 1003, 1, 5).select(
        F.array(F.col("id") * 1.0).alias("scaled_features"), F.col("id").alias("label")
    )
    return shards.stage_shards(rows, 3, str(tmp_path_factory.mktemp("cycled") / "s"), file_rows=100)


def test_steps_hold_the_batches_of_each_shard(staged):
    assert cycling.steps_of_pass(staged, 50) == 7
    found = cycling.step_rows(staged, 50, 5, 9).collect()
    sizes = Counter((r["pass"], r["step"], r["batch"], r["shard"]) for r in found)
    last = {0: 335 - 300, 1: 34, 2: 34}
    for shard in range(3):
        assert sizes[0, 5, 5, shard] == sizes[1, 7, 0, shard] == sizes[1, 8, 1, shard] == 50
        assert sizes[0, 6, 6, shard] == last[shard]
    assert len(sizes) == 12


def test_only_steps_of_one_pass_at_once(staged):
    for first, end in ((0, 8), (3, 3)):
        with pytest.raises(ValueError):
            cycling.step_rows(staged, 50, first, end)
    with pytest.raises(ValueError):
        cycling.steps_of_pass(staged, 0)


def test_every_pass_has_every_row_once_over_a_stop(staged, tmp_path):
    """The second query fails in the middle of a trigger; the third repeats that trigger alone."""
    taken, calls = {}, []

    def take(rows, number):
        calls.append(number)
        taken[number] = [(r["pass"], r["step"], r["label"]) for r in rows.collect()]

    def fail(rows, number):
        take(rows, number)
        if number == 2:
            raise RuntimeError("stopped")

    state = str(tmp_path / "state")
    cycling.take_batches(staged, 50, 3, take, state, 4)
    assert sorted({step for rows in taken.values() for _, step, _ in rows}) == [0, 1, 2, 3]
    with pytest.raises(Exception, match="stopped"):
        cycling.take_batches(staged, 50, 3, fail, state, 14)
    cycling.take_batches(staged, 50, 3, take, state, 14)
    assert calls == [0, 1, 2, 2, 3, 4, 5]
    rows = [row for trigger in taken.values() for row in trigger]
    assert sorted({step for _, step, _ in rows}) == list(range(14))
    for turn in range(2):
        assert sorted(label for p, _, label in rows if p == turn) == list(range(1003))


def test_it_has_no_end_of_its_own(staged, tmp_path):
    passes = []
    query = cycling.follow_batches(
        staged, 400, 1, lambda rows, number: passes.append(rows.count()), str(tmp_path / "state")
    )
    try:
        while len(passes) < 3 and query.isActive:
            query.awaitTermination(1)
    finally:
        query.stop()
    assert passes[:3] == [1003, 1003, 1003]
