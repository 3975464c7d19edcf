"""Endless fixed-size batches over staged shards, as a stream that a stop does not disturb.

A pass over a staged table is a number of steps; step ``k`` of a pass is positions
``k * batch_size`` up to the next step's of every shard, so each shard has one batch in it.
Steps are counted on over the passes. A small data source hands out step numbers and keeps
the next one as its offset, which Spark writes to the checkpoint; the rows themselves are
read by Spark's Parquet scan, from the files of these positions alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from ..sources.shards import Shards, batch_count

SOURCE = "sluice_steps"


class Steps(DataSource):
    """Step numbers 0, 1, 2, …: ``perTrigger`` of them at a time, up to ``until`` if it is given."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "step long"

    def simpleStreamReader(self, schema) -> StepReader:
        return StepReader(int(self.options["perTrigger"]), int(self.options.get("until", -1)))


class StepReader(SimpleDataSourceStreamReader):
    """The offset is the first step that has not been handed out."""

    def __init__(self, per_trigger: int, until: int):
        self.per_trigger, self.until = per_trigger, until

    def initialOffset(self) -> dict:
        return {"step": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        first = start["step"]
        end = first + self.per_trigger
        if self.until >= 0:
            end = max(first, min(end, self.until))
        return self.readBetweenOffsets(start, {"step": end}), {"step": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(step,) for step in range(start["step"], end["step"])])


def steps_of_pass(staged: Shards, batch_size: int) -> int:
    """Steps of one pass: the batches of the longest shard."""
    if staged.rows == 0 or batch_size < 1:
        raise ValueError("endless batches need rows and a positive batch size")
    return batch_count(staged.longest, batch_size)


def step_rows(staged: Shards, batch_size: int, first: int, end: int) -> DataFrame:
    """Rows of steps ``first`` up to ``end``, with their ``pass``, ``step`` and ``batch`` in the pass.

    At most one pass long, so there are two windows at most. The last batch of a pass is
    what is left of the shard.
    """
    steps = steps_of_pass(staged, batch_size)
    if not 0 < end - first <= steps:
        raise ValueError(f"between 1 and {steps} steps can be read at once, not {end - first}")
    taken = {"pass", "step", "batch"} & set(staged.schema.names)
    if taken:
        raise ValueError(f"the staged table has columns {sorted(taken)} already")
    parts = []
    for turn in range(first // steps, (end - 1) // steps + 1):
        low, high = max(first - turn * steps, 0), min(end - turn * steps, steps)
        batch = F.floor(F.col("pos") / batch_size)
        rows = staged.window(low * batch_size, high * batch_size)
        parts.append(
            rows.withColumns(
                {"pass": F.lit(turn).cast("long"), "batch": batch, "step": batch + turn * steps}
            )
        )
    return reduce(DataFrame.unionByName, parts)


def follow_batches(
    staged: Shards,
    batch_size: int,
    per_trigger: int,
    take: Callable[[DataFrame, int], None],
    checkpoint: str,
    until: int | None = None,
) -> StreamingQuery:
    """Hand the rows of step after step to ``take``, pass after pass; a running query.

    ``take(rows, number)`` gets the rows of ``per_trigger`` steps (of one pass at most) and the
    trigger's number. It gets them again under the same number when a trigger is repeated
    after a stop, so it should replace what it wrote under that number. A query that is
    started with the same checkpoint goes on at the step after the last finished trigger.
    Without ``until`` there is no last step: stop the query when enough has been read.
    """
    spark = staged.spark
    per_trigger = min(per_trigger, steps_of_pass(staged, batch_size))
    if per_trigger < 1:
        raise ValueError("steps per trigger must be positive")

    def hand(steps: DataFrame, number: int) -> None:
        low, high = steps.agg(F.min("step"), F.max("step")).first()
        if low is not None:
            take(step_rows(staged, batch_size, low, high + 1), number)

    spark.dataSource.register(Steps)
    source = spark.readStream.format(SOURCE).option("perTrigger", per_trigger)
    if until is not None:
        source = source.option("until", until)
    return source.load().writeStream.foreachBatch(hand).option("checkpointLocation", checkpoint).start()


def take_batches(
    staged: Shards,
    batch_size: int,
    per_trigger: int,
    take: Callable[[DataFrame, int], None],
    checkpoint: str,
    until: int,
) -> None:
    """:func:`follow_batches` up to step ``until``, waiting for it."""
    query = follow_batches(staged, batch_size, per_trigger, take, checkpoint, until)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
