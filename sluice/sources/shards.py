"""Balanced shards for training, their assignment to workers, and batched reading."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import named, vector_to_array
from ..functions.hashing import hash_bucket

FILE_ROWS = 1 << 17
_AT = "__at"


@dataclass(frozen=True)
class Shards:
    """A staged table whose rows are numbered 0, 1, 2, … as they stand in its files.

    Row ``number`` is at position ``number // count`` of shard ``number % count``. So shards
    differ by one row at most and have no gaps, whatever the files look like. ``parts`` has
    a file's address, the number of its first row, and what a row is marked with there.
    """

    spark: SparkSession
    schema: T.StructType
    path: str
    count: int
    rows: int
    parts: tuple[tuple[str, int, int], ...]

    @property
    def longest(self) -> int:
        """Positions of the longest shard."""
        return -(-self.rows // self.count)

    @property
    def frame(self) -> DataFrame:
        return self.window(0, self.longest)

    def window(self, first: int, end: int) -> DataFrame:
        """Rows at positions from ``first`` up to ``end`` of every shard, from their files alone."""
        low, high = min(first * self.count, self.rows), min(end * self.count, self.rows)
        starts = [start for _, start, _ in self.parts]
        held = self.parts[max(bisect_right(starts, low) - 1, 0) : bisect_right(starts, high - 1)]
        if low >= high or not held:
            read = self.spark.createDataFrame([], self.schema)
            held = ()
        else:
            read = self.spark.read.schema(self.schema).parquet(*[path for path, _, _ in held])
            # Marks count up with numbers, so the scan can skip pages before and after the window.
            (_, begin, least), (_, last, most) = held[0], held[-1]
            marks = least + max(low - begin, 0), most + high - 1 - last
            read = read.filter((F.col(_AT) >= marks[0]) & (F.col(_AT) <= marks[1]))
        # Marks count up within an input task, so a task's rows share one shift.
        shifts = {mark >> 33: start - mark for _, start, mark in held}
        moved = self.spark.createDataFrame(list(shifts.items()), "__task long, __shift long")
        number = F.col(_AT) + F.col("__shift")
        return (
            read.join(F.broadcast(moved), F.shiftright(_AT, 33) == F.col("__task"))
            .withColumn("number", number)
            .filter((F.col("number") >= low) & (F.col("number") < high))
            .withColumn("shard", (F.col("number") % self.count).cast("int"))
            .withColumn("pos", F.floor(F.col("number") / self.count))
            .drop(_AT, "__task", "__shift")
        )


def together(df: DataFrame, count: int) -> DataFrame:
    """Each shard's rows in a partition of their own, in order, however files are packed into tasks."""
    return df.repartitionById(count, F.col("shard")).sortWithinPartitions("shard", "pos")


def stage_shards(
    df: DataFrame,
    count: int,
    path: str,
    features: str = "scaled_features",
    file_rows: int = FILE_ROWS,
) -> Shards:
    """Write the rows as every input task has them, and deal them out by their number.

    Nothing is shuffled: a task writes its own rows, in files of at most ``file_rows``. What
    the files then hold gives each the number of its first row, and a row's number gives its
    shard, so balance does not depend on the tasks. One entry per file comes to the driver.
    """
    if count < 1 or file_rows < 1:
        raise ValueError("shard count and rows per file must be positive")
    taken = {"number", "shard", "pos", _AT} & set(df.columns)
    if taken:
        raise ValueError(f"the table has columns {sorted(taken)} already")
    if isinstance(df.schema[features].dataType, VectorUDT):
        df = vector_to_array(df, features)
    marked = df.withColumn(_AT, F.monotonically_increasing_id())
    marked.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)
    return open_shards(df.sparkSession, path, count)


def open_shards(spark: SparkSession, path: str, count: int) -> Shards:
    """Shards that :func:`stage_shards` has written: the same rows under the same numbers."""
    written = spark.read.parquet(path)
    held = (
        written
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min(_AT).alias("low"), F.max(_AT).alias("high"), F.count(F.lit(1)).alias("n"))
        .orderBy("low")
        .collect()
    )
    parts, rows = [], 0
    for file in held:
        if file.high - file.low + 1 != file.n:
            raise RuntimeError(f"{file.file} does not hold consecutive rows")
        parts.append((file.file, rows, file.low))
        rows += file.n
    return Shards(spark, written.schema, path, count, rows, tuple(parts))


def keyed_shards(df: DataFrame, key: str, count: int, seed: int = 42) -> DataFrame:
    """Add a ``shard`` that depends on the row key alone."""
    return df.withColumn("shard", hash_bucket(named(key), seed, count).cast("int"))


def shard_plan(
    spark: SparkSession, shards: int, rows: int, workers: int, batch_size: int
) -> DataFrame:
    """One row per worker: its shards, dealt in turn, its samples, and the steps of an epoch."""
    if workers < 1:
        raise ValueError("workers must be positive")
    step_rows = batch_size * workers
    steps = rows // step_rows if step_rows > 0 else 0
    worker = F.col("id")
    own = F.sequence(worker, F.lit(max(shards - 1, 0)).cast("long"), F.lit(workers).cast("long"))
    none = F.array().cast("array<bigint>")
    return spark.range(workers).select(
        worker.alias("worker"),
        F.when(worker < shards, own).otherwise(none).alias("shards"),
        F.lit(rows // workers).cast("long").alias("samples"),
        F.lit(steps).cast("long").alias("steps_per_epoch"),
    )


def batch_count(rows: int, batch_size: int) -> int:
    """Batches in one pass: none without a batch size, one for an unknown (zero) row count."""
    if not batch_size:
        return 0
    return 1 if rows == 0 else -(-rows // batch_size)


def matrix(column: pa.ListArray, width: int, dtype: str = "float64") -> np.ndarray:
    """Rows of equal length as a matrix; refuses missing or short vectors."""
    if len(column) == 0:
        return np.empty((0, width), dtype)
    lengths = pc.min_max(pc.list_value_length(column)).as_py()
    if column.null_count or lengths["min"] != width or lengths["max"] != width:
        raise ValueError(f"every feature vector must hold {width} values, found {lengths}")
    values = column.flatten()
    if values.null_count:
        raise ValueError("a feature vector holds a null")
    return values.to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def blocks(
    batches: Iterator[pa.RecordBatch], size: int, shard: str = "shard"
) -> Iterator[tuple[int, pa.Table]]:
    """Cut a task's rows into blocks of ``size`` rows that never cross from one shard to the next."""
    held: list[pa.RecordBatch] = []
    current: int | None = None
    waiting = 0
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index(shard)).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for start, end in zip(edges, edges[1:]):
            if start == end:
                continue
            if current is not None and ids[start] != current and held:
                yield current, pa.Table.from_batches(held)
                held, waiting = [], 0
            current = int(ids[start])
            while start < end:
                taken = min(size - waiting, end - start)
                held.append(batch.slice(start, taken))
                start, waiting = start + taken, waiting + taken
                if waiting == size:
                    yield current, pa.Table.from_batches(held)
                    held, waiting = [], 0
    if held:
        yield current, pa.Table.from_batches(held)


def batch_scan(
    df: DataFrame,
    batch_size: int,
    num_features: int,
    features: str = "scaled_features",
    label: str = "label",
    weight: str = "weight",
    shard: str = "shard",
) -> DataFrame:
    """Read batches of float32 features, int64 labels and float32 weights: one row per batch.

    Rows of a shard must be together (as in a staged table, or after a repartition by
    shard and a sort); the last batch of a shard holds what is left.
    """
    picked = df.select(
        named(shard).cast("int").alias("shard"),
        named(features).cast("array<float>").alias("x"),
        named(label).cast("long").alias("y"),
        named(weight).cast("float").alias("w"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in blocks(batches, batch_size):
            block = block.combine_chunks()
            x = matrix(block["x"].combine_chunks(), num_features, "float32")
            y, w = block["y"].to_numpy(), block["w"].to_numpy()
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([number], pa.int32()),
                    "rows": pa.array([len(y)], pa.int64()),
                    "label_sum": pa.array([int(y.sum())], pa.int64()),
                    "weight_sum": pa.array([float(w.sum(dtype="float64"))]),
                    "feature_sum": pa.array([float(x.sum(dtype="float64"))]),
                }
            )

    return picked.mapInArrow(
        run, "shard int, rows long, label_sum long, weight_sum double, feature_sum double"
    )
