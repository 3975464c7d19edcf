"""Scoring rows with a network on every partition."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import named
from ..sources.shards import matrix
from .networks import Network, build, softmax_loss, unpack

BLOCK_ROWS = 4096


def _features(column: str, dtype: str) -> Column:
    """Half-width features also halve what crosses from the JVM to Python."""
    kind = "array<float>" if dtype == "float32" else "array<double>"
    return named(column).cast(kind).alias("__x")


def _shared(spark: SparkSession, weights: np.ndarray | Broadcast, dtype: str) -> Broadcast:
    """Weights for all tasks; a broadcast is the caller's, who can release it after the job."""
    if isinstance(weights, Broadcast):
        return weights
    return spark.sparkContext.broadcast(weights.astype(dtype))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Small blocks keep a layer's activations in the processor cache."""
    for start in range(0, batch.num_rows, BLOCK_ROWS):
        yield batch.slice(start, BLOCK_ROWS)


def score(
    df: DataFrame,
    net: Network,
    weights: np.ndarray | Broadcast,
    features: str = "scaled_features",
    keep: Sequence[str] = (),
    dtype: str = "float64",
) -> DataFrame:
    """Class scores of every row as an array column ``scores``, beside the kept columns."""
    spark = df.sparkSession
    picked = df.select(_features(features, dtype), *[named(c) for c in keep])
    schema = picked.drop("__x").schema.add("scores", T.ArrayType(T.DoubleType()))
    shared = _shared(spark, weights, dtype)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forward = build(net, unpack(net, shared.value))
        for whole in batches:
            for batch in _slices(whole):
                scores, _ = forward(matrix(batch.column(0), net.num_features, dtype))
                ends = np.arange(0, scores.size + 1, net.num_classes, dtype="int32")
                flat = pa.array(scores.astype("float64", copy=False).ravel())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.ListArray.from_arrays(ends, flat)],
                    names=[*keep, "scores"],
                )

    return picked.mapInArrow(run, schema)


def score_counts(
    df: DataFrame,
    net: Network,
    weights: np.ndarray | Broadcast,
    features: str = "scaled_features",
    label: str = "label",
    dtype: str = "float64",
) -> DataFrame:
    """Rows and summed cross-entropy per pair of true and predicted class.

    Each task adds its rows up before anything leaves it, so the shuffle carries at most
    one row per pair of classes and task. A label outside the classes is an error.
    """
    spark = df.sparkSession
    picked = df.select(_features(features, dtype), named(label).cast("long").alias("__y"))
    shared = _shared(spark, weights, dtype)
    classes = net.num_classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forward = build(net, unpack(net, shared.value))
        sums: dict[int, list] = {}
        for whole in batches:
            for batch in _slices(whole):
                y = batch.column(1).to_numpy(zero_copy_only=False)
                if batch.column(1).null_count or (len(y) and (y.min() < 0 or y.max() >= classes)):
                    raise ValueError(f"labels must lie in 0..{classes - 1}")
                scores, _ = forward(matrix(batch.column(0), net.num_features, dtype))
                loss, _ = softmax_loss(scores, y)
                cell = y * classes + scores.argmax(1)
                pairs, at = np.unique(cell, return_inverse=True)
                rows = np.bincount(at, minlength=len(pairs))
                losses = np.bincount(at, weights=loss, minlength=len(pairs))
                for pair, n, total in zip(pairs.tolist(), rows.tolist(), losses.tolist()):
                    entry = sums.setdefault(pair, [0, 0.0])
                    entry[0] += n
                    entry[1] += total
        pairs = np.fromiter(sums, "int64", len(sums))
        yield pa.RecordBatch.from_pydict(
            {
                "label": pa.array(pairs // classes),
                "prediction": pa.array(pairs % classes),
                "n": pa.array([v[0] for v in sums.values()], pa.int64()),
                "loss": pa.array([v[1] for v in sums.values()], pa.float64()),
            }
        )

    parts = picked.mapInArrow(run, "label long, prediction long, n long, loss double")
    return parts.groupBy("label", "prediction").agg(
        F.sum("n").alias("n"), F.sum("loss").alias("loss")
    )
