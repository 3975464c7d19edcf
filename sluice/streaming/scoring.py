"""Scoring a folder of feature files as a stream."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions.losses import argmax
from ..plans.networks import Network
from ..plans.scoring import score


def stream_score(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    net: Network,
    weights: np.ndarray,
    output: str,
    checkpoint: str,
    keep: Sequence[str] = (),
    features: str = "scaled_features",
    files_per_trigger: int = 1,
) -> DataFrame:
    """Score every file now in ``source`` and append the predictions to ``output``.

    Files already scored under the same checkpoint are not read again, so the job can be
    stopped, or lose executors, and go on where it was.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(source)
    )
    scored = score(rows, net, weights, features, keep)
    query = (
        scored.withColumn("prediction", argmax(scored["scores"]))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(output)
    )
    query.awaitTermination()
    return spark.read.parquet(output)
