"""A confusion table that follows a stream of labelled feature files."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..plans.networks import Network
from ..plans.scoring import score_counts
from ..sources.staging import drop_path, names_in

COUNTS = "label long, prediction long, n long, loss double"


def _published(spark: SparkSession, output: str) -> list[str]:
    """Totals that were written whole, the oldest first."""
    found = [name for name in names_in(spark, output) if name.startswith("batch-")]
    return [name for name in found if "_SUCCESS" in names_in(spark, f"{output}/{name}")]


def running_counts(spark: SparkSession, output: str) -> DataFrame:
    """Rows and summed loss per pair of classes, over all that the stream has read so far."""
    found = _published(spark, output)
    if not found:
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(f"{output}/{found[-1]}")


def stream_evaluate(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    net: Network,
    weights: np.ndarray,
    output: str,
    checkpoint: str,
    features: str = "scaled_features",
    label: str = "label",
    files_per_trigger: int = 1,
) -> DataFrame:
    """Evaluate every file now in ``source`` that this checkpoint has not seen; the totals so far.

    Each trigger adds its rows up, one row per pair of classes, and writes them with the totals
    of the trigger before under its own number. A trigger that runs again after a stop starts
    from the same earlier totals and replaces what it had written, so nothing counts twice;
    older totals than the one before go.
    """
    shared = spark.sparkContext.broadcast(weights)

    def add(batch: DataFrame, number: int) -> None:
        name = f"batch-{number:012d}"
        earlier = [n for n in _published(spark, output) if n < name]
        counts = score_counts(batch, net, shared, features, label).select("label", "prediction", "n", "loss")
        if earlier:
            counts = counts.unionByName(spark.read.schema(COUNTS).parquet(f"{output}/{earlier[-1]}"))
        totals = counts.groupBy("label", "prediction").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"))
        totals.coalesce(1).write.mode("overwrite").parquet(f"{output}/{name}")
        for old in earlier[:-1]:
            drop_path(spark, f"{output}/{old}")

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    query = (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        shared.destroy()
    return running_counts(spark, output)
