"""Model weights, reports and histories as files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def save_weights(spark: SparkSession, net, flat: np.ndarray, path: str) -> None:
    """One row per parameter: name, shape, values. Its size is the model's, not the data's."""
    from ..plans.networks import unpack

    named = unpack(net, flat)
    table = pa.table(
        {
            "name": pa.array(list(named), pa.string()),
            "shape": pa.array([list(v.shape) for v in named.values()], pa.list_(pa.int32())),
            "values": pa.array([v.ravel() for v in named.values()], pa.list_(pa.float64())),
        }
    )
    spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, net, path: str) -> np.ndarray:
    """Flat parameter vector of ``net``; stops when a parameter is missing or misshapen."""
    from ..plans.networks import pack

    rows = spark.read.parquet(path).collect()
    found = {r.name: np.array(r["values"], float).reshape(r.shape) for r in rows}
    for name, shape in net.shapes().items():
        if name not in found or found[name].shape != tuple(shape):
            raise ValueError(f"weights at {path} do not fit: {name} must have shape {shape}")
    return pack(net, found)


#: Names that the report gives to other things than classes.
SUMMARIES = ("accuracy", "macro avg", "weighted avg", "model_info")
_CLASS = "class "


def report_json(report: DataFrame, info: dict | None = None) -> DataFrame:
    """The long report as one JSON object: an object of metrics per class and mean, accuracy as a number.

    A report has one row per class and metric, so one row holds it. ``info`` becomes
    ``model_info``. A class with the name of a summary is written with ``class`` before it.
    """
    of_class = F.col("kind") == "class"
    doubtful = F.col("class").isin(*SUMMARIES) | F.col("class").startswith(_CLASS)
    name = F.when(of_class & doubtful, F.concat(F.lit(_CLASS), "class")).otherwise(F.col("class"))
    named = report.withColumn("class", name)
    nested = named.filter(F.col("class") != "accuracy").groupBy("class")
    by_class = nested.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    objects = by_class.agg(F.map_from_entries(F.collect_list(F.struct("class", "m"))).alias("m"))
    accuracy = named.filter(F.col("class") == "accuracy").agg(F.max("value").alias("v"))
    whole = F.to_json(F.col("m"))
    rest = F.to_json(
        F.struct(
            accuracy.select("v").scalar().alias("accuracy"),
            *([F.struct(*[F.lit(v).alias(k) for k, v in info.items()]).alias("model_info")]
              if info else []),
        )
    )
    joined = F.concat(F.substring(whole, F.lit(1), F.length(whole) - 1), F.lit(","),
                      F.substring(rest, F.lit(2), F.length(rest)))
    return objects.select(joined.alias("value"))


def sink_report_json(report: DataFrame, path: str, info: dict | None = None) -> None:
    report_json(report, info).coalesce(1).write.mode("overwrite").text(path)


def read_report_json(spark: SparkSession, path: str) -> DataFrame:
    """A written report in its long form again."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(
        F.explode(F.from_json("value", "map<string, string>")).alias("class", "text")
    ).filter(F.col("class") != "model_info")
    plain = F.create_map(F.col("class"), F.col("text").try_cast("double"))
    cells = F.when(F.col("class") == "accuracy", plain).otherwise(
        F.from_json("text", "map<string, double>")
    )
    return entries.select(
        F.col("class").alias("written"), F.explode(cells).alias("metric", "value")
    ).select(
        F.regexp_replace("written", f"^{_CLASS}", "").alias("class"), "metric", "value",
        F.when(F.col("written").isin(*SUMMARIES), "summary").otherwise("class").alias("kind"),
    )


def history_lists(history: DataFrame) -> DataFrame:
    """One row per run with its losses and accuracies as lists in epoch order."""
    names = {"train_loss": "train_losses", "train_acc": "train_accuracies",
             "val_loss": "val_losses", "val_acc": "val_accuracies"}
    steps = F.array_sort(F.collect_list(F.struct("epoch", *names))).alias("s")
    runs = history.groupBy("run_id").agg(steps)
    return runs.select(
        F.col("run_id").alias("model_type"), *[F.col(f"s.{a}").alias(b) for a, b in names.items()]
    )


def sink_history(history: DataFrame, path: str) -> None:
    """History as JSON lines in epoch order; it has one row per run and epoch."""
    history.coalesce(1).sortWithinPartitions("run_id", "epoch").write.mode("overwrite").json(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "run_id string, epoch int, lr double, train_loss double, train_acc double, "
        "val_loss double, val_acc double, is_best boolean"
    ).json(path)
