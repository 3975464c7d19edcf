"""The two programs: raw table to prepared splits, and prepared splits to a tested model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import vector_to_array
from ..functions.hashing import FRACTIONS
from ..operators.classes import split_counts
from ..operators.metrics import dataset_metadata, label_names
from ..sources.reports import history_lists, load_weights, sink_history
from ..sources.shards import open_shards, stage_shards
from ..sources.staging import drop_path, path_exists, scratch, staging
from ..sources.tables import scan_csv
from .evaluate import Evaluation, evaluate_test_set
from .networks import create_network
from .preprocess import FittedPreprocessor, FlowPreprocessor, write_splits
from .training import Training, train


@dataclass(frozen=True)
class Prepared:
    path: str
    fitted: FittedPreprocessor
    rows: Mapping[str, int]

    def split(self, name: str) -> DataFrame:
        return read_split(self.fitted.labels.frame.sparkSession, self.path, name)


def _plain(frame: DataFrame) -> DataFrame:
    if isinstance(frame.schema["scaled_features"].dataType, VectorUDT):
        return vector_to_array(frame, "scaled_features")
    return frame


def read_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One split of prepared data; vectors become arrays."""
    frame = spark.read.parquet(f"{path}/splits").filter(F.col("split") == name)
    return _plain(frame.drop("split"))


def ml_classes(path: str) -> DataFrame:
    """Class table (``index``, ``value``) of a label indexer that Spark ML has saved."""
    labels = StringIndexerModel.load(path).labels
    spark = SparkSession.active()
    return spark.createDataFrame(list(enumerate(labels)), "index long, value string")


def prepare_flows(
    spark: SparkSession,
    source: str,
    output: str,
    settings: FlowPreprocessor | None = None,
    columns: Sequence[str] | None = None,
    fractions: Mapping[str, float] = FRACTIONS,
    seed: int = 42,
) -> Prepared:
    """CSV to prepared splits and fitted parts below ``output``.

    The text is parsed once, into a typed Parquet copy that fitting and transforming then
    read column by column; the copy and the fit's own tables are dropped at the end.
    """
    settings = settings or FlowPreprocessor()
    with staging(spark, "typed") as path, scratch(spark):
        typed = settings.typed(scan_csv(spark, source, columns))
        typed.write.parquet(path)
        typed = spark.read.schema(typed.schema).parquet(path)
        with settings.fit(typed) as fitted:
            fitted.save(spark, f"{output}/fitted")
            write_splits(fitted.transform(typed), f"{output}/splits", settings.key, fractions, seed)
    written = spark.read.parquet(f"{output}/splits")
    rows = {r["split"]: r["n"] for r in split_counts(written).collect()}
    fitted = FittedPreprocessor.load(spark, f"{output}/fitted")
    return Prepared(output, fitted, {name: rows.get(name, 0) for name in fractions})


@dataclass(frozen=True)
class Outcome:
    training: Training
    evaluation: Evaluation


def train_flows(spark: SparkSession, prepared: str, output: str, model_type: str, **options) -> Outcome:
    """:func:`train_frames` on the splits and the class table that :func:`prepare_flows` wrote."""
    splits = [read_split(spark, prepared, name) for name in ("train", "val", "test")]
    fitted = FittedPreprocessor.load(spark, f"{prepared}/fitted")
    return train_frames(*splits, label_names(fitted.labels), output, model_type, **options)


def train_frames(
    train_rows: DataFrame,
    val_rows: DataFrame,
    test_rows: DataFrame,
    classes: DataFrame,
    output: str,
    model_type: str,
    num_processes: int = 12,
    epochs: int = 100,
    batch_size: int = 1024,
    learning_rate: float = 0.002,
    scheduler: dict | None = None,
    local_steps: int = 16,
    seed: int = 0,
    dtype: str = "float32",
    drop_remainder: bool = False,
    resume: bool = False,
    **model_options,
) -> Outcome:
    """Train on one table, choose the best epoch on another, report on a third.

    Tables have ``scaled_features`` (vector or array), ``label`` and ``weight``; ``classes`` has
    ``index`` and ``value`` of every class. Weights, history and report are written below
    ``output``; staged shards are dropped. ``drop_remainder`` leaves out the last rows that
    do not fill a step. An empty table, unequal vectors or labels out of range stop the job.
    With ``resume`` staged shards and a record of each epoch stay below ``output`` until the
    training is over, and a call that finds them goes on from there.
    """
    spark = train_rows.sparkSession
    train_rows, val_rows, test_rows = map(_plain, (train_rows, val_rows, test_rows))
    facts = dataset_metadata(train_rows, "scaled_features", "label").first()
    for name, frame in (("training", train_rows), ("validation", val_rows), ("test", test_rows)):
        if frame.isEmpty():
            raise ValueError(f"the {name} split has no rows")
    net = create_network(model_type, facts.num_features, classes.count(), **model_options)
    wanted = train_rows.select("scaled_features", "label", "weight")
    kept = f"{output}/unfinished"
    with nullcontext(f"{kept}/shards") if resume else staging(spark, "train-shards") as path:
        if resume and path_exists(spark, f"{path}/_SUCCESS"):
            shards = open_shards(spark, path, num_processes)
        else:
            shards = stage_shards(wanted, num_processes, path)
        training = train(
            net, shards, val_rows, epochs, batch_size, local_steps, learning_rate, scheduler,
            seed, drop_remainder, dtype, output, state=f"{kept}/state" if resume else None,
        )
    if resume:
        drop_path(spark, kept)
    sink_history(training.history, f"{output}/training_history")
    lists = history_lists(training.history).withColumn("model_type", F.lit(model_type))
    lists.coalesce(1).write.mode("overwrite").json(f"{output}/training_history_lists")
    weights = training.best_weights
    if training.best_accuracy > 0:
        weights = load_weights(spark, net, f"{output}/best_weights")
    info = {"model_type": model_type, "best_val_accuracy": training.best_accuracy}
    evaluation = evaluate_test_set(test_rows, net, weights, classes, output, info, dtype=dtype)
    return Outcome(training, evaluation)
