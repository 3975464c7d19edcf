"""Operators over training histories: one row per run and epoch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import named


def best_epochs(
    history: DataFrame, run: str = "run_id", epoch: str = "epoch", score: str = "val_acc"
) -> DataFrame:
    """Add ``is_best``: the score beats every earlier one of the run, and zero."""
    earlier = (
        Window.partitionBy(named(run))
        .orderBy(named(epoch))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bar = F.coalesce(F.max(named(score)).over(earlier), F.lit(0.0))
    return history.withColumn("is_best", named(score) > F.greatest(bar, F.lit(0.0)))


@dataclass
class Plateau:
    """Learning rate that falls when a loss has not improved by one part in 10,000 for a while."""

    rate: float
    factor: float = 0.1
    patience: int = 3
    min_lr: float = 1e-6
    threshold: float = 1e-4
    best: float = float("inf")
    bad: int = 0

    def step(self, loss: float) -> float:
        if loss < self.best * (1.0 - self.threshold):
            self.best, self.bad = loss, 0
        else:
            self.bad += 1
        if self.bad > self.patience:
            lower = max(self.rate * self.factor, self.min_lr)
            if self.rate - lower > 1e-8:
                self.rate = lower
            self.bad = 0
        return self.rate


def plateau_lr(
    history: DataFrame,
    start: float,
    factor: float = 0.1,
    patience: int = 3,
    min_lr: float = 1e-6,
    run: str = "run_id",
    epoch: str = "epoch",
    loss: str = "val_loss",
    threshold: float = 1e-4,
) -> DataFrame:
    """Learning rate after each epoch of each run: the rule of :class:`Plateau`.

    A run's epochs, in order, are folded by an aggregate over their array; one row of a run
    holds its whole history. A missing loss counts as one that has not improved.
    """

    def step(held: Column, x: Column) -> Column:
        better = F.coalesce(x["loss"] < held["best"] * (1.0 - threshold), F.lit(False))
        bad = F.when(better, 0).otherwise(held["bad"] + 1)
        lower = F.greatest(held["rate"] * factor, F.lit(min_lr))
        falls = (bad > patience) & (held["rate"] - lower > 1e-8)
        rate = F.when(falls, lower).otherwise(held["rate"])
        return F.struct(
            rate.alias("rate"),
            F.when(better, x["loss"]).otherwise(held["best"]).alias("best"),
            F.when(bad > patience, 0).otherwise(bad).alias("bad"),
            F.concat(held["rates"], F.array(rate)).alias("rates"),
        )

    first = F.struct(
        F.lit(float(start)).alias("rate"), F.lit(float("inf")).alias("best"), F.lit(0).alias("bad"),
        F.array().cast("array<double>").alias("rates"),
    )
    cell = F.struct(named(epoch).cast("long").alias("epoch"), named(loss).cast("double").alias("loss"))
    runs = history.groupBy(named(run).alias("run_id")).agg(F.sort_array(F.collect_list(cell)).alias("epochs"))
    rates = F.aggregate("epochs", first, step, lambda held: held["rates"])
    return runs.select("run_id", "epochs", F.posexplode(rates).alias("at", "lr")).select(
        "run_id", F.get("epochs", F.col("at"))["epoch"].alias("epoch"),
        F.get("epochs", F.col("at"))["loss"].alias("loss"), "lr",
    )


def history_frame(spark, rows: Sequence[dict]) -> DataFrame:
    return spark.createDataFrame(
        list(rows),
        "run_id string, epoch int, lr double, train_loss double, train_acc double, "
        "val_loss double, val_acc double, is_best boolean",
    )
