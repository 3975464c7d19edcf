"""Softmax cross-entropy and argmax over an array of class scores, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def log_sum_exp(scores: Column) -> Column:
    """One pass over the array: the running maximum and the sum scaled to it."""
    start = F.struct(F.lit(float("-inf")).alias("top"), F.lit(0.0).alias("total"))

    def step(acc: Column, x: Column) -> Column:
        higher = x > acc["top"]
        return F.struct(
            F.greatest(acc["top"], x).alias("top"),
            F.when(higher, acc["total"] * F.exp(acc["top"] - x) + F.lit(1.0))
            .otherwise(acc["total"] + F.exp(x - acc["top"]))
            .alias("total"),
        )

    return F.aggregate(scores, start, step, lambda acc: acc["top"] + F.log(acc["total"]))


def cross_entropy(scores: Column, label: Column) -> Column:
    """``-log softmax(scores)[label]``; null when the label is no index into the scores."""
    return log_sum_exp(scores) - F.get(scores, label.cast("int"))


def argmax(scores: Column) -> Column:
    """Index of the largest score; of equal scores, the first."""
    return F.array_position(scores, F.array_max(scores)) - F.lit(1)
