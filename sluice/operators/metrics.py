"""Evaluation aggregates over true and predicted labels.

Raw rows are aggregated once, to one row per pair of classes; every report is made
from that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import named
from ..functions.losses import argmax, cross_entropy
from .lookup import SideTable, settle


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per pair of true and predicted class, computed now, so that reports share one scan."""
    counts = df.groupBy(
        named(label).cast("long").alias("label"), named(prediction).cast("long").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))
    return settle(counts, "label").frame


def confusion_matrix(counts: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Matrix as rows ``(label, prediction, n)``: the pairs that occur.

    ``classes``, a table with an ``index`` column, adds a zero for every other pair of its
    classes, so the grid is as large as that table says and not as the data happen to be.
    """
    seen = counts.select("label", "prediction", "n")
    if classes is None:
        return seen
    every = classes.select(F.col("index").cast("long").alias("class")).distinct()
    row = every.agg(F.sort_array(F.collect_list("class")).alias("every"))
    zeros = every.select(
        F.col("class").alias("label"),
        F.explode(row.select("every").scalar()).alias("prediction"),
        F.lit(0).alias("n"),
    )
    return seen.unionByName(zeros).groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def confusion_pct(matrix: DataFrame) -> DataFrame:
    """Share of each true class, in percent; null for a class without rows."""
    totals = matrix.groupBy("label").agg(F.sum("n").alias("row_n"))
    return matrix.join(totals, "label").select(
        "label",
        "prediction",
        "n",
        F.try_divide(F.col("n").cast("double"), F.col("row_n")).alias("share"),
    ).select("label", "prediction", "n", (F.col("share") * 100.0).alias("pct"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def class_report(counts: DataFrame, classes: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class of ``classes`` (``index``, ``value``).

    A class absent from labels and predictions gets zeros.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    name = F.lit(None).cast("string")
    tallies = (
        counts.select(
            F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("support"),
            zero.alias("predicted"), name.alias("name"),
        )
        .unionByName(
            counts.select(
                F.col("prediction").alias("class"), zero.alias("tp"), zero.alias("support"),
                F.col("n").alias("predicted"), name.alias("name"),
            )
        )
        .unionByName(
            classes.select(
                F.col("index").cast("long").alias("class"), zero.alias("tp"),
                zero.alias("support"), zero.alias("predicted"),
                F.col("value").cast("string").alias("name"),
            )
        )
        .groupBy("class")
        .agg(
            F.sum("tp").alias("tp"), F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"), F.max("name").alias("name"),
        )
    )
    rates = tallies.select(
        F.col("class"),
        F.coalesce(F.col("name"), F.col("class").cast("string")).alias("name"),
        F.col("support"),
        F.col("tp"),
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", _ratio(2 * p * r, p + r))


def classification_report(counts: DataFrame, classes: DataFrame) -> DataFrame:
    """Long report ``(class, metric, value, kind)``: every class, accuracy, macro and weighted means.

    ``kind`` is ``class`` or ``summary``, so a class may be called like a summary.
    """
    per_class = class_report(counts, classes)
    measures = ("precision", "recall", "f1")
    support = F.sum("support")

    def long_form(
        frame: DataFrame, name: Column, cells: dict[str, Column], kind: str = "summary"
    ) -> DataFrame:
        pairs = [
            F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value"))
            for m, v in cells.items()
        ]
        return frame.select(
            name.alias("class"), F.inline(F.array(*pairs)), F.lit(kind).alias("kind")
        )

    rows = long_form(
        per_class,
        F.col("name"),
        {"precision": F.col("precision"), "recall": F.col("recall"),
         "f1-score": F.col("f1"), "support": F.col("support")},
        "class",
    )
    means = per_class.agg(
        support.alias("support"),
        _ratio(F.sum("tp"), support).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[_ratio(F.sum(F.col(m) * F.col("support")), support).alias(f"weighted_{m}")
          for m in measures],
    )
    summary = long_form(means, F.lit("accuracy"), {"accuracy": F.col("accuracy")})
    for kind in ("macro", "weighted"):
        cells = {"precision": F.col(f"{kind}_precision"), "recall": F.col(f"{kind}_recall"),
                 "f1-score": F.col(f"{kind}_f1"), "support": F.col("support")}
        summary = summary.unionByName(long_form(means, F.lit(f"{kind} avg"), cells))
    return rows.unionByName(summary)


def label_names(side: SideTable) -> DataFrame:
    """Class table of a label index in the form the reports take."""
    return side.frame.select(F.col("index"), named(side.key).cast("string").alias("value"))


def accuracy_loss(df: DataFrame, scores: str = "scores", label: str = "label") -> DataFrame:
    """Mean cross-entropy and accuracy; zeros for an empty table."""
    z, y = named(scores), named(label).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.avg(cross_entropy(z, y)), F.lit(0.0)).alias("loss"),
        F.coalesce(F.avg((argmax(z) == y).cast("double")), F.lit(0.0)).alias("accuracy"),
    )


def counts_summary(counts: DataFrame) -> DataFrame:
    """Mean loss and accuracy from pair counts with summed losses."""
    rows = F.sum("n")
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0)))
    return counts.agg(
        F.coalesce(rows, F.lit(0)).alias("rows"),
        _ratio(F.sum("loss"), rows).alias("loss"),
        _ratio(right, rows).alias("accuracy"),
    )


def weighted_loss(
    df: DataFrame, scores: str = "scores", label: str = "label", weight: str = "weight"
) -> DataFrame:
    """Mean of weight x cross-entropy: divided by the number of rows, not by the weights."""
    loss = cross_entropy(named(scores), named(label).cast("long")) * named(weight)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(loss).alias("loss_sum"), F.avg(loss).alias("loss")
    )


def dataset_metadata(df: DataFrame, features: str, label: str) -> DataFrame:
    """Numbers of rows, classes and features; stops when vectors differ in length."""
    width = F.size(named(features))
    found = df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_distinct(named(label)).alias("num_classes"),
        F.min(width).alias("least"),
        F.max(width).alias("num_features"),
    )
    message = F.lit("feature vectors differ in length")
    return found.select(
        "num_rows",
        "num_classes",
        F.when(F.col("least") == F.col("num_features"), F.col("num_features"))
        .when(F.col("num_rows") == 0, F.lit(0))
        .otherwise(F.raise_error(message).cast("int"))
        .alias("num_features"),
    )
