"""Fitting the preparation from parts of a table that are measured one by one.

A part is two small tables: per class its row counts and the means and variances of all
numbers, and per class, categorical column and value the rows that have it. Parts of
different rows merge into the part of all of them, so rows that come later cost a scan of
themselves alone. What a fit decides from counts, the classes to keep, the order of values,
the weights and deviations, is decided from the merged part, as if it had been one table.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.columns import feature_columns, named, string_columns
from ..operators.features import any_invalid, category_counts, tables_of_counts
from ..operators.lookup import join_side
from ..sources.staging import collecting, path_exists, write_out
from .preprocess import FittedPreprocessor, FlowPreprocessor

_COUNTS = ("raw", "n", "valid", "bad")


@dataclass(frozen=True, eq=False)
class FitPart:
    """What fitting needs to know of some rows; ``label`` is the class column of both tables."""

    settings: FlowPreprocessor
    categories: tuple[str, ...]
    numbers: tuple[str, ...]
    classes: DataFrame
    values: DataFrame

    @classmethod
    def measure(cls, settings: FlowPreprocessor, rows: DataFrame) -> FitPart:
        """The part of ``rows``: one scan for the classes, one for the values."""
        if settings.label not in rows.columns:
            raise ValueError(f"no label column {settings.label}")
        if settings.fit_on != "all":
            raise ValueError("parts are fitted on all rows that they are given")
        data = settings.typed(rows)
        aside = [settings.label] + ([settings.key] if settings.key else [])
        categories = tuple(string_columns(data, exclude=aside))
        numbers = tuple(feature_columns(data, exclude=aside))
        classes = settings._class_moments(data, categories, numbers)
        usable = f"NOT ({any_invalid(numbers)})" if settings.invalid == "skip" else "true"
        if categories:
            values = category_counts(data, categories, usable, [settings.label])
        else:
            values = data.sparkSession.createDataFrame([], "label string, c int, value string, n long, used long")
        return cls(
            settings, categories, numbers,
            write_out(classes.withColumnRenamed(settings.label, "label"), "part-classes"),
            write_out(values.withColumnRenamed(settings.label, "label"), "part-values"),
        )

    def _head(self) -> str:
        return json.dumps(
            {"settings": asdict(self.settings), "categories": self.categories, "numbers": self.numbers}
        )

    def merge(self, *others: FitPart) -> FitPart:
        """The part of all rows of these parts, which must share no row."""
        for other in others:
            if other._head() != self._head():
                raise ValueError("parts of different settings or columns do not merge")
        parts = [self, *others]
        classes = reduce(DataFrame.unionByName, [p.classes for p in parts])
        values = reduce(DataFrame.unionByName, [p.values for p in parts])
        counts = classes.groupBy("label").agg(*[F.sum(c).alias(c) for c in _COUNTS])
        if self.numbers:
            counts = counts.join(_moments(classes), counts["label"].eqNullSafe(F.col("of")), "left").drop("of")
        values = values.groupBy("label", "c", "value").agg(F.sum("n").alias("n"), F.sum("used").alias("used"))
        return FitPart(
            self.settings, self.categories, self.numbers,
            write_out(counts, "part-classes"), write_out(values, "part-values"),
        )

    def fit(self) -> FittedPreprocessor:
        """The fitted form, equal to that of one fit on all rows."""
        settings = self.settings
        with collecting() as written:
            classes = settings._kept(self.classes.withColumnRenamed("label", settings.label))

            def tables():
                if not self.categories:
                    return {}
                kept = join_side(self.values, "label", classes, {}, "left_semi")
                counts = kept.groupBy("c", "value").agg(F.sum("n").alias("n"), F.sum("used").alias("used"))
                return tables_of_counts(counts, self.categories, settings.max_side_rows)

            return settings._fitted(classes, self.numbers, tables, written)

    def save(self, path: str) -> None:
        """Write the part, its settings last; a folder without them is no part."""
        spark = self.classes.sparkSession
        self.classes.write.mode("overwrite").parquet(f"{path}/classes")
        self.values.write.mode("overwrite").parquet(f"{path}/values")
        text = spark.createDataFrame([(self._head(),)], "value string").coalesce(1)
        text.write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FitPart:
        if not path_exists(spark, f"{path}/settings/_SUCCESS"):
            raise ValueError(f"{path} holds no part")
        head = json.loads(spark.read.text(f"{path}/settings").first()[0])
        return cls(
            FlowPreprocessor(**head["settings"]), tuple(head["categories"]), tuple(head["numbers"]),
            spark.read.parquet(f"{path}/classes"), spark.read.parquet(f"{path}/values"),
        )


def _moments(classes: DataFrame) -> DataFrame:
    """(of, means, variances) of each class over all its parts.

    The spread of a class is that inside the parts and that of their means around the common
    one; squares of the values themselves, which cancel, do not come up.
    """
    cell = Window.partitionBy("label", "i")
    n: Column = F.col("valid")
    mean = F.try_divide(F.sum(n * F.col("m")).over(cell), F.sum(n).over(cell))
    inside = F.when(n > 1, F.col("v") * (n - 1)).otherwise(0.0)
    each = (
        classes.filter(n > 0)
        .select("label", "valid", F.posexplode(F.arrays_zip("means", "variances")).alias("i", "z"))
        .select("label", "valid", "i", F.col("z.means").alias("m"), F.col("z.variances").alias("v"))
        .withColumn("mean", mean)
        .withColumn("away", inside + n * F.pow(F.col("m") - F.col("mean"), F.lit(2)))
        .groupBy("label", "i")
        .agg(
            F.first("mean").alias("mean"),
            F.coalesce(F.try_divide(F.sum("away"), F.sum("valid") - 1), F.lit(0.0)).alias("variance"),
        )
    )
    listed = F.sort_array(F.collect_list(F.struct("i", "mean", "variance")))
    return (
        each.groupBy(F.col("label").alias("of"))
        .agg(listed.alias("cells"))
        .select("of", F.col("cells.mean").alias("means"), F.col("cells.variance").alias("variances"))
    )
