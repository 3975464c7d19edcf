"""Class statistics: counts, rare-class filter, frequency-ordered index, balanced weights."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import named
from .lookup import MAX_ROWS, SideTable, join_side, rank_in_order, settle


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class; hash aggregation combines on the map side, so skew costs nothing."""
    return df.groupBy(named(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return class_counts(df, split)


def filter_isin(df: DataFrame, column: str, kept: list | DataFrame) -> DataFrame:
    """Rows whose value is among the kept ones: a list, or the first column of a table.

    A list stays a condition, which reaches the scan, whatever its length; its values take
    the column's type as in any comparison. A table is joined.
    """
    if isinstance(kept, DataFrame):
        values = kept.select(named(kept.columns[0]).alias("v")).distinct().withColumn("n", F.lit(1))
        return join_side(df, column, settle(values, "v"), {}, "left_semi")
    return df.filter(named(column).isin(kept))


def filter_rare_classes(
    df: DataFrame, label: str, threshold: int = 5000, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Keep the classes with at least ``threshold`` rows."""
    kept = class_counts(df, label).filter(F.col("n") >= threshold)
    return join_side(df, label, settle(kept, label, max_rows), {}, "left_semi")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight of each class: rows / (classes x rows of the class)."""
    counts = class_counts(df.filter(named(label).isNotNull()), label)
    totals = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    share = totals.select(F.col("rows") / F.col("classes")).scalar()
    return counts.withColumn("weight", share / F.col("n"))


def by_frequency(side: SideTable, column: str = "index") -> SideTable:
    """Add the position of each value: most frequent first, equal counts in text order."""
    key, spark = side.key, side.frame.sparkSession
    if side.small:
        ordered = side.local.sort_by([("n", "descending"), (key, "ascending")])
        numbers = pa.array(range(ordered.num_rows), pa.int64())
        return side.with_local(spark, ordered.append_column(column, numbers))
    ranked = rank_in_order(side.frame, [F.desc("n"), F.asc(key)], column)
    return SideTable(ranked, key, side.rows, side.total)


def with_weights(side: SideTable) -> SideTable:
    """Add the balanced weight to a class table."""
    scale = side.total / max(side.rows, 1)
    if side.small:
        weights = pc.divide(pa.scalar(scale), side.local["n"].cast(pa.float64()))
        return side.with_local(side.frame.sparkSession, side.local.append_column("weight", weights))
    frame = side.frame.withColumn("weight", F.lit(scale) / F.col("n"))
    return SideTable(frame, side.key, side.rows, side.total)


def label_index(df: DataFrame, label: str, max_rows: int = MAX_ROWS) -> SideTable:
    """The class table: value, row count, index (0 is the most frequent class), weight."""
    counts = class_counts(df.filter(named(label).isNotNull()), label)
    return with_weights(by_frequency(settle(counts, label, max_rows)))


def attach_class_weight(
    df: DataFrame, label: str, weights: SideTable, column: str = "weight"
) -> DataFrame:
    """Weight of each row's class; 1.0 for a class the table does not know."""
    joined = join_side(df, label, weights, {column: "weight"}, "left")
    return joined.withColumn(column, F.coalesce(F.col(column), F.lit(1.0)))


def decode_labels(df: DataFrame, index: str, labels: SideTable, column: str) -> DataFrame:
    """Class name of each label index; null for an index the table does not know."""
    turned = SideTable(labels.frame, "index", labels.rows, labels.total, labels.local)
    keyed = df.withColumn("__index", named(index).cast("long"))
    return join_side(keyed, "__index", turned, {column: labels.key}, "left").drop("__index")
