"""Table scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import named


def scan_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header row, every column as text; named columns are taken by their header."""
    frame = spark.read.option("header", "true").csv(path)
    return frame.select(*[named(c) for c in columns]) if columns else frame


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    frame = spark.read.parquet(path)
    return frame.select(*[named(c) for c in columns]) if columns else frame


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def mini_sample(df: DataFrame, key: Sequence[str], rows: int = 1000) -> DataFrame:
    """The first rows by a unique key, so that every run takes the same ones."""
    return df.orderBy(*[F.asc(k) for k in key]).limit(rows)
