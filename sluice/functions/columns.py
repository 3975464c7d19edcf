"""Projections by column name or type."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.functions import vector_to_array as ml_vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T


def quoted(column: str) -> str:
    """Column name for SQL text, safe for dots and blanks."""
    return "`" + column.replace("`", "``") + "`"


def named(column: str) -> Column:
    return F.col(quoted(column))


def drop_if_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def cast_numeric(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Cast the listed columns that exist to double; text that is no number becomes null."""
    wanted = set(names) - {c for c, kind in df.dtypes if kind == "double"}
    return df.selectExpr(
        *[
            f"try_cast({quoted(c)} AS DOUBLE) AS {quoted(c)}" if c in wanted else quoted(c)
            for c in df.columns
        ]
    )


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Categorical columns: every string column but the excluded ones, in table order."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def feature_columns(
    df: DataFrame, exclude: Sequence[str] = (), include_long: bool = False
) -> list[str]:
    """Numeric feature columns in table order, which is the order inside the vector.

    ``bigint`` columns are left out unless asked for: they are keys more often than measures.
    """
    kinds: tuple[type, ...] = (T.IntegerType, T.DoubleType, T.FloatType)
    if include_long:
        kinds += (T.LongType,)
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude
    ]


def vector_to_array(df: DataFrame, column: str) -> DataFrame:
    """Replace an ML vector column by an array of doubles; a null vector becomes an empty array."""
    empty = F.array().cast("array<double>")
    value = named(column)
    return df.withColumn(column, F.when(value.isNull(), empty).otherwise(ml_vector_to_array(value)))
