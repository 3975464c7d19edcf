"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import named

#: The white space that separates words, and the bytes that ``bytes.split`` takes for it.
SPACE = " \t\n\x0b\x0c\r"


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Let the session hand texts to Python in small Arrow batches.

    Spark's own bounds, 10,000 rows and 64 MB, count for each stream between the JVM and Python;
    a stage with two Python steps has four of them per task.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def picked(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that no other column of the table can clash with ours."""
    return docs.select(*[named(c) for c in columns])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null is the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if t is None else t for t in column.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``limit`` bytes of one text column, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start, held = 0, 0
        for at, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
