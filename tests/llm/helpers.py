"""Small tables for the text operators, and plain versions of what they compute."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; a table may have them too.
CLASHES = (
    "row", "doc", "key", "keys", "bits", "size", "ids", "hash", "kept", "moment", "spot", "range",
    "n_words", "q_n_words", "node", "root", "number", "block", "word", "stretches", "start", "gone",
)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def table(spark: SparkSession, folder, rows: list, schema: str = SCHEMA, parts: int = 3) -> DataFrame:
    """Rows written as files and read back, as every stage gets them."""
    path = os.path.join(str(folder), uuid.uuid4().hex)
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def with_clashes(frame: DataFrame, but: tuple[str, ...] = ()) -> DataFrame:
    """The table with more columns, named as operators name theirs."""
    names = [c for c in CLASHES if c not in but and c not in frame.columns]
    return frame.select("*", *[F.lit("clash").alias(c) for c in names])


def doc(i: int | None, text: str | None, source: str | None = "s") -> tuple:
    return (i, text, "en", source, None if text is None else len(text))
