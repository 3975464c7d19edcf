"""From raw documents to encoded training text: five stages, each over all that the last one kept.

Every stage takes any columns beside ``doc_id`` and ``text`` and returns those of its input, but
for the last. Null texts are empty and go with the quality rules, as do all texts of under
fifty words; repeated rows end in one row per group of near-duplicates; very long texts pass
each stage whole; a mix may read a document twice; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.functions.columns import named
from sluice.llm import lines, mixing, pieces, quality, simhash
from sluice.sources.staging import drop_path, new_path, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the default policy keeps."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` follows the text."""
    cleaned = lines.dedup_lines(docs, min_chars=40, min_docs=5)
    cleaned = cleaned.select(*[named(c) for c in docs.columns])
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mix reads it."""
    return mixing.curriculum(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece numbers of each text of the mix."""
    return pieces.encode(docs, keep=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("mixing sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

#: SimHash takes XXH64 of every shingle, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again.

    What a stage and its operator wrote is dropped as soon as the next result is there.
    """
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for at, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"stage-{at}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            drop_path(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
