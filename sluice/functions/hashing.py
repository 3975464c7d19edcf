"""Repeatable splits and samples from a hash of the row key.

A row's place depends on its key and the seed alone, so it stays the same under
any partitioning, on a retry, and in another engine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .columns import named

BUCKETS = 10_000
FRACTIONS = {"train": 0.70, "val": 0.15, "test": 0.15}


def key_hash(key: Column, seed: int) -> Column:
    """Unsigned 32-bit hash of ``seed:key``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_bucket(key: Column, seed: int, buckets: int = BUCKETS) -> Column:
    return key_hash(key, seed) % F.lit(buckets)


def _split_name(place: Column, scale: float, fractions: Mapping[str, float]) -> Column:
    """Name of the split whose share of ``0..scale`` holds ``place``."""
    if abs(sum(fractions.values()) - 1.0) > 1e-9:
        raise ValueError("split fractions must add up to 1")
    *names, last = fractions
    choice, edge = None, 0.0
    for name in names:
        edge += fractions[name]
        below = place < round(edge * scale, 9)
        choice = F.when(below, name) if choice is None else choice.when(below, name)
    return F.lit(last) if choice is None else choice.otherwise(last)


def with_split(
    df: DataFrame,
    key: str,
    fractions: Mapping[str, float] = FRACTIONS,
    seed: int = 42,
    column: str = "split",
) -> DataFrame:
    """Add the split name of every row."""
    return df.withColumn(column, _split_name(hash_bucket(named(key), seed), BUCKETS, fractions))


def with_random_split(
    df: DataFrame,
    fractions: Mapping[str, float] = FRACTIONS,
    seed: int = 42,
    column: str = "split",
) -> DataFrame:
    """Add a random split name, for tables without a row key. It depends on the partitioning."""
    drawn = df.withColumn("__draw", F.rand(seed))
    return drawn.withColumn(column, _split_name(F.col("__draw"), 1.0, fractions)).drop("__draw")


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Keep the rows whose key hash falls into the first ``fraction`` of the hash range."""
    return df.filter(key_hash(named(key), seed) < F.lit(int(fraction * 2**32)))
