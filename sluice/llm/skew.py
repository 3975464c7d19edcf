"""Joins on keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Salts of a hot key for each partition's share of the rows that it holds.
SALTS = 16


def spread_join(rows: DataFrame, side: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``side``, which has each ``key`` once and in ``count`` how many rows have it.

    A key with at least a partition's share of the rows is hot: there are at most as many of
    them as shuffle partitions, whatever the size, so they are broadcast. Their rows are dealt
    over salts by their content, in proportion to their share, and ``side`` has such a key
    once per salt. ``side`` has to be cheap to read again; ``count`` is not in the result.
    """
    p = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = side.agg(F.sum(count)).first()[0] or 0
    zero = F.lit(0).cast("long")
    hot = side.filter((F.col(count) > SALTS) & (F.col(count) * p >= F.lit(total))).select(
        F.col(key).alias("__hot"), F.ceil(F.col(count) * (SALTS * p) / F.lit(max(total, 1))).alias("__salts")
    )
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.col("__salts"))
    left = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left").select(
        *rows.columns, F.coalesce(spread, zero).alias("__salt")
    )
    places = F.coalesce(F.sequence(zero, F.col("__salts") - 1), F.array(zero))
    rest = [c for c in side.columns if c not in (key, count)]
    right = side.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left").select(
        F.col(key).alias("__key"), *rest, F.explode(places).alias("__place")
    )
    met = (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__place"))
    return left.join(right, met, how).select(*rows.columns, *rest)
