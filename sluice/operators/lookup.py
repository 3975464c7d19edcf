"""Joining wide rows to a side table of one row per key value.

Side tables (class counts, weights, category indexes) are aggregates, so they are
usually tiny, but nothing guarantees it: a category may be an address. Every side
table is therefore measured first. Within the bounds it becomes a local relation
and is broadcast. Beyond them it stays a written table, and rows are matched by a
shuffle that no frequent key can unbalance (see :func:`_spread_join`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.storagelevel import StorageLevel

from ..functions.columns import named
from ..sources.staging import write_out

MAX_ROWS = 200_000
MAX_BYTES = 32 << 20
#: Salts of a hot key for each partition's share of rows that it holds.
SALTS = 16
#: Keys a summary follows for each key it has to find, and the most that Spark's summary can.
FOLLOWED, MAX_FOLLOWED = 16, 1_000_000


@dataclass(frozen=True)
class SideTable:
    """A keyed table with a count column ``n``; ``local`` holds it when it is within the bounds."""

    frame: DataFrame
    key: str
    rows: int
    total: int
    local: pa.Table | None = None

    @property
    def small(self) -> bool:
        return self.local is not None

    def with_local(self, spark: SparkSession, table: pa.Table) -> SideTable:
        return SideTable(from_arrow(spark, table), self.key, table.num_rows, self.total, table)


def from_arrow(spark: SparkSession, table: pa.Table) -> DataFrame:
    return spark.createDataFrame(table)


def row_bytes(frame: DataFrame) -> Column:
    """Bytes a row holds: eight for a number, the length of text, of JSON for arrays and the like."""
    size = F.lit(0)
    for field in frame.schema.fields:
        cell = named(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            held = F.coalesce(F.octet_length(cell), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            held = F.coalesce(F.octet_length(F.to_json(F.struct(cell))), F.lit(0))
        else:
            held = F.lit(8)
        size = size + held
    return size


def settle(
    frame: DataFrame,
    key: str,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
    written: bool = False,
) -> SideTable:
    """Compute a side table once, measure it, and keep it as a local relation or a written table.

    ``written`` says that ``frame`` is a table in files already, which then stays where it is.
    """
    held = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, size, total = held.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(row_bytes(held)), F.lit(0)),
            F.coalesce(F.sum("n"), F.lit(0)),
        ).first()
        if rows <= max_rows and size <= max_bytes:
            table = held.toArrow()
            return SideTable(from_arrow(frame.sparkSession, table), key, rows, total, table)
        kept = frame if written else write_out(held, "side")
        return SideTable(kept, key, rows, total)
    finally:
        held.unpersist()


def join_side(
    df: DataFrame, on: str, side: SideTable, values: Mapping[str, str], how: str = "inner"
) -> DataFrame:
    """Add columns of ``side`` to ``df``: ``values`` maps new column name to side column.

    ``how`` is ``inner`` (rows without a match, or with a null key, go), ``left`` or ``left_semi``.
    """
    taken = [v for v in values if v in df.columns]
    if taken:
        raise ValueError(f"the table has columns {taken} already")
    if not side.small:
        return _spread_join(df, on, side, values, how)
    picked = F.broadcast(
        side.frame.select(
            named(side.key).alias("__key"), *[named(s).alias(v) for v, s in values.items()]
        )
    )
    return df.join(picked, named(on) == F.col("__key"), how).drop("__key")


def _spread_join(
    df: DataFrame, on: str, side: SideTable, values: Mapping[str, str], how: str
) -> DataFrame:
    """Join to a side table too large to broadcast.

    A key is hot when it holds at least one part in ``p`` of the rows of ``df``, ``p`` being
    the number of shuffle partitions. :func:`frequent_keys` finds such keys on ``df`` itself,
    so values that the side table does not know, or that have become frequent since it was
    made, are found too. Their digests, at most ``2 * p``, are broadcast. Their rows are spread over salts in proportion to their share, enough of
    them that no partition draws many, and the side table has its one row of a hot key once
    per salt, ``25 * p`` rows in all at most. Each other key holds less than a partition's
    share. Rows with a null key have nothing to find and are spread by their content. Salts
    are made of a row's content and input partition, both the same when a task runs again.
    """
    p = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key, own = named(side.key), named(on)
    zero = F.lit(0).cast("long")
    total, found = frequent_keys(df, _digest(own), p)
    salted = [(k, -(-n * SALTS * p // total)) for k, n in found]
    hot = df.sparkSession.createDataFrame(salted, "__hot string, __salts long")

    drawn = F.xxhash64(*_hashable(df), F.spark_partition_id())
    spread = F.pmod(drawn, F.coalesce("__salts", F.lit(SALTS * p)))
    wide = df.join(F.broadcast(hot), _digest(own) == F.col("__hot"), "left")
    plain = F.col("__hot").isNull() & own.isNotNull()
    wide = wide.withColumn("__salt", F.when(plain, zero).otherwise(spread))
    places = F.sequence(zero, F.col("__salts") - 1)
    rest = side.frame.join(
        F.broadcast(hot), _digest(key) == F.col("__hot"), "left"
    ).select(
        key.alias("__key"),
        *[named(s).alias(f"__side_{v}") for v, s in values.items()],
        F.explode(F.when(F.col("__hot").isNull(), F.array(zero)).otherwise(places)).alias("__place"),
    )
    met = (F.col("__salt") == F.col("__place")) & (own == F.col("__key"))
    joined = wide.join(rest, met, {"left_semi": "left_semi", "left": "left"}.get(how, "inner"))
    columns = [named(c) for c in df.columns]
    if how == "left_semi":
        return joined.select(*columns)
    return joined.select(*columns, *[named(f"__side_{v}").alias(v) for v in values])


def frequent_keys(df: DataFrame, key: Column, parts: int) -> tuple[int, list[tuple[str, int]]]:
    """Rows with a text key, and the keys (with their counts) of at least one part in ``parts``.

    Every task sums its rows up in a frequent-items summary of a fixed number of keys, and
    summaries merge, so no row and no list of all keys is shuffled. A count is too high or too
    low by at most 3.5 rows in ``FOLLOWED * parts``, under a quarter of what a frequent key
    has. So all of them are found, with some that have over three quarters of the rows asked for.
    """
    parts = max(min(parts, MAX_FOLLOWED // FOLLOWED), 1)
    summary = F.expr(f"approx_top_k(__key, {2 * parts}, {FOLLOWED * parts})")
    held = df.select(key.alias("__key")).filter(F.col("__key").isNotNull())
    total, found = held.agg(F.count("__key"), summary).first()
    near = 1 - 3.5 / FOLLOWED
    return total, [(row["item"], row["count"]) for row in found if row["count"] * parts >= near * total]


def _digest(key: Column) -> Column:
    """A key of any length as the hashes of two seeds; null for null."""
    text = key.cast("string")
    both = F.concat_ws(":", F.xxhash64(text), F.xxhash64(text, F.lit(1)))
    return F.when(text.isNotNull(), both)


def _hashable(df: DataFrame) -> Sequence[Column]:
    plain = (T.MapType, T.UserDefinedType, T.VariantType)
    return [named(f.name) for f in df.schema.fields if not isinstance(f.dataType, plain)]


def rank_in_order(frame: DataFrame, order: Sequence[Column], column: str) -> DataFrame:
    """Number the rows 0, 1, 2, … in a total order, without gathering them in one task.

    A range sort gives each partition a contiguous part of the order. The written table
    fixes which row is where; then one offset per partition, of which there are at most
    as many as shuffle partitions, turns local positions into global ones.
    """
    spark = frame.sparkSession
    placed = write_out(
        frame.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), "ranked"
    )
    part = F.shiftright("__at", 33)
    position = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    starts, start = [], 0
    for number, count in sizes:
        starts.append((number, start))
        start += count
    offsets = spark.createDataFrame(starts, "__part long, __start long")
    return (
        placed.join(F.broadcast(offsets), part == F.col("__part"))
        .withColumn(column, F.col("__start") + position)
        .select(*[named(c) for c in frame.columns], column)
    )
