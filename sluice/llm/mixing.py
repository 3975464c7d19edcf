"""Mixing sources to target weights along a curriculum, in DataFrame operations only.

Targets share a budget of words by weight and stop at a multiple of their source's size.
Documents of a source stand in a fixed pseudo-random order; a source is read whole as
often as its target allows, and the rest of the target is filled in that order. Each
reading of a document covers a stretch of its source's demand. The source's weight
schedule, integrated over the course of training, says which share of the demand is due
by each moment; its inverse turns the stretch into a moment, and documents are sorted by
it with a range partitioning.

Running sums need no task that holds a whole source: the order key, a hash, is cut into
4096 ranges. Ranges are summed first with partial aggregates; the running sum over at
most 4096 ranges of a source, plus the running sum inside one range, gives the place of
a document.

Defined results: a null text has no words; documents without words are never taken;
null is one source, after all others; rows that share a ``doc_id`` are ordered by a hash
of their text, and equal rows may change places, which changes no sum; a null ``doc_id``
is ordered by its text; of very long texts only the number of words matters, which may be
more than a target; an empty table gives an empty mix; other columns pass unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import named
from .text import fresh, word_count

WEIGHTS = (3, 1, 2)
#: Relative weight of a source at the start and at the end of training.
SCHEDULES = ((2.0, 1.0), (1.0, 1.0), (1.0, 2.0))
#: Hex digits of the order key that name a range of a source's order.
RANGE_DIGITS = 3


def _repeating(values: Sequence[float], place: Column) -> Column:
    array = F.array(*[F.lit(float(v)) for v in values])
    return F.element_at(array, (place % len(values) + 1).cast("int"))


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
) -> DataFrame:
    """One row per source: its size, weight, target and schedule, from (source, size) rows.

    A target is ``level * weight``, or ``most * source_size`` where that is less. Sources
    reach their limits in the order of limit / weight. While they do, the level computed
    from the sources still open rises, afterwards it falls; so the largest one is the level
    at which all targets add up to the budget, which is where resharing ends.
    """
    held = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    held = (
        held.withColumn("weight", _repeating(weights, place))
        .withColumn("start", _repeating([a for a, _ in schedules], place))
        .withColumn("end", _repeating([b for _, b in schedules], place))
        .withColumn("limit", F.col("source_size").cast("double") * float(most))
    )
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("source_size").over(whole).cast("double") * float(share)
    level = (budget - F.coalesce(full, F.lit(0.0))) / open_weight
    return (
        held.withColumn("level", level)
        .withColumn("target", F.least("limit", F.max("level").over(whole) * F.col("weight")))
        .select("source", "source_size", "weight", "start", "end", "target")
    )


def due_moment(share: Column, start: Column, end: Column) -> Column:
    """When a share of a source's demand is due, for a weight that runs from start to end.

    Solves ``start * t + (end - start) * t * t / 2 == share * (start + end) / 2`` for t.
    """
    area = share * (start + end)
    root = F.sqrt(F.greatest(start * start + (end - start) * area, F.lit(0.0)))
    moment = F.when(start + root > 0, area / (start + root)).otherwise(F.lit(0.0))
    return F.least(F.greatest(moment, F.lit(0.0)), F.lit(1.0))


def assign(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
) -> DataFrame:
    """(row, size, source_size, target, passes, moments) of each document.

    ``row`` is a struct of the columns ``keep``. ``passes`` is how often the document is
    read, ``moments`` has a moment in 0..1 for each reading.
    """
    key = F.md5(
        F.concat(
            F.coalesce(named("doc_id").cast("string"), F.md5(named("text")), F.lit("")),
            F.lit("/mix"),
        )
    )
    rows = docs.select(
        F.struct(*[named(c) for c in keep]).alias("row"),
        named("source").alias("source"),
        F.coalesce(named("source"), F.lit("")).alias("name"),
        named("source").isNull().alias("none"),
        word_count(named("text")).alias("size"),
        key.alias("spot"),
        F.xxhash64(named("text")).alias("tie"),
    ).withColumn("range", F.substring("spot", 1, RANGE_DIGITS))
    keys = ["name", "none", "range"]

    ranges = rows.groupBy("source", *keys).agg(F.sum("size").alias("range_size"))
    targets = source_targets(
        ranges.select("source", F.col("range_size").alias("size")), weights, share, most, schedules
    ).select(
        F.coalesce("source", F.lit("")).alias("name"),
        F.col("source").isNull().alias("none"),
        "source_size", "target", "start", "end",
    )
    earlier = Window.partitionBy("name", "none").orderBy("range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn(
        "range_from", F.coalesce(F.sum("range_size").over(earlier), F.lit(0))
    ).drop("source", "range_size")
    placed = rows.drop("source").join(ranges.join(targets, ["name", "none"]), keys)

    inside = Window.partitionBy(*keys).orderBy("spot", "tie")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    middle = (
        F.col("range_from")
        + F.coalesce(F.sum("size").over(inside), F.lit(0))
        + F.col("size") / 2.0
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    whole = F.coalesce(whole, F.lit(0))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    extra = (F.col("whole") < most) & (F.col("middle") <= rest)
    reading = F.when(F.col("size") > 0, F.col("whole") + extra.cast("long")).otherwise(F.lit(0))
    moment = lambda n: due_moment(
        (n * F.col("source_size") + F.col("middle")) / F.col("target"), F.col("start"), F.col("end")
    )
    return (
        placed.withColumn("middle", middle)
        .withColumn("whole", whole)
        .withColumn("passes", reading.cast("long"))
        .withColumn(
            "moments",
            F.when(
                F.col("passes") > 0,
                F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1), moment),
            ).otherwise(F.array().cast("array<double>")),
        )
        .select("row", "size", "source_size", "target", "passes", "moments", "spot")
    )


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in training order: each row once per reading, sorted by its moment."""
    moment, spot = fresh(docs, "moment"), fresh(docs, "spot")
    read = assign(docs, docs.columns, **options)
    read = read.select("row.*", F.explode("moments").alias(moment), F.col("spot").alias(spot))
    return read.orderBy(moment, spot).drop(moment, spot)
