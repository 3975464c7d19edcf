"""Feature transforms: category indexes, assembled vectors, scaling by the sample deviation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import isfinite

import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.columns import named, quoted
from ..sources.staging import write_out
from .classes import by_frequency
from .lookup import MAX_BYTES, MAX_ROWS, SideTable, from_arrow, join_side, row_bytes

INVALID = ("error", "skip", "keep")


def all_present(columns: Sequence[str]) -> str:
    """SQL condition: none of the columns is null."""
    return " AND ".join([f"{quoted(c)} IS NOT NULL" for c in columns]) or "true"


def any_invalid(columns: Sequence[str]) -> str:
    """SQL condition: any of the columns is null, not a number, or infinite."""
    tests = [
        f"{quoted(c)} IS NULL OR isnan({quoted(c)}) OR abs({quoted(c)}) = double('Infinity')"
        for c in columns
    ]
    return " OR ".join(tests) or "false"


def category_counts(
    df: DataFrame, columns: Sequence[str], usable: str = "true", by: Sequence[str] = ()
) -> DataFrame:
    """(by, c, value, n, used): rows per value of the column numbered ``c``, from one scan.

    Columns are counted as if one after the other, each on the rows that survive the
    earlier ones: column j counts rows in which columns 1 to j are present. ``used``
    counts only rows in which all of them are, and ``usable`` holds.
    """
    cells = ", ".join(
        f"struct({i} AS c, CASE WHEN {all_present(columns[:i])} THEN {quoted(name)} END AS value)"
        for i, name in enumerate(columns)
    )
    return (
        df.selectExpr(
            *[quoted(name) for name in by],
            f"explode(array({cells})) AS cell",
            f"CASE WHEN {all_present(columns)} AND ({usable}) THEN 1 ELSE 0 END AS used",
        )
        .select(*[named(name) for name in by], "cell.c", "cell.value", "used")
        .filter(F.col("value").isNotNull())
        .groupBy(*[named(name) for name in by], "c", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("used").alias("used"))
    )


def category_tables(
    df: DataFrame,
    columns: Sequence[str],
    usable: str = "true",
    max_rows: int = MAX_ROWS,
) -> dict[str, SideTable]:
    """Index table of every categorical column, from one scan (see :func:`category_counts`)."""
    if not columns:
        return {}
    return tables_of_counts(category_counts(df, columns, usable), columns, max_rows)


def tables_of_counts(
    counts: DataFrame, columns: Sequence[str], max_rows: int = MAX_ROWS
) -> dict[str, SideTable]:
    """Index table of every column, from the counts (c, value, n, used) of its values."""
    spark = counts.sparkSession
    held = counts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {
            r.c: r
            for r in held.groupBy("c")
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum(row_bytes(held)).alias("bytes"),
                F.sum("n").alias("total"),
            )
            .collect()
        }
        few = [
            i for i, r in sizes.items()
            if r.rows <= max_rows and r.bytes * len(columns) <= MAX_BYTES
        ]
        fetched = held.filter(F.col("c").isin(few)).toArrow() if few else None
        tables = {}
        for i, name in enumerate(columns):
            size = sizes.get(i)
            if size is None or i in few:
                local = (fetched if fetched is not None else held.limit(0).toArrow())
                local = local.filter(pc.equal(local["c"], i)).drop_columns(["c"])
                total = size.total if size else 0
                side = SideTable(from_arrow(spark, local), "value", local.num_rows, total, local)
            else:
                part = write_out(held.filter(F.col("c") == i).drop("c"), "category")
                side = SideTable(part, "value", size.rows, size.total)
            tables[name] = by_frequency(side)
        return tables
    finally:
        held.unpersist()


def index_categories(df: DataFrame, tables: Mapping[str, SideTable]) -> DataFrame:
    """Replace each categorical column by ``<name>_index``; unseen and null values drop the row.

    Broadcast tables come first: rows they drop need not be shuffled for a large one.
    """
    kept = [c for c in df.columns if c not in tables]
    for name, side in sorted(tables.items(), key=lambda item: not item[1].small):
        df = join_side(df, name, side, {f"{name}_index": "index"}, "inner")
    indexes = [quoted(f"{name}_index") for name in tables]
    return df.selectExpr(
        *[quoted(c) for c in kept], *[f"CAST({c} AS DOUBLE) AS {c}" for c in indexes]
    )


def _number(value: float) -> str:
    return f"{value!r}D" if isfinite(value) else f"double('{value}')"


def assemble_features(
    df: DataFrame,
    columns: Sequence[str],
    output: str = "raw_features",
    invalid: str = "error",
    factors: Mapping[str, float] | None = None,
) -> DataFrame:
    """Add the feature vector, an array of doubles, each multiplied by its factor if factors are given.

    ``invalid`` says what a null, NaN or infinite value does: ``error`` stops, ``skip`` drops
    the row, ``keep`` puts NaN. The error check looks at the finished array: one small expression, however
    many columns there are, so that the generated code stays within what the JVM compiles.
    """
    if invalid not in INVALID:
        raise ValueError(f"invalid must be one of {INVALID}")
    if invalid == "skip":
        df = df.filter(f"NOT ({any_invalid(columns)})")
    cells = []
    for name in columns:
        cell = f"CAST({quoted(name)} AS DOUBLE)"
        if invalid == "keep":
            cell = f"CASE WHEN {any_invalid([name])} THEN double('NaN') ELSE {cell} END"
        if factors is not None:
            cell = f"{cell} * {_number(float(factors[name]))}"
        cells.append(cell)
    df = df.withColumn(output, F.expr(f"CAST(array({', '.join(cells)}) AS ARRAY<DOUBLE>)"))
    if invalid != "error":
        return df
    message = F.lit("null, NaN or infinite feature; use invalid='skip' or 'keep'")
    vector = named(output)
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    stop = F.raise_error(message).cast("array<double>")
    return df.withColumn(output, F.when(broken, stop).otherwise(vector))


def scaler_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of each column: one row per feature, one scan.

    All columns are one vector aggregate. Rows with an invalid value in any of them are left
    out; a column of one row or none has no deviation.
    """
    cells = ", ".join(f"CAST({quoted(c)} AS DOUBLE)" for c in columns)
    valid = df.filter(f"NOT ({any_invalid(columns)})").selectExpr(
        f"CAST(array({cells}) AS ARRAY<DOUBLE>) AS __x"
    )
    moments = Summarizer.metrics("mean", "variance", "count").summary(array_to_vector("__x"))
    found = valid.agg(moments.alias("m")).select(
        vector_to_array("m.mean").alias("mean"),
        vector_to_array("m.variance").alias("variance"),
        F.col("m.count").alias("n"),
    )
    names = F.array(*[F.lit(c) for c in columns])
    std = F.when(F.col("n") > 1, F.sqrt(F.get("variance", F.col("position"))))
    return found.select(
        "n", "mean", "variance", F.posexplode(names).alias("position", "feature")
    ).select(
        "position", "feature",
        F.when(F.col("n") > 0, F.get("mean", F.col("position"))).alias("mean"), std.alias("std"),
    )


def scale_factors(stats: Mapping[str, float | None]) -> dict[str, float]:
    """Multiplier of each feature: 1/std, and 0 for a constant or single-row column."""
    return {name: 1.0 / std if std else 0.0 for name, std in stats.items()}


def standard_scale(
    df: DataFrame, columns: Sequence[str], output: str = "scaled_features", invalid: str = "error"
) -> DataFrame:
    """Add the feature vector divided by the sample deviations, without centring."""
    stats = {r.feature: r.std for r in scaler_stats(df, columns).collect()}
    return assemble_features(df, columns, output, invalid, scale_factors(stats))
