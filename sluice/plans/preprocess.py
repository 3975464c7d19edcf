"""Preparation of raw flow tables: fit once, then transform any number of tables.

Fitting takes two scans whatever the number of columns: one aggregate by class for
the class counts and the moments of all numeric columns, and one for the counts of
all categories. Everything later is computed from those counts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import (
    cast_numeric,
    drop_if_present,
    feature_columns,
    named,
    quoted,
    string_columns,
)
from ..functions.hashing import FRACTIONS, with_random_split, with_split
from ..operators.classes import by_frequency, with_weights
from ..operators.features import (
    all_present,
    any_invalid,
    assemble_features,
    category_tables,
    index_categories,
    scale_factors,
)
from ..operators.lookup import MAX_ROWS, SideTable, join_side, settle
from ..sources.staging import collecting, drop_path

# The columns of the flow data set that are cast to double, the columns
# that are dropped, the class column, and the least rows a class must have.
FLOW_NUMERIC = (
    "L4_SRC_PORT",
    "L4_DST_PORT",
    "IN_BYTES",
    "IN_PKTS",
    "OUT_BYTES",
    "OUT_PKTS",
    "FLOW_DURATION_MILLISECONDS",
    "DURATION_IN",
    "DURATION_OUT",
    "MIN_TTL",
    "MAX_TTL",
    "LONGEST_FLOW_PKT",
    "SHORTEST_FLOW_PKT",
    "MIN_IP_PKT_LEN",
    "MAX_IP_PKT_LEN",
    "SRC_TO_DST_SECOND_BYTES",
    "DST_TO_SRC_SECOND_BYTES",
    "RETRANSMITTED_IN_BYTES",
    "RETRANSMITTED_IN_PKTS",
    "RETRANSMITTED_OUT_BYTES",
    "RETRANSMITTED_OUT_PKTS",
    "SRC_TO_DST_AVG_THROUGHPUT",
    "DST_TO_SRC_AVG_THROUGHPUT",
    "NUM_PKTS_UP_TO_128_BYTES",
    "NUM_PKTS_128_TO_256_BYTES",
    "NUM_PKTS_256_TO_512_BYTES",
    "NUM_PKTS_512_TO_1024_BYTES",
    "NUM_PKTS_1024_TO_1514_BYTES",
    "TCP_WIN_MAX_IN",
    "TCP_WIN_MAX_OUT",
    "DNS_QUERY_ID",
    "DNS_TTL_ANSWER",
    "FTP_COMMAND_RET_CODE",
    "ICMP_TYPE",
    "ICMP_IPV4_TYPE",
)
FLOW_DROPPED = ("Label", "Dataset")
FLOW_LABEL = "Attack"
FLOW_MIN_ROWS = 5000


def pooled_std(side: SideTable, n: str, means: str, variances: str | None = None) -> list[float]:
    """Sample deviations over all rows, from the means and sample variances of groups of ``n`` rows.

    The columns hold one number or an array of them; the result has one entry for each.
    """
    if side.rows == 0:
        return []
    if side.small:
        count = side.local[n].to_numpy().astype(float)[:, None]
        mean = np.array(side.local[means].to_pylist(), float).reshape(len(count), -1)
        inside = np.zeros_like(mean)
        if variances:
            inside = np.array(side.local[variances].to_pylist(), float).reshape(mean.shape)
        mean, inside = np.where(count > 0, mean, 0.0), np.where(count > 1, inside, 0.0)
        total = count.sum()
        if total <= 1:
            return [0.0] * mean.shape[1]
        centre = (count * mean).sum(0) / total
        spread = (inside * (count - 1) + count * (mean - centre) ** 2).sum(0)
        return np.sqrt(spread / (total - 1)).tolist()
    cells = (means, variances) if variances else (F.array(means), F.array(F.lit(0.0)))
    cells = [F.col(c) if isinstance(c, str) else c for c in cells]
    parts = (
        side.frame.filter(F.col(n) > 0)
        .select(F.col(n).alias("n"), cells[0].alias("m"), cells[1].alias("v"))
        .select("n", F.posexplode(F.arrays_zip("m", "v")).alias("i", "z"))
        .select("n", "i", F.col("z.m").alias("m"), F.col("z.v").alias("v"))
    )
    centres = parts.groupBy("i").agg(F.sum(F.col("n") * F.col("m")) / F.sum("n")).orderBy("i")
    centre = F.array(*[F.lit(float(r[1])) for r in centres.collect()])
    away = F.pow(F.col("m") - F.get(centre, F.col("i")), F.lit(2))
    inside = F.when(F.col("n") > 1, F.col("v") * (F.col("n") - 1)).otherwise(F.lit(0.0))
    spread = F.try_divide(F.sum(inside + F.col("n") * away), F.sum("n") - 1)
    found = parts.groupBy("i").agg(F.coalesce(spread, F.lit(0.0))).orderBy("i").collect()
    return [float(np.sqrt(r[1])) for r in found]


@dataclass(frozen=True)
class FlowPreprocessor:
    """Settings of the preparation; :meth:`fit` returns the fitted form.

    ``fit_on="all"`` fits on every row given, before any split. ``fit_on="train"`` keeps
    validation and test rows out of the statistics and needs ``key``.
    """

    label: str = FLOW_LABEL
    drop: Sequence[str] = FLOW_DROPPED
    numeric: Sequence[str] = FLOW_NUMERIC
    min_class_rows: int = FLOW_MIN_ROWS
    key: str | None = None
    invalid: str = "error"
    fit_on: str = "all"
    fractions: Mapping[str, float] = field(default_factory=lambda: dict(FRACTIONS))
    seed: int = 42
    max_side_rows: int = MAX_ROWS

    def typed(self, df: DataFrame) -> DataFrame:
        return cast_numeric(drop_if_present(df, self.drop), self.numeric)

    def fit(self, df: DataFrame) -> FittedPreprocessor:
        if self.label not in df.columns:
            raise ValueError(f"no label column {self.label}")
        if self.fit_on == "train":
            if self.key is None:
                raise ValueError("fit_on='train' needs a row key")
            df = with_split(df, self.key, self.fractions, self.seed, "__split")
            df = df.filter(F.col("__split") == "train").drop("__split")
        elif self.fit_on != "all":
            raise ValueError("fit_on must be 'all' or 'train'")
        with collecting() as tables_written:
            return self._fit(self.typed(df), tables_written)

    def _fit(self, data: DataFrame, written: list[str]) -> FittedPreprocessor:
        aside = [self.label] + ([self.key] if self.key else [])
        categories = string_columns(data, exclude=aside)
        numbers = feature_columns(data, exclude=aside)

        classes = self._kept(self._class_moments(data, categories, numbers))
        usable = f"NOT ({any_invalid(numbers)})" if self.invalid == "skip" else "true"

        def tables() -> Mapping[str, SideTable]:
            kept = join_side(data, self.label, classes, {}, "left_semi")
            return category_tables(kept, categories, usable, self.max_side_rows)

        return self._fitted(classes, numbers, tables, written)

    def _kept(self, moments: DataFrame) -> SideTable:
        """Classes with enough rows."""
        enough = (F.col("raw") >= self.min_class_rows) & named(self.label).isNotNull()
        return settle(moments.filter(enough), self.label, self.max_side_rows)

    def _fitted(
        self,
        classes: SideTable,
        numbers: Sequence[str],
        tables_of: Callable[[], Mapping[str, SideTable]],
        written: list[str],
    ) -> FittedPreprocessor:
        """The fitted form, from the moments of the kept classes and their index tables."""
        bad = classes.frame.agg(F.sum("bad")).first()[0]
        if bad and self.invalid == "error":
            raise ValueError(f"{bad} rows have a null, NaN or infinite feature; set invalid to skip or keep")
        found = pooled_std(classes, "valid", "means", "variances") if numbers else []
        stds = dict(zip(numbers, found or [0.0] * len(numbers)))

        tables = tables_of()
        for name, side in tables.items():
            stds[f"{name}_index"] = (pooled_std(side, "used", "index") or [0.0])[0]

        used = classes.frame.filter(F.col("n") > 0).select(
            named(self.label).alias("value"), F.col("n")
        )
        labels = with_weights(by_frequency(settle(used, "value", self.max_side_rows)))
        return FittedPreprocessor(self, labels, tables, stds, classes.frame.sparkSession, written)

    def _class_moments(
        self, data: DataFrame, categories: Sequence[str], numbers: Sequence[str]
    ) -> DataFrame:
        """Per class: all rows ``raw``, usable rows ``n``, those with an invalid number ``bad``, means and variances.

        Moments are those of rows without any invalid number, ``valid`` of them, also where
        invalid ones are kept: one infinite value must not spoil a whole column.

        The moments of all columns are one vector aggregate. An aggregate per column makes
        code of a size that the JVM leaves uncompiled.
        """
        complete, broken = all_present(categories), any_invalid(numbers)
        good = f"({complete}) AND NOT ({broken})" if self.invalid == "skip" else complete
        cells = ", ".join(
            f"CASE WHEN {any_invalid([c])} THEN 0.0D ELSE CAST({quoted(c)} AS DOUBLE) END"
            for c in numbers
        )
        # Wide expressions come last: the optimizer follows them through every later alias.
        tested = data.selectExpr(
            quoted(self.label),
            f"CAST(array({cells}) AS ARRAY<DOUBLE>) AS __x",
            f"({good}) AS __good",
            f"({complete}) AND ({broken}) AS __bad",
        )
        valid = F.col("__good") & ~F.col("__bad")
        weight = F.when(valid, 1.0).otherwise(0.0)
        counts = [
            F.count(F.lit(1)).alias("raw"),
            F.count_if("__good").alias("n"),
            F.count_if(valid).alias("valid"),
            F.count_if("__bad").alias("bad"),
        ]
        grouped = tested.groupBy(named(self.label))
        if numbers:
            moments = Summarizer.metrics("mean", "variance").summary(array_to_vector("__x"), weight)
            grouped = grouped.agg(*counts, moments.alias("moments")).select(
                named(self.label), "raw", "n", "valid", "bad",
                vector_to_array("moments.mean").alias("means"),
                vector_to_array("moments.variance").alias("variances"),
            )
        else:
            grouped = grouped.agg(*counts)
        return grouped


@dataclass(frozen=True)
class FittedPreprocessor:
    """Fitted class table, category tables and deviations, in feature order.

    Tables too large to broadcast lie in the shared folder until :meth:`close`, or the end of
    a ``with`` block.
    """

    settings: FlowPreprocessor
    labels: SideTable
    categories: Mapping[str, SideTable]
    stds: Mapping[str, float]
    spark: SparkSession
    written: list[str] = field(default_factory=list)

    def close(self) -> None:
        while self.written:
            drop_path(self.spark, self.written.pop())

    def __enter__(self) -> FittedPreprocessor:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()

    @property
    def features(self) -> list[str]:
        return list(self.stds)

    def transform(self, df: DataFrame, as_vector: bool = False) -> DataFrame:
        """Rows of known classes and categories as ``scaled_features``, ``label``, ``weight``.

        The row key is kept when the settings name one. A table without the label
        column gives the features alone.
        """
        data = self.settings.typed(df)
        key = [self.settings.key] if self.settings.key else []
        labelled = self.settings.label in data.columns
        outputs = {"__label": "index", "__weight": "weight"}
        if labelled:
            data = join_side(data, self.settings.label, self.labels, outputs, "inner")
        data = index_categories(data, self.categories)
        data = assemble_features(
            data, self.features, "__scaled", self.settings.invalid, scale_factors(self.stds)
        )
        vector = F.col("__scaled")
        columns = [
            *[named(k) for k in key],
            (array_to_vector(vector) if as_vector else vector).alias("scaled_features"),
        ]
        if labelled:
            columns.append(F.col("__label").cast("double").alias("label"))
            columns.append(F.coalesce(F.col("__weight"), F.lit(1.0)).alias("weight"))
        return data.select(*columns)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the settings as text and each fitted table as Parquet."""
        head = {"settings": asdict(self.settings), "categories": list(self.categories),
                "stds": dict(self.stds)}
        spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/settings")
        self.labels.frame.write.mode("overwrite").parquet(f"{path}/labels")
        for i, side in enumerate(self.categories.values()):
            side.frame.write.mode("overwrite").parquet(f"{path}/category_{i}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedPreprocessor:
        head = json.loads(spark.read.text(f"{path}/settings").first()[0])
        settings = FlowPreprocessor(**head["settings"])

        def table(name: str) -> SideTable:
            read = spark.read.parquet(f"{path}/{name}")
            return settle(read, "value", settings.max_side_rows, written=True)

        categories = {c: table(f"category_{i}") for i, c in enumerate(head["categories"])}
        return FittedPreprocessor(settings, table("labels"), categories, head["stds"], spark)


def write_splits(
    prepared: DataFrame,
    path: str,
    key: str | None,
    fractions: Mapping[str, float] = FRACTIONS,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """Write one table partitioned by split, in one job, and return a reader per split.

    Without a row key the rows are drawn at random. A task writes each of its rows to one
    split and commits all its files or none, so a repeated task loses and doubles nothing.
    """
    if key is None:
        placed = with_random_split(prepared, fractions, seed)
    else:
        placed = with_split(prepared, key, fractions, seed)
    placed.write.mode("overwrite").partitionBy("split").parquet(path)
    whole = prepared.sparkSession.read.schema(placed.schema).parquet(path)
    return {name: whole.filter(F.col("split") == name).drop("split") for name in fractions}
