"""The same preparation as Spark ML stages, for exchange with programs that load ML models.

An ML label indexer is a list of its values, so the model of a column is as large as the
column has values, on the driver too; ``FlowPreprocessor`` is the form without that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import quoted
from ..operators.features import all_present


def ordered_values(df: DataFrame, categories: Sequence[str], label: str) -> list[list[str]]:
    """Values of each category and then of the label, most frequent first, from one scan.

    A category counts its own rows; the label counts rows in which all categories are there.
    """
    cells = [f"struct({i} AS c, CAST({quoted(c)} AS STRING) AS v)" for i, c in enumerate(categories)]
    kept = f"CASE WHEN {all_present(categories)} THEN CAST({quoted(label)} AS STRING) END"
    cells.append(f"struct({len(categories)} AS c, {kept} AS v)")
    counts = (
        df.selectExpr(f"explode(array({', '.join(cells)})) AS cell")
        .select("cell.c", "cell.v")
        .filter(F.col("v").isNotNull())
        .groupBy("c", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found: list[list[str]] = [[] for _ in cells]
    for row in counts.orderBy("c", F.desc("n"), "v").toLocalIterator():
        found[row.c].append(row.v)
    return found


def fit_stages(
    df: DataFrame, categories: Sequence[str], numbers: Sequence[str], label: str
) -> PipelineModel:
    """Indexers, assembler, scaler and label indexer, fitted on ``df`` in two scans."""
    *values, classes = ordered_values(df, categories, label)
    indexed = [f"{c}_index" for c in categories]
    stages = []
    if categories:
        stages.append(
            StringIndexerModel.from_arrays_of_labels(
                values, inputCols=list(categories), outputCols=indexed, handleInvalid="skip"
            )
        )
    stages.append(VectorAssembler(inputCols=[*numbers, *indexed], outputCol="raw_features"))
    rows = PipelineModel(stages).transform(df).select("raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="scaled_features").fit(rows)
    names = StringIndexerModel.from_labels(
        classes, inputCol=label, outputCol="label", handleInvalid="skip"
    )
    return PipelineModel([*stages, scaler, names])


def save_stages(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_stages(path: str) -> PipelineModel:
    return PipelineModel.load(path)
