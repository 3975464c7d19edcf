"""Final test: score with the best weights, then all reports from one small table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from ..operators.lookup import settle
from ..operators.metrics import classification_report, confusion_matrix, confusion_pct, counts_summary
from ..sources.reports import sink_report_json
from .networks import Network
from .scoring import score_counts


@dataclass(frozen=True)
class Evaluation:
    counts: DataFrame
    report: DataFrame
    confusion: DataFrame
    percent: DataFrame
    accuracy: float
    loss: float
    rows: int


def evaluate_test_set(
    test: DataFrame,
    net: Network,
    weights: np.ndarray,
    classes: DataFrame,
    output: str | None = None,
    info: dict | None = None,
    features: str = "scaled_features",
    label: str = "label",
    dtype: str = "float64",
) -> Evaluation:
    """Report and confusion matrix of ``test``; ``classes`` has ``index`` and ``value`` per class.

    Scoring runs once on all executors and leaves one row per pair of classes that occurs.
    Stops when rows went missing.
    """
    counts = settle(score_counts(test, net, weights, features, label, dtype), "label").frame
    found = counts_summary(counts).first()
    expected = test.count()
    if found.rows != expected:
        raise RuntimeError(f"scored {found.rows} of {expected} rows")
    report = classification_report(counts, classes)
    matrix = confusion_matrix(counts, classes)
    if output:
        facts = {**(info or {}), "test_accuracy": found.accuracy}
        sink_report_json(report, f"{output}/final_test_report", facts)
    return Evaluation(
        counts, report, matrix, confusion_pct(matrix), found.accuracy, found.loss, found.rows
    )
