"""Weighted training of a network by limited-memory BFGS, as whole-table Spark jobs.

Each iteration is two scans: one for the gradient, which tasks add up over their rows and
a shuffle adds up by slices, and one for the line search, which works out the loss at all
step lengths at once. The direction comes from the last few pairs of moves and gradient
changes by the two-loop recursion; the driver holds these pairs, vectors of the model's size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.shards import blocks
from .networks import Network, build, softmax_loss, unpack
from .training import _arrays, _rows, gradient_round

#: Step lengths that a line search looks at, the longest first.
STEPS = tuple(2.0**-i for i in range(10))
#: A step must gain this part of what the slope promises.
GAIN = 1e-4


@dataclass(frozen=True)
class Progress:
    """One iteration: where it ended, the loss there, and the step taken; none ends the search."""

    weights: np.ndarray
    loss: float
    step: float | None


def losses(
    df: DataFrame, net: Network, points: Sequence[np.ndarray], features: str = "scaled_features",
    dtype: str = "float64", block_rows: int = 1024,
) -> np.ndarray:
    """Mean weighted loss over all rows at each of some points, in one scan."""
    shared = df.sparkSession.sparkContext.broadcast(np.array(points))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(shared.value)), 0
        for _, block in blocks(batches, block_rows):
            x, y, w, _ = _arrays(block, net, dtype, None)
            for i, point in enumerate(shared.value):
                scores, _ = build(net, unpack(net, point.astype(dtype)))(x)
                total[i] += float((softmax_loss(scores, y)[0] * w).sum())
            seen += block.num_rows
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total), pa.array([seen] * len(total), pa.int64())],
                names=["point", "loss", "rows"],
            )

    parts = _rows(df, features, dtype, None).mapInArrow(work, "point int, loss double, rows long")
    try:
        found = parts.groupBy("point").agg(F.sum("loss"), F.sum("rows")).orderBy("point").collect()
    finally:
        shared.destroy()
    if not found:
        raise ValueError("no training rows")
    return np.array([r[1] / r[2] for r in found])


def direction(gradient: np.ndarray, moves: list[np.ndarray], changes: list[np.ndarray]) -> np.ndarray:
    """Two-loop recursion: minus the inverse curvature, as the pairs know it, times the gradient."""
    q, shares = gradient.copy(), []
    for s, y in zip(reversed(moves), reversed(changes)):
        share = (s @ q) / (y @ s)
        shares.append(share)
        q -= share * y
    if moves:
        q *= (moves[-1] @ changes[-1]) / (changes[-1] @ changes[-1])
    for s, y, share in zip(moves, changes, reversed(shares)):
        q += (share - (y @ q) / (y @ s)) * s
    return -q


def train_lbfgs(
    df: DataFrame,
    net: Network,
    start: np.ndarray,
    iterations: int = 20,
    memory: int = 5,
    features: str = "scaled_features",
    dtype: str = "float64",
) -> list[Progress]:
    """All iterations until none of the steps gains enough. Dropout is off, so each is repeatable."""
    flat, out = np.array(start, float), []
    moves: list[np.ndarray] = []
    changes: list[np.ndarray] = []
    done = gradient_round(df, net, flat, features=features, dtype=dtype)
    if not done.rows:
        raise ValueError("no training rows")
    loss, gradient = done.loss / done.rows, done.vector / done.rows
    for _ in range(iterations):
        way = direction(gradient, moves, changes)
        slope = gradient @ way
        found = losses(df, net, [flat + step * way for step in STEPS], features, dtype)
        good = np.flatnonzero(found <= loss + GAIN * np.array(STEPS) * slope)
        if not len(good) or slope >= 0:
            out.append(Progress(flat, loss, None))
            return out
        step = STEPS[good[0]]
        moved = flat + step * way
        done = gradient_round(df, net, moved, features=features, dtype=dtype)
        after = done.vector / done.rows
        if (after - gradient) @ (moved - flat) > 1e-10:
            moves, changes = [*moves, moved - flat][-memory:], [*changes, after - gradient][-memory:]
        flat, gradient, loss = moved, after, done.loss / done.rows
        out.append(Progress(flat, loss, step))
    return out
