"""Limited-memory BFGS against dense formulas and plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.plans.lbfgs import GAIN, STEPS, direction, losses, train_lbfgs
from sluice.plans.networks import build, create_network, initial, softmax_loss, unpack, weighted_gradient


@pytest.fixture(scope="module")
def rows(spark):
    a, b = F.sin(F.col("id") * 1.3), F.cos(F.col("id") * 0.7)
    up = (a + b + 0.4 * F.sin(F.col("id") * 9.1) > 0.4).cast("double")
    return spark.range(0, 1500, 1, 3).select(
        F.array(a, b).alias("scaled_features"), up.alias("label"), (1.0 + up).alias("weight")
    ).persist()


def arrays(df):
    found = df.collect()
    return tuple(np.array([r[i] for r in found]) for i in (0, 1, 2))


def plain_loss(net, flat, x, y, w):
    scores, _ = build(net, unpack(net, flat))(x)
    return float((softmax_loss(scores, y.astype(int))[0] * w).mean())


def test_direction_is_the_dense_update():
    rng = np.random.default_rng(1)
    root = rng.standard_normal((6, 6))
    curved = root @ root.T + np.eye(6)
    moves = [rng.standard_normal(6) for _ in range(4)]
    changes = [curved @ s for s in moves]
    inverse = np.eye(6) * (moves[-1] @ changes[-1]) / (changes[-1] @ changes[-1])
    for s, y in zip(moves, changes):
        left = np.eye(6) - np.outer(s, y) / (y @ s)
        inverse = left @ inverse @ left.T + np.outer(s, s) / (y @ s)
    gradient = rng.standard_normal(6)
    assert np.allclose(direction(gradient, moves, changes), -inverse @ gradient, atol=1e-10)
    assert (direction(gradient, [], []) == -gradient).all()


@pytest.mark.parametrize("kind", ["linear", "gru"])
def test_losses_of_many_points_are_one_scan(rows, kind):
    net = create_network(kind, 2, 2, hidden_size=4, num_layers=1)
    points = [initial(net, i) for i in range(3)]
    found = losses(rows, net, points, block_rows=100)
    assert found == pytest.approx([plain_loss(net, p, *arrays(rows)) for p in points], rel=1e-10)


@pytest.mark.parametrize("memory", [1, 4])
def test_every_iteration_is_that_of_a_plain_loop(rows, memory):
    net = create_network("linear", 2, 2)
    x, y, w = arrays(rows)
    flat = initial(net, 2)
    done = train_lbfgs(rows, net, flat, 6, memory)
    moves, changes = [], []
    gradient = weighted_gradient(net, flat, x, y.astype(int), w)[0] / len(y)
    for p in done:
        way = direction(gradient, moves, changes)
        start = plain_loss(net, flat, x, y, w)
        step = next(s for s in STEPS if plain_loss(net, flat + s * way, x, y, w) <= start + GAIN * s * (gradient @ way))
        after = weighted_gradient(net, flat + step * way, x, y.astype(int), w)[0] / len(y)
        moves, changes = [*moves, step * way][-memory:], [*changes, after - gradient][-memory:]
        flat, gradient = flat + step * way, after
        assert p.step == step and np.allclose(p.weights, flat, atol=1e-8)
        assert p.loss == pytest.approx(plain_loss(net, flat, x, y, w), rel=1e-8)


def test_it_ends_at_the_minimum(rows):
    """Near the minimum the gradient is gone, far sooner than by plain descent."""
    net = create_network("linear", 2, 2)
    done = train_lbfgs(rows, net, initial(net), 25)
    found = [p.loss for p in done]
    assert all(b <= a + 1e-12 for a, b in zip(found, found[1:]))  # sums of two scans differ in the last digits
    x, y, w = arrays(rows)
    gradient = weighted_gradient(net, done[-1].weights, x, y.astype(int), w)[0] / len(y)
    assert np.abs(gradient).max() < 1e-3


def test_an_empty_table_stops(rows):
    net = create_network("linear", 2, 2)
    with pytest.raises(ValueError, match="no training rows"):
        train_lbfgs(rows.filter("label > 5"), net, initial(net))
