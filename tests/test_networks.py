"""Networks: gradients, row independence, weights on disk, choice by name."""

import numpy as np
import pytest

from sluice.plans.networks import (
    AdamW, build, create_network, initial, pack, softmax_loss, unpack, weighted_gradient,
)
from sluice.sources.reports import load_weights, save_weights

KINDS = ["rnn", "lstm", "gru", "transformer", "linear"]


def small(kind, **options):
    base = dict(hidden_size=4, num_layers=2, num_heads=2, dim_feedforward=6, dropout=0.0)
    return create_network(kind, 3, 4, **{**base, **options})


def block(rows=7, seed=1):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((rows, 3)), rng.integers(0, 4, rows), rng.uniform(0.5, 2.0, rows)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("dropout", [0.0, 0.4])
def test_gradient_is_the_difference_quotient(kind, dropout):
    net = small(kind, dropout=dropout)
    flat, (x, y, w) = initial(net, 3), block()

    def loss(at):
        rng = np.random.default_rng(5) if dropout else None
        return weighted_gradient(net, at, x, y, w, rng)[1]

    rng = np.random.default_rng(5) if dropout else None
    gradient = weighted_gradient(net, flat, x, y, w, rng)[0]
    for i in np.random.default_rng(0).choice(net.size, min(net.size, 60), replace=False):
        step = np.zeros(net.size)
        step[i] = 1e-6
        quotient = (loss(flat + step) - loss(flat - step)) / 2e-6
        assert gradient[i] == pytest.approx(quotient, rel=1e-4, abs=1e-6)


@pytest.mark.parametrize("kind", KINDS)
def test_rows_do_not_influence_each_other(kind):
    net = small(kind)
    run = build(net, unpack(net, initial(net)))
    x, _, _ = block()
    whole, _ = run(x)
    assert np.allclose(whole, np.concatenate([run(row[None])[0] for row in x]), atol=1e-12)


def test_lstm_by_hand():
    net = create_network("lstm", 1, 1, hidden_size=1, num_layers=1)
    p = {"lstm.weight_ih_l0": [[0.5], [0.3], [0.2]], "lstm.bias_ih_l0": [0.1, 0.2, 0.3],
         "lstm.bias_hh_l0": [0.0, 0.1, 0.2], "fc.weight": [[2.0]], "fc.bias": [1.0]}
    scores, _ = build(net, unpack(net, pack(net, p)))(np.array([[2.0]]))

    def s(a):
        return 1 / (1 + np.exp(-a))

    h = s(0.4 + 0.5) * np.tanh(s(1.0 + 0.1) * np.tanh(0.6 + 0.3))
    assert scores[0, 0] == pytest.approx(2 * h + 1)


def test_loss_is_stable_for_large_scores():
    loss, slope = softmax_loss(np.array([[1000.0, 0.0], [-1000.0, 1000.0]]), np.array([0, 0]))
    assert loss.tolist() == [0.0, 2000.0] and np.isfinite(slope).all()


def test_choice_by_name():
    net = create_network("gru", 5, 2, hidden_size=6)
    assert net.hidden_size == 6 and net.num_layers == 3 and net.dropout == 0.2
    with pytest.raises(ValueError, match="no network of kind 'cnn'"):
        create_network("cnn", 5, 2)
    with pytest.raises(ValueError, match="a network has no hiden_size"):
        create_network("gru", 5, 2, hiden_size=6)


def test_sizes_at_the_published_settings():
    assert create_network("rnn", 43, 16, hidden_size=64, num_layers=2).size == 8144
    shapes = create_network("gru", 43, 16, hidden_size=128).shapes()
    assert shapes["gru.weight_ih_l0"] == (384, 43) and shapes["fc1.weight"] == (64, 128)


@pytest.mark.parametrize("kind", KINDS)
def test_weights_round_trip(spark, tmp_path, kind):
    net = small(kind)
    flat = initial(net, 9)
    save_weights(spark, net, flat, str(tmp_path / "w"))
    assert np.array_equal(load_weights(spark, net, str(tmp_path / "w")), flat)
    with pytest.raises(ValueError, match="do not fit"):
        load_weights(spark, small(kind, hidden_size=8) if kind != "linear" else small("rnn"),
                     str(tmp_path / "w"))


def test_adamw_first_step_moves_by_the_rate():
    optimizer = AdamW(np.zeros(2), np.zeros(2))
    out = optimizer.update(np.array([1.0, -1.0]), np.array([0.5, -3.0]), 0.1)
    assert out == pytest.approx([1.0 - 0.001 - 0.1, -1.0 + 0.001 + 0.1], abs=1e-6)
