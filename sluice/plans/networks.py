"""The four networks as NumPy steps over a block of rows.

Each row is a sequence of length one with no earlier state, so recurrent weights, the
forget gate and attention queries and keys have no effect and are left out. Parameters
carry their usual names; gate blocks are in the order input, cell, output (lstm) and
reset, update, new (gru). These steps run inside Spark tasks only.

A step maps ``x`` to ``(y, back)``; ``back`` takes the gradient of ``y``, adds the
gradients of the step's parameters to ``g`` and returns the gradient of ``x``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from itertools import accumulate

import numpy as np


@dataclass(frozen=True)
class Network:
    kind: str
    num_features: int
    num_classes: int
    hidden_size: int = 128
    num_layers: int = 3
    dropout: float = 0.2
    num_heads: int = 8
    dim_feedforward: int = 512

    def shapes(self) -> dict[str, tuple[int, ...]]:
        return _SHAPES[self.kind](self)

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.shapes().values())


def create_network(kind: str, num_features: int, num_classes: int, **sizes) -> Network:
    """The network of a kind; sizes are fields of :class:`Network`, any other option is refused."""
    if kind not in _SHAPES:
        raise ValueError(f"no network of kind {kind!r}; there are {', '.join(sorted(_SHAPES))}")
    unknown = sizes.keys() - {f.name for f in fields(Network)}
    if unknown:
        raise ValueError(f"a network has no {', '.join(sorted(unknown))}")
    return Network(kind, num_features, num_classes, **sizes)


def _dense_shape(name, n_out, n_in):
    return {f"{name}.weight": (n_out, n_in), f"{name}.bias": (n_out,)}


def _recurrent_shapes(net: Network, gates: int) -> dict:
    h, out = net.hidden_size, {}
    for i in range(net.num_layers):
        n_in = net.num_features if i == 0 else h
        out[f"{net.kind}.weight_ih_l{i}"] = (gates * h, n_in)
        out[f"{net.kind}.bias_ih_l{i}"] = (gates * h,)
        out[f"{net.kind}.bias_hh_l{i}"] = (gates * h,)
    return out


def _transformer_shapes(net: Network) -> dict:
    h, f = net.hidden_size, net.dim_feedforward
    out = _dense_shape("input_projection", h, net.num_features) | {"positional_encoding": (h,)}
    for i in range(net.num_layers):
        at = f"layers.{i}"
        for name, n_out, n_in in [
            ("value", h, h), ("out_proj", h, h), ("linear1", f, h), ("linear2", h, f)
        ]:
            out |= _dense_shape(f"{at}.{name}", n_out, n_in)
        for name in ("norm1", "norm2"):
            out |= {f"{at}.{name}.weight": (h,), f"{at}.{name}.bias": (h,)}
    out |= {"layer_norm.weight": (h,), "layer_norm.bias": (h,)}
    return out | _dense_shape("classifier", net.num_classes, h)


_SHAPES = {
    "rnn": lambda n: _recurrent_shapes(n, 1) | _dense_shape("fc", n.num_classes, n.hidden_size),
    "lstm": lambda n: _recurrent_shapes(n, 3) | _dense_shape("fc", n.num_classes, n.hidden_size),
    "gru": lambda n: _recurrent_shapes(n, 3)
    | _dense_shape("fc1", n.hidden_size // 2, n.hidden_size)
    | _dense_shape("fc2", n.num_classes, n.hidden_size // 2),
    "transformer": _transformer_shapes,
    "linear": lambda n: _dense_shape("fc", n.num_classes, n.num_features),
}


def unpack(net: Network, flat: np.ndarray) -> dict[str, np.ndarray]:
    """Named views into one flat parameter vector."""
    shapes = net.shapes()
    ends = list(accumulate(int(np.prod(s)) for s in shapes.values()))
    if len(flat) != ends[-1]:
        raise ValueError(f"{net.kind} needs {ends[-1]} parameters, got {len(flat)}")
    starts = [0, *ends]
    return {n: flat[a:b].reshape(s) for (n, s), a, b in zip(shapes.items(), starts, ends)}


def pack(net: Network, named: Mapping[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([np.asarray(named[n], float).ravel() for n in net.shapes()])


def initial(net: Network, seed: int = 0) -> np.ndarray:
    """Start values with the customary ranges: uniform in plus or minus 1/sqrt(fan)."""
    rng, flat = np.random.default_rng(seed), np.zeros(net.size)
    for name, view in unpack(net, flat).items():
        layer, kind = name.rsplit(".", 1) if "." in name else ("", name)
        if kind == "positional_encoding":
            view[:] = rng.standard_normal(view.shape)
        elif "norm" in layer:
            view[:] = kind == "weight"
        elif layer.endswith("value"):
            bound = np.sqrt(6.0 / (4 * net.hidden_size))
            view[:] = rng.uniform(-bound, bound, view.shape) if kind == "weight" else 0.0
        elif not (layer.endswith("out_proj") and kind == "bias"):
            recurrent = layer == net.kind
            fan = net.hidden_size if recurrent else net.shapes()[f"{layer}.weight"][1]
            view[:] = rng.uniform(-(fan**-0.5), fan**-0.5, view.shape)
    return flat


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _chain(*steps):
    def run(x):
        backs = []
        for step in steps:
            x, back = step(x)
            backs.append(back)

        def backward(dy):
            for back in reversed(backs):
                dy = back(dy)
            return dy

        return x, backward

    return run


def _residual(*steps):
    inner = _chain(*steps)

    def run(x):
        y, back = inner(x)
        return x + y, lambda dy: dy + back(dy)

    return run


def _dense(p, g, name):
    w, b = p[f"{name}.weight"], p[f"{name}.bias"]

    def run(x):
        def back(dy):
            g[f"{name}.weight"] += dy.T @ x
            g[f"{name}.bias"] += dy.sum(0)
            return dy @ w

        return x @ w.T + b, back

    return run


def _relu(x):
    return np.maximum(x, 0.0), lambda dy: dy * (x > 0)


def _dropout(rng, rate, per_head=None):
    """Inverted dropout; ``per_head`` drops whole heads, as dropout on a one-item attention does."""

    def run(x):
        if rng is None or rate == 0.0:
            return x, lambda dy: dy
        shape = x.shape if per_head is None else (len(x), per_head)
        mask = (rng.random(shape, dtype="float32") >= rate) * x.dtype.type(1.0 / (1.0 - rate))
        if per_head is not None:
            mask = np.repeat(mask, x.shape[1] // per_head, axis=1)
        return x * mask, lambda dy: dy * mask

    return run


def _norm(p, g, name, eps=1e-5):
    w, b = p[f"{name}.weight"], p[f"{name}.bias"]

    def run(x):
        centred = x - x.mean(1, keepdims=True)
        inverse = 1.0 / np.sqrt((centred**2).mean(1, keepdims=True) + eps)
        unit = centred * inverse

        def back(dy):
            g[f"{name}.weight"] += (dy * unit).sum(0)
            g[f"{name}.bias"] += dy.sum(0)
            d = dy * w
            return inverse * (d - d.mean(1, keepdims=True) - unit * (d * unit).mean(1, keepdims=True))

        return unit * w + b, back

    return run


def _recurrent(p, g, kind, layer, cell):
    """Input product of a recurrent layer, then its cell; the cell turns dh into (da, dbias_hh)."""
    w, bi, bh = (p[f"{kind}.{n}_l{layer}"] for n in ("weight_ih", "bias_ih", "bias_hh"))

    def run(x):
        h, cell_back = cell(x @ w.T + bi, bh)

        def back(dh):
            da, dbh = cell_back(dh)
            g[f"{kind}.weight_ih_l{layer}"] += da.T @ x
            g[f"{kind}.bias_ih_l{layer}"] += da.sum(0)
            g[f"{kind}.bias_hh_l{layer}"] += dbh
            return da @ w

        return h, back

    return run


def _rnn_cell(a, bh):
    h = np.tanh(a + bh)

    def back(dh):
        da = dh * (1.0 - h * h)
        return da, da.sum(0)

    return h, back


def _lstm_cell(a, bh):
    i, c, o = np.split(a + bh, 3, axis=1)
    i, c, o = _sigmoid(i), np.tanh(c), _sigmoid(o)
    t = np.tanh(i * c)

    def back(dh):
        ds = dh * o * (1.0 - t * t)
        parts = [ds * c * i * (1 - i), ds * i * (1 - c * c), dh * t * o * (1 - o)]
        da = np.concatenate(parts, axis=1)
        return da, da.sum(0)

    return o * t, back


def _gru_cell(a, bh):
    ar, az, an = np.split(a, 3, axis=1)
    br, bz, bn = np.split(bh, 3)
    r, z = _sigmoid(ar + br), _sigmoid(az + bz)
    n = np.tanh(an + r * bn)

    def back(dh):
        dn = dh * (1 - z) * (1 - n * n)
        da = np.concatenate([dn * bn * r * (1 - r), -dh * n * z * (1 - z), dn], axis=1)
        dbh = da.sum(0)
        dbh[2 * len(bn):] = (dn * r).sum(0)
        return da, dbh

    return (1.0 - z) * n, back


_CELLS = {"rnn": _rnn_cell, "lstm": _lstm_cell, "gru": _gru_cell}


def _encoder(p, g, net: Network, layer: int, rng):
    """Attention over one item is its value vector; residual and norm follow each half."""
    at, rate = f"layers.{layer}", net.dropout
    attention = _residual(
        _dense(p, g, f"{at}.value"), _dropout(rng, rate, net.num_heads),
        _dense(p, g, f"{at}.out_proj"), _dropout(rng, rate),
    )
    feedforward = _residual(
        _dense(p, g, f"{at}.linear1"), _relu, _dropout(rng, rate),
        _dense(p, g, f"{at}.linear2"), _dropout(rng, rate),
    )
    return _chain(attention, _norm(p, g, f"{at}.norm1"), feedforward, _norm(p, g, f"{at}.norm2"))


def _position(p, g):
    def run(x):
        def back(dy):
            g["positional_encoding"] += dy.sum(0)
            return dy

        return x + p["positional_encoding"], back

    return run


def build(net: Network, p: Mapping, g: Mapping | None = None, rng=None):
    """The whole network as one step. ``rng`` turns dropout on; ``g`` is needed for ``back`` only."""
    if net.kind == "linear":
        return _dense(p, g, "fc")
    if net.kind == "transformer":
        return _chain(
            _dense(p, g, "input_projection"), _position(p, g),
            *[_encoder(p, g, net, i, rng) for i in range(net.num_layers)],
            _norm(p, g, "layer_norm"), _dropout(rng, net.dropout), _dense(p, g, "classifier"),
        )
    steps = []
    for i in range(net.num_layers):
        steps.append(_recurrent(p, g, net.kind, i, _CELLS[net.kind]))
        steps.append(_dropout(rng, net.dropout))
    if net.kind == "gru":
        return _chain(
            *steps, _dense(p, g, "fc1"), _relu, _dropout(rng, net.dropout), _dense(p, g, "fc2")
        )
    return _chain(*steps, _dense(p, g, "fc"))


def softmax_loss(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy of each row and its gradient by the scores."""
    shifted = scores - scores.max(1, keepdims=True)
    exps = np.exp(shifted)
    sums = exps.sum(1, keepdims=True)
    rows = np.arange(len(scores))
    loss = np.log(sums[:, 0]) - shifted[rows, labels]
    slope = exps / sums
    slope[rows, labels] -= 1.0
    return loss, slope


def weighted_gradient(
    net: Network, flat: np.ndarray, x: np.ndarray, labels: np.ndarray, weights: np.ndarray, rng=None
) -> tuple[np.ndarray, float, int]:
    """Sums over the rows: gradient of weight x loss, weighted loss, right predictions.

    The arithmetic is done in the type of ``x``.
    """
    flat, weights = flat.astype(x.dtype, copy=False), weights.astype(x.dtype, copy=False)
    slope_flat = np.zeros_like(flat)
    scores, back = build(net, unpack(net, flat), unpack(net, slope_flat), rng)(x)
    loss, slope = softmax_loss(scores, labels)
    back(slope * weights[:, None])
    return slope_flat, float((loss * weights).sum(dtype="float64")), int((scores.argmax(1) == labels).sum())


@dataclass
class AdamW:
    """Adam with decoupled weight decay, in the customary default setting."""

    first: np.ndarray
    second: np.ndarray
    steps: int = 0
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    decay: float = 0.01

    def update(self, flat: np.ndarray, gradient: np.ndarray, rate: float) -> np.ndarray:
        self.steps += 1
        self.first = self.beta1 * self.first + (1 - self.beta1) * gradient
        self.second = self.beta2 * self.second + (1 - self.beta2) * gradient**2
        first = self.first / (1 - self.beta1**self.steps)
        second = self.second / (1 - self.beta2**self.steps)
        return flat * (1 - rate * self.decay) - rate * first / (np.sqrt(second) + self.eps)
