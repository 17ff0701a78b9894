"""Network spec and numpy math for one ReLU trunk with task heads.

This is the per-Arrow-batch arithmetic run inside Spark tasks (training and
scoring); Spark partitions, shuffles and schedules the work around it.

Shape: ``x -> relu(W1 x + b1) -> head_k(W_k h + b_k)`` with sigmoid heads for
binary tasks and softmax heads for multiclass tasks; loss = unweighted sum of
per-task mean cross-entropies (probabilities clipped to [1e-7, 1-1e-7]).
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np

# Fixed values of the reference training setup.
LEARNING_RATE = 0.005
BATCH_SIZE = 32
EPOCHS = 20
SEED = 1234
ADAM_BETA1, ADAM_BETA2, ADAM_EPS = 0.9, 0.999, 1e-8
CLIP = 1e-7


@dataclass
class Head:
    task: str
    n: int                 # 1 for a binary task, number of classes otherwise
    label: str             # label column (0/1, or class index)

    @property
    def activation(self) -> str:
        return "sigmoid" if self.n == 1 else "softmax"


@dataclass
class NetSpec:
    n_in: int
    hidden: int
    heads: list[Head]
    lr: float = LEARNING_RATE
    batch: int = BATCH_SIZE
    epochs: int = EPOCHS
    seed: int = SEED
    mean: list[float] | None = None     # input standardization, fitted on the train split
    scale: list[float] | None = None
    extra: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> NetSpec:
        d = json.loads(s)
        d["heads"] = [Head(**h) for h in d["heads"]]
        return NetSpec(**d)

    def shapes(self) -> list[tuple[str, tuple[int, ...]]]:
        out = [("W1", (self.n_in, self.hidden)), ("b1", (self.hidden,))]
        for h in self.heads:
            out += [(f"W_{h.task}", (self.hidden, h.n)), (f"b_{h.task}", (h.n,))]
        return out

    def n_params(self) -> int:
        return int(sum(np.prod(s) for _, s in self.shapes()))


def unpack(spec: NetSpec, theta: np.ndarray) -> dict[str, np.ndarray]:
    out, i = {}, 0
    for name, shape in spec.shapes():
        k = int(np.prod(shape))
        out[name] = theta[i:i + k].reshape(shape)
        i += k
    return out


def init_params(spec: NetSpec) -> np.ndarray:
    """He-normal trunk (ReLU), Xavier-normal heads, zero biases; seeded."""
    rng = np.random.default_rng(spec.seed)
    parts = []
    for name, shape in spec.shapes():
        if name == "W1":
            parts.append(rng.normal(0.0, np.sqrt(2.0 / shape[0]), size=shape).ravel())
        elif name.startswith("W_"):
            parts.append(rng.normal(0.0, np.sqrt(2.0 / (shape[0] + shape[1])), size=shape).ravel())
        else:
            parts.append(np.zeros(int(np.prod(shape))))
    return np.concatenate(parts)


def _standardize(spec: NetSpec, X: np.ndarray) -> np.ndarray:
    if spec.mean is None:
        return X
    return (X - np.asarray(spec.mean)) / np.asarray(spec.scale)


#: Rows that a forward pass takes at a time: their hidden layer stays near the core.
FORWARD_ROWS = 256


def forward(spec: NetSpec, theta: np.ndarray, X: np.ndarray) -> dict[str, np.ndarray]:
    """Probabilities per task: (n,) for binary heads, (n, C) for softmax heads."""
    net, n = _Net([spec]), len(X)
    flat = net.inward([theta])
    W1, W, b = net.parts(flat)
    P, H = np.empty((net.outputs, n)), np.empty((min(n, FORWARD_ROWS), spec.hidden))
    Xa = _with_bias(_standardize(spec, X))
    for s in range(0, n, FORWARD_ROWS):
        x = Xa[s:s + FORWARD_ROWS]
        h = H[:len(x)]
        np.matmul(x, W1, h)
        np.maximum(h, _ZERO, h)
        np.matmul(W, h.T, P[:, s:s + FORWARD_ROWS])
    net.activate(P[None], b)
    return {h.task: P[at.start] if h.n == 1 else P[at].T for h, at in zip(spec.heads, net.at)}


def _with_bias(X: np.ndarray) -> np.ndarray:
    """The rows with a last column of ones, so that a product with ``[W1; b1]`` holds the bias."""
    out = np.empty((len(X), X.shape[1] + 1))
    out[:, :-1] = X
    out[:, -1] = 1.0
    return out


class _Net:
    """Networks of the same inputs and heads, side by side: one product of a batch serves the trunks of all.

    Their weights (or moments, or gradients) are one flat array: a matrix of
    rows [W1; b1; heads' weights], whose columns are the hidden units of the
    first network, then those of the second, and then the heads' biases,
    (networks, outputs).
    """

    def __init__(self, specs: Sequence[NetSpec]):
        heads = specs[0].heads
        self.specs, self.heads, self.n_in = list(specs), heads, specs[0].n_in
        self.outputs = sum(h.n for h in heads)
        ends = np.cumsum([h.n for h in heads])
        self.at = [slice(int(e) - h.n, int(e)) for h, e in zip(heads, ends)]  # outputs of each head
        ends = np.cumsum([s.hidden for s in specs])
        self.of = [slice(int(e) - s.hidden, int(e)) for s, e in zip(specs, ends)]  # units of each network
        self.width = int(ends[-1])
        self.matrix = (self.n_in + 1 + self.outputs) * self.width
        self.size = self.matrix + len(specs) * self.outputs
        place = np.arange(self.size)
        W1, W, b = self.parts(place)
        self.place = []  # where each network's weights are, in the order of its ``shapes``
        for i, units in enumerate(self.of):
            each = [W1[:, units].ravel()]
            for at in self.at:
                each += [W[at, units].T.ravel(), b[i, at]]
            self.place.append(np.concatenate(each))

    def inward(self, thetas: Sequence[np.ndarray]) -> np.ndarray:
        flat = np.empty(self.size)
        for at, theta in zip(self.place, thetas):
            flat[at] = theta
        return flat

    def outward(self, flat: np.ndarray) -> list[np.ndarray]:
        return [flat[at] for at in self.place]

    def parts(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Views: trunks with biases (inputs + 1, units), heads (outputs, units), heads' biases (networks, outputs)."""
        A = flat[:self.matrix].reshape(-1, self.width)
        return A[:self.n_in + 1], A[self.n_in + 1:], flat[self.matrix:].reshape(-1, self.outputs)

    def activate(self, P: np.ndarray, b: np.ndarray) -> None:
        """What the heads' weights give, (networks, outputs, rows), becomes probabilities."""
        P += b[:, :, None]
        for h, at in zip(self.heads, self.at):
            p = P[:, at]
            if h.n == 1:
                np.negative(p, p)
                np.exp(p, p)
                np.add(p, _ONE, p)
                np.divide(_ONE, p, p)
            else:
                np.subtract(p, np.maximum.reduce(p, axis=1, keepdims=True), p)
                np.exp(p, p)
                np.divide(p, np.add.reduce(p, axis=1, keepdims=True), p)


_ZERO, _ONE = np.zeros(()), np.ones(())


@dataclass
class _Labels:
    """Labels of batches of one size: ``T`` (batches, outputs, rows) is 1 for a binary label of 1 and for a row's class."""

    T: np.ndarray
    ok: np.ndarray | None       # (batches, heads, rows): the label is there; None if all are

    @staticmethod
    def of(net: _Net, Y: dict[str, np.ndarray], batches: int) -> _Labels:
        ys = [np.asarray(Y[h.task], dtype=np.float64).reshape(batches, -1) for h in net.heads]
        ok = ~np.isnan(np.stack(ys, axis=1))
        T = np.empty((batches, net.outputs, ok.shape[2]))
        for i, (h, at) in enumerate(zip(net.heads, net.at)):
            if h.n == 1:
                T[:, at.start] = np.where(ok[:, i], ys[i], 0.0)
            else:
                for c in range(h.n):
                    T[:, at.start + c] = ys[i] == c
        return _Labels(T, None if ok.all() else ok)


def _batch_losses(net: _Net, P: np.ndarray, T: np.ndarray, ok: np.ndarray | None) -> np.ndarray:
    """(batches, networks): the sum over heads of the mean clipped cross-entropy of the rows with a label.

    ``P`` are the probabilities, (batches, networks, outputs, rows).
    """
    total = np.zeros(P.shape[:2])
    for i, (h, at) in enumerate(zip(net.heads, net.at)):
        p, t = P[:, :, at], T[:, None, at]
        if h.n == 1:
            pc = np.minimum(np.maximum(p, CLIP), 1 - CLIP)[:, :, 0]
            loss = -(t[:, :, 0] * np.log(pc) + (1 - t[:, :, 0]) * np.log(1 - pc))
        else:
            loss = -np.log(np.minimum(np.maximum((p * t).sum(axis=2), CLIP), 1 - CLIP))
        if ok is None:
            total += loss.mean(axis=2)
        else:
            there = ok[:, None, i]
            total += np.where(there, loss, 0.0).sum(axis=2) / np.maximum(there.sum(axis=2), 1)
    return total


def loss_and_grad(spec: NetSpec, theta: np.ndarray, X: np.ndarray,
                  Y: dict[str, np.ndarray]) -> tuple[float, np.ndarray]:
    """Sum over tasks of the mean clipped cross-entropy, and its gradient.

    Labels are float arrays; NaN marks a missing label (row left out of that
    task's mean).
    """
    net = _Net([spec])
    y, g, P = _Labels.of(net, Y, 1), np.empty(net.size), np.empty((1, 1, net.outputs, len(X)))
    _gradient(net, net.parts(net.inward([theta])), net.parts(g), _with_bias(_standardize(spec, X)), y.T[0],
              None if y.ok is None else y.ok[0], P[0], _room(net, len(X)))
    return float(_batch_losses(net, P, y.T, y.ok)[0, 0]), net.outward(g)[0]


def _room(net: _Net, n: int) -> tuple[np.ndarray, ...]:
    """What the gradient of ``n`` rows writes over: hidden layer, its gradient, its active units, gradient of the outputs."""
    return (np.empty((n, net.width)), np.empty((n, net.width)), np.empty((n, net.width), bool),
            np.empty((len(net.specs), net.outputs, n)))


def _gradient(net: _Net, weights, grads, Xa: np.ndarray, T: np.ndarray, ok: np.ndarray | None, P: np.ndarray, room) -> None:
    """The gradients of one batch of standardized rows into the views ``grads``, its probabilities into ``P``."""
    W1, W, b = weights
    gW1, gW, gb = grads
    H, dH, active, dz = room
    np.matmul(Xa, W1, H)
    np.maximum(H, _ZERO, H)
    for i, units in enumerate(net.of):
        np.matmul(W[:, units], H[:, units].T, P[i])
    net.activate(P, b)
    np.subtract(P, T, dz)
    if ok is None:
        np.divide(dz, len(Xa), dz)
    else:
        for i, at in enumerate(net.at):
            dz[:, at, ~ok[i]] = 0.0
            dz[:, at] /= max(int(np.count_nonzero(ok[i])), 1)
    np.add.reduce(dz, axis=2, out=gb)
    outer = np.multiply if net.outputs == 1 else np.matmul
    for i, units in enumerate(net.of):
        np.matmul(dz[i], H[:, units], gW[:, units])
        outer(dz[i].T, W[:, units], dH[:, units])
    np.greater(H, _ZERO, active)
    np.multiply(dH, active, dH)
    np.matmul(Xa.T, dH, gW1)


_B1, _B2 = np.array(ADAM_BETA1), np.array(ADAM_BETA2)


def adam_step(spec: NetSpec, theta, m, v, t: int, g, scratch=None):
    """One Adam update (Kingma & Ba 2015), in place on ``theta``, ``m``, ``v``; ``t`` is the 1-based step.

    ``m`` and ``v`` are the decayed sums of the gradients and of their squares:
    the moments over 1 - b1 and 1 - b2.  These factors and the bias corrections
    are folded into the step size and epsilon, the same update without passes
    over all weights for them.
    """
    s = np.empty_like(g) if scratch is None else scratch
    _adam_direction(m, v, t, g, s)
    np.multiply(s, _adam_rate(spec.lr, t), s)
    np.subtract(theta, s, theta)
    return theta, m, v


def _adam_direction(m, v, t: int, g, s) -> None:
    np.multiply(m, _B1, m)
    np.add(m, g, m)
    np.multiply(v, _B2, v)
    np.multiply(g, g, s)
    np.add(v, s, v)
    np.sqrt(v, s)
    np.add(s, ADAM_EPS * math.sqrt((1 - ADAM_BETA2 ** t) / (1 - ADAM_BETA2)), s)
    np.divide(m, s, s)


def _adam_rate(lr: float, t: int) -> float:
    return lr * (1 - ADAM_BETA1) / (1 - ADAM_BETA1 ** t) * math.sqrt((1 - ADAM_BETA2 ** t) / (1 - ADAM_BETA2))


def train_pass(spec: NetSpec, theta, m, v, t: int, batches, batch_size: int | None = None, on_step=None, every: int = 1):
    """Mini-batch Adam over an iterator of (X, Y) chunks in record order.

    ``on_step(step, rows, loss, last)`` is told of each ``every``-th step, and of the last one again.
    Returns (theta, m, v, t, rows, steps, loss_sum).
    """
    told = None if on_step is None else lambda step, rows, losses, last: on_step(step, rows, losses[0], last)
    states, t, rows, steps, loss_sums = train_passes([spec], [(theta, m, v)], t, batches, batch_size, told, every)
    return *states[0], t, rows, steps, loss_sums[0]


def train_passes(specs: Sequence[NetSpec], states, t: int, batches, batch_size: int | None = None, on_step=None,
                 every: int = 1):
    """``train_pass`` of several networks over the same rows: (theta, m, v) of each, then t, rows, steps, loss_sums.

    They share inputs, standardization, heads, batch size and ``t``; sizes of
    trunks and rates are their own, and so are their results.  Chunks are re-cut
    into batches; the remainder of a chunk is carried into the next one, and the
    short final batch is used too.  ``on_step`` is told the loss of each.
    """
    B = batch_size or specs[0].batch
    # one set of arrays for all steps, updated in place: weights, moments, gradient, and room for the layers
    net = _Net(specs)
    theta, m, v = (net.inward(x) for x in zip(*states))
    m /= 1 - ADAM_BETA1
    v /= 1 - ADAM_BETA2
    g, s, room = np.empty(net.size), np.empty(net.size), _room(net, B)
    weights, grads = net.parts(theta), net.parts(g)
    sA, sb = s[:net.matrix].reshape(-1, net.width), s[net.matrix:].reshape(-1, net.outputs)
    units = [x.hidden for x in specs]
    carry = None
    rows = steps = 0
    loss_sums = losses = np.zeros(len(specs))

    def run(Xa, Y, size):
        nonlocal t, rows, steps, loss_sums, losses
        n = len(Xa) // size
        y, P = _Labels.of(net, Y, n), np.empty((n, len(specs), net.outputs, size))
        T, ok = y.T, y.ok
        own = room if size == B else _room(net, size)
        for i in range(n):
            _gradient(net, weights, grads, Xa[i * size:(i + 1) * size], T[i], None if ok is None else ok[i], P[i], own)
            t += 1
            if len(specs) == 1:
                adam_step(specs[0], theta, m, v, t, g, s)
            else:
                _adam_direction(m, v, t, g, s)
                rates = np.array([_adam_rate(x.lr, t) for x in specs])
                np.multiply(sA, np.repeat(rates, units), sA)
                np.multiply(sb, rates[:, None], sb)
                np.subtract(theta, s, theta)
            rows += size
            steps += 1
            if on_step is not None and steps % every == 0:
                own_ok = None if ok is None else ok[i:i + 1]
                on_step(steps, rows, _batch_losses(net, P[i:i + 1], T[i:i + 1], own_ok)[0].tolist(), False)
        all_losses = _batch_losses(net, P, T, ok)
        loss_sums = loss_sums + all_losses.sum(axis=0) * size
        losses = all_losses[-1]

    for X, Y in batches:
        Xa = _with_bias(_standardize(specs[0], X))  # a row at a time, so of a whole chunk as of a batch
        if carry is not None and len(carry[0]):
            Xa = np.concatenate([carry[0], Xa])
            Y = {k: np.concatenate([carry[1][k], Y[k]]) for k in Y}
        k = (len(Xa) // B) * B
        if k:
            run(Xa[:k], {kk: vv[:k] for kk, vv in Y.items()}, B)
        carry = Xa[k:], {kk: vv[k:] for kk, vv in Y.items()}
    if carry is not None and len(carry[0]):
        run(*carry, len(carry[0]))
    if on_step is not None:
        on_step(steps, rows, losses.tolist(), True)
    m *= 1 - ADAM_BETA1
    v *= 1 - ADAM_BETA2
    return [*zip(*(net.outward(x) for x in (theta, m, v)))], t, rows, steps, loss_sums.tolist()
