"""Column expressions for network math on array columns.

All of these are built-in higher-order functions (``transform``,
``aggregate``, ``zip_with``): they run in the JVM, not in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: probabilities are clipped to [EPS, 1 - EPS] inside losses.
EPS = 1e-7


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid_scalar(x) -> Column:
    return 1.0 / (1.0 + F.exp(-_c(x)))


def relu(arr) -> Column:
    """E5: element-wise max(x, 0)."""
    return F.transform(_c(arr), lambda x: F.greatest(x, F.lit(0.0)))


def sigmoid(arr) -> Column:
    """E5: element-wise logistic function."""
    return F.transform(_c(arr), lambda x: 1.0 / (1.0 + F.exp(-x)))


def array_sum(arr) -> Column:
    return F.aggregate(_c(arr), F.lit(0.0), lambda acc, x: acc + x)


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once, however often ``fn`` refers to it."""
    return F.transform(F.array(value), fn)[0]


def softmax(arr) -> Column:
    """E5: exp(x - max) / sum(exp(x - max)) for numerical safety."""
    def shares(e: Column) -> Column:
        return _let(array_sum(e), lambda s: F.transform(e, lambda x: x / s))

    def exps(a: Column) -> Column:
        return _let(F.array_max(a), lambda m: F.transform(a, lambda x: F.exp(x - m)))

    return _let(_c(arr), lambda a: _let(exps(a), shares))


def clip_prob(p) -> Column:
    return F.least(F.greatest(_c(p), F.lit(EPS)), F.lit(1.0 - EPS))


def bce(y, p) -> Column:
    """Binary cross-entropy of a 0/1 label and a probability."""
    pc = clip_prob(p)
    y = _c(y).cast("double")
    return -(y * F.ln(pc) + (1.0 - y) * F.ln(1.0 - pc))


def cce(y_onehot, p) -> Column:
    """Categorical cross-entropy of a one-hot array and a probability array."""
    terms = F.zip_with(_c(y_onehot), _c(p), lambda y, q: y * F.ln(clip_prob(q)))
    return -array_sum(terms)


def dot(a, b) -> Column:
    return array_sum(F.zip_with(_c(a), _c(b), lambda x, y: x * y))


def dense(x, weights: Sequence[Sequence[float]], bias: Sequence[float]) -> Column:
    """W x + b for a weight matrix given as rows (out x in), as an array literal."""
    w = F.lit([[float(v) for v in row] for row in weights])
    b = F.lit([float(v) for v in bias])
    xc = _c(x)
    return F.transform(w, lambda row, j: dot(row, xc) + F.element_at(b, j + 1))


def dense_forward(x, w1, b1, w2, b2, out: str = "sigmoid") -> Column:
    """``out(W2 . relu(W1 . x + b1) + b2)`` as one expression (small nets only:
    weights are literals in the plan)."""
    h = relu(dense(x, w1, b1))
    z = dense(h, w2, b2)
    if out == "sigmoid":
        return sigmoid(z)
    if out == "softmax":
        return softmax(z)
    if out == "linear":
        return z
    raise ValueError(out)


def length_score(n_chars) -> Column:
    """Fixed score used by the evaluation fixtures: sigmoid(n_chars/1000 - 2)."""
    return sigmoid_scalar(_c(n_chars).cast("double") / 1000.0 - 2.0)
