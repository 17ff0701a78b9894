"""Quality classifier: Bradley-Terry ranking from preference pairs.

A document's strength is a linear form of its features.  Training pairs a
document labelled 1 with one labelled 0 and minimizes the logistic loss of the
difference of their features, by Newton steps.  The cut is the quantile of the
strengths of the training rows at the share of label 0 (half-way to the next
strength), and the score is the logistic function of the strength's distance
from the cut, moved so that the cut scores ``CUT``.

The fit of the weights uses at most ``FIT_ROWS`` rows of each label, those of
lowest id hash: a documented bound on what reaches the driver.  Features, label
counts, the cut and scores cover every row; the cut is found by exact rank in a
prefix sum over the distinct strengths.

Rows without a label, with a null id or with both labels do not train.
Without rows of both labels every score is 0.5.  Null text counts as empty and
is scored.  Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scan import prefix_sums
from .common import text_pass
from .textstats import TextStats

FIT_ROWS = 20_000
#: Rows that are looked at for the fit, times ``FIT_ROWS``.
_SPARE = 1.3
#: Pairs for each row of the larger label.
PAIRS = 4
RIDGE = 1e-3
CUT = 0.3
#: Column of the features.
FEATURES = "__features"


def _matrix(s: TextStats) -> np.ndarray:
    words, chars, lines = (np.maximum(x, 1) for x in (s.n_words, s.word_chars, s.n_lines))
    shares = [s.n_symbols / chars, s.n_bangs / words, s.n_upper / chars, s.n_repeat_words / words, s.n_bars / words,
              s.n_dup_lines / lines, s.n_digits / chars]
    soft = [np.minimum(1.0, 5 * x) for x in shares[:5]]  # a fifth is as telling as more
    rest = [s.n_stops / words, s.n_wide / chars, s.word_chars / words / 10, s.n_distinct / words,
            np.minimum(np.log1p(s.n_words), 8) / 8, np.minimum(lines / words, 1)]
    return np.column_stack(shares + soft + rest).astype(np.float64)


def with_features(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the features of its whole texts as ``__features``."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)

    def run(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        x = _matrix(TextStats(texts))
        offs = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
        return pa.RecordBatch.from_arrays([*rows.columns, pa.ListArray.from_arrays(offs, pa.array(x.ravel()))],
                                          [*rows.schema.names, FEATURES])

    return text_pass(df, run, f"{kinds}, {FEATURES} array<double>", text)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that never train: crc32 of the id as text is a multiple of 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Weights of the features and the strength that scores ``CUT``; without weights every score is 0.5."""

    weights: tuple[float, ...]
    cut: float

    def strength(self, features: str = FEATURES) -> Column:
        strength = F.lit(0.0)
        for i, w in enumerate(self.weights):
            strength = strength + F.lit(w) * F.col(features)[i]
        return strength

    def score(self, features: str = FEATURES) -> Column:
        if not self.weights:
            return F.lit(0.5)
        strength = self.strength(features) - F.lit(self.cut)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), strength))) * ((1 - CUT) / CUT))


def fit(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> Model:
    """Fits rows of ``features`` (id, ``__features``) whose id is labelled and not held out."""
    own = labels.select(F.col(id_col).alias("__id"), F.col(label).alias("__y")).where("__id is not null and __y in (0, 1)")
    own = own.groupBy("__id").agg(F.min("__y").alias("__y"), F.max("__y").alias("__z")).where("__y = __z").drop("__z")
    own = own.where(~held_out("__id"))
    rows = features.join(own, F.col(id_col) == F.col("__id")).select("__id", "__y", FEATURES)
    count = {r["__y"]: r["n"] for r in rows.groupBy("__y").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(count) < 2:
        return Model((), 0.0)
    side = {}
    for y in (0, 1):
        place = F.shiftrightunsigned(F.xxhash64("__id"), 33)  # evenly over 31 bits
        upto = min(1.0, _SPARE * FIT_ROWS / count[y]) * (1 << 31)  # so each task sends its share, not FIT_ROWS of them
        pick = rows.where((F.col("__y") == y) & (place < upto)).orderBy(place, "__id").limit(FIT_ROWS)
        side[y] = np.array([r[0] for r in pick.select(FEATURES).collect()])
    model = _solve(side[1], side[0], count[1], count[0])
    return Model(model.weights, _cut(rows, model, count[0]))


def _cut(rows: DataFrame, model: Model, n_bad: int) -> float:
    """Half-way between the ``n_bad``-th strength of all rows and the next."""
    each = rows.groupBy(model.strength().alias("__strength")).agg(F.count("*").alias("__n"))
    upto = prefix_sums(each.withColumn("__all", F.lit(1)), ["__all"], ["__strength"], ["__n"])
    near = upto.where((F.col("__n_before") <= n_bad) & (F.col("__n_before") + F.col("__n") >= n_bad))  # one row or two
    lo, hi = near.agg(F.min("__strength"), F.max("__strength")).first()
    return float((lo + hi) / 2)


def _solve(good: np.ndarray, bad: np.ndarray, n_good: int, n_bad: int) -> Model:
    both = np.concatenate([good, bad])
    scale = both.std(axis=0)
    scale[scale < 1e-9] = 1.0
    k = np.arange(PAIRS * max(len(good), len(bad)))
    turn = k // max(len(good), len(bad))  # another partner each time round
    diff = (good[(k + turn * 7919) % len(good)] - bad[(k + turn * 104729) % len(bad)]) / scale
    w = np.zeros(diff.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -40, 40)))  # chance of the wrong order
        grad = diff.T @ p / len(diff) - RIDGE * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    w = w / scale
    strength = both @ w
    mass = np.concatenate([np.full(len(good), n_good / len(good)), np.full(len(bad), n_bad / len(bad))])
    order = np.argsort(strength, kind="stable")
    upto = np.cumsum(mass[order])
    i = int(np.searchsorted(upto, n_bad * (1 - 1e-9)))
    j = min(i + 1, len(order) - 1)
    return Model(tuple(float(x) for x in w), float((strength[order[i]] + strength[order[j]]) / 2))
