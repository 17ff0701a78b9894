"""Toxicity: a convolutional text classifier over hashed word embeddings, with thresholds calibrated by language.

Words are runs of letters (A-Z folded; any byte beyond ASCII is a letter).  A word's embedding is the sum of hashed
vectors: of the word, of its beginnings and of its end, so that compounds share what they begin with.  Filters over 1, 2
and 3 words run along the whole text; each filter's largest value over all places, cut at 0, is a feature, and a linear
form of the features is the logit.  Words that no place covers are zeros, so an empty text has a logit too.

Training is numpy on the driver, over at most ``FIT_ROWS`` documents of each label, those of lowest id hash among the
labelled ones of at most ``FIT_WORDS`` words: a documented bound on what reaches the driver (longer texts are scored
whole, and count in the thresholds).  At most ``FIT_SHARE`` of the labelled documents train, so that the thresholds rest on
others too.  Gradients flow to the words under each maximum alone; buckets of few training documents stay zero, and every
pass leaves out some places.  Seeds are fixed.

Scoring reads every whole text once.  As a filter is linear before its maximum, tasks first multiply every bucket by all
filters and then only add looked-up rows, in slices of bounded size.

Thresholds cover all labelled training rows: a histogram of logits by language and label, partial counts first, of at
most ``2 * BINS`` rows a language.  A language's threshold has the least cost of missed and falsely marked shares, from its
own counts plus ``PRIOR`` rows of each label spread as in all languages, so a language with few labels
falls back smoothly.  The language is read off the text itself, by its most frequent function words ("" without any):
no column but the text is an input of a score.  The score is the logistic function of the logit, moved so that the
threshold scores ``CUT``.

Rows without a label, with a null id or with both labels do not train; without rows of both labels every score is 0.5.
Null text counts as empty and is scored.  Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, hash_spans, mix, stored, text_pass

FIT_ROWS, FIT_WORDS, FIT_SHARE = 2_500, 4_000, 0.75
#: Rows that are looked at for the fit, times ``FIT_ROWS``.
_SPARE = 1.3
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
EPOCHS, BATCH, RATE = 10, 32, 0.05
#: Buckets in fewer training documents stay zero; share of places that an epoch leaves out.
MIN_DOCS, DROPOUT = 2, 0.4
CUT = 0.7
BINS, _LIMIT = 2_000, 20.0
PRIOR = 20
#: A clean document taken for a toxic one weighs as much as so many toxic ones that are missed, by shares of each.
COST = 3.0
LOGIT, LANGUAGE = "__logit", "__language"

#: Bytes of a word's beginnings and end that have vectors of their own.
_BEGINS, _END = (5, 7, 9), 5
_BREAK = np.ones(256, bool)
_BREAK[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_FUNCTION_WORDS = {
    "en": "the of and to in is was for that with as on are this be it",
    "de": "der die das und den von zu mit sich ist nicht ein eine auf dem des",
    "fr": "le la les et des est que dans en un une du pour qui pas au",
    "es": "el la los las y que en un una se por con del para no es",
}


def _hash_words(words: str) -> np.ndarray:
    return Words(pa.array([words], pa.large_string()), fold=True, sep=_BREAK).hashes


def _pieces(w: Words, at: np.ndarray) -> np.ndarray:
    """Buckets (words x pieces) of the words at ``at``."""
    starts, lens = w.starts[at], w.lens[at]
    spans = [(starts, lens)] + [(starts, np.minimum(lens, n)) for n in _BEGINS]
    spans.append((starts + np.maximum(lens - _END, 0), np.minimum(lens, _END)))
    out = [mix(hash_spans(w.data, s, n, fold=True) ^ np.uint64(k)) for k, (s, n) in enumerate(spans)]
    return (np.column_stack(out) % np.uint64(BUCKETS)).astype(np.int32)


def _distinct(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts, hashes of the distinct ones, their first places, and the distinct word at each place."""
    w = Words(texts, fold=True, sep=_BREAK)
    hashes, first, back = np.unique(w.hashes, return_index=True, return_inverse=True)
    return w, hashes, first, back.reshape(-1)


def _languages(w: Words, hashes: np.ndarray, back: np.ndarray) -> list[str]:
    """The language whose function words each text has most of; "" without any, ties in alphabetical order."""
    n = len(w.offs) - 1
    counts = np.zeros((n, len(_FUNCTION_WORDS)), np.int64)
    for k, name in enumerate(sorted(_FUNCTION_WORDS)):
        known = np.isin(hashes, _hash_words(_FUNCTION_WORDS[name]))
        counts[:, k] = np.bincount(w.owner[known[back]], minlength=n)
    names = np.array(sorted(_FUNCTION_WORDS))[counts.argmax(axis=1)]
    return np.where(counts.max(axis=1) > 0, names, "").tolist()


# ---------------------------------------------------------------- the network

_PAD = max(WIDTHS)
#: Columns of each (width, place in the filter).
_COLS = {wj: slice(k * FILTERS, (k + 1) * FILTERS) for k, wj in enumerate((w, j) for w in WIDTHS for j in range(w))}
_N_COLS = FILTERS * len(_COLS)


@dataclass
class Net:
    """Embeddings, filters and the linear form over their maxima."""

    buckets: np.ndarray   # BUCKETS x DIM
    filters: np.ndarray   # DIM x _N_COLS
    bias: np.ndarray      # FILTERS a width
    weights: np.ndarray
    offset: float = 0.0

    def logits(self, table: np.ndarray, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.float64(self.offset) + _maxima(table, places, counts, self.bias)[0] @ self.weights.astype(np.float64)


def _new_net(seed: int = 1) -> Net:
    rnd = np.random.default_rng(seed)
    return Net(rnd.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32), rnd.normal(0, 0.3, (DIM, _N_COLS)).astype(np.float32),
               np.zeros(FILTERS * len(WIDTHS), np.float32), rnd.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32))


def _padded(places: np.ndarray, counts: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's words followed by ``_PAD`` pads, and the start of each text."""
    starts = np.cumsum(counts + _PAD) - counts - _PAD
    out = np.full(int(counts.sum()) + _PAD * len(counts), pad, np.int64)
    out[np.arange(len(places)) + np.repeat(np.arange(len(counts)) * _PAD, counts)] = places
    return out, starts


def _maxima(table: np.ndarray, places: np.ndarray, counts: np.ndarray, bias: np.ndarray,
            argmax: bool = False) -> tuple[np.ndarray, list]:
    """Features (texts x filters): the largest value of each filter over a text, 0 at least; and where it lies."""
    pad = len(table) - 1
    tokens, starts = _padded(places, counts, pad)
    ends = starts + counts + 1  # one place more: a window of pads alone
    cuts = np.column_stack([starts, ends]).ravel()
    out, where = [], []
    for k, width in enumerate(WIDTHS):
        n = len(tokens) - width + 1
        z = table[tokens[:n], _COLS[width, 0]]
        for j in range(1, width):
            z += table[tokens[j:n + j], _COLS[width, j]]
        inside = np.minimum(cuts, n - 1)
        best = np.maximum.reduceat(z, inside, axis=0)[::2]
        if argmax:
            owner = np.repeat(np.arange(len(counts)), counts + 1)
            at = np.arange(len(owner)) + np.repeat(starts - np.cumsum(counts + 1) + counts + 1, counts + 1)
            place, f = np.nonzero(z[at] == best[owner])
            doc = owner[place]
            _, first = np.unique(doc * FILTERS + f, return_index=True)
            where.append((doc[first], f[first], at[place[first]]))
        out.append(np.maximum(best + bias[k * FILTERS:(k + 1) * FILTERS], 0))
    return np.concatenate(out, axis=1), [tokens, where]


def _train(pieces: np.ndarray, docs: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> Net:
    """Fits by Adagrad on small batches; ``docs`` hold rows of ``pieces``."""
    net, rnd = _new_net(), np.random.default_rng(2)
    seen = np.zeros(BUCKETS, np.int64)
    for doc in docs:
        seen[np.unique(pieces[np.unique(doc)])] += 1
    known = (seen >= MIN_DOCS).astype(np.float32)[:, None]
    net.buckets *= known
    memory = {k: np.full_like(getattr(net, k), 1e-6) for k in ("buckets", "filters", "bias", "weights")}
    offset_memory = 1e-6

    def step(name: str, grad: np.ndarray, at=slice(None)) -> None:
        memory[name][at] += grad ** 2
        getattr(net, name)[at] -= RATE * grad / np.sqrt(memory[name][at])

    for _ in range(EPOCHS):
        order = rnd.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            batch = order[lo:lo + BATCH]
            kept = [docs[i][rnd.random(len(docs[i])) >= DROPOUT] for i in batch]
            counts = np.array([len(d) for d in kept], np.int64)
            words, places = np.unique(np.concatenate(kept), return_inverse=True)
            own = pieces[words]
            vectors = net.buckets[own].sum(axis=1) if len(words) else np.zeros((0, DIM), np.float32)
            table = np.concatenate([vectors @ net.filters, np.zeros((1, _N_COLS), np.float32)])
            x, (tokens, where) = _maxima(table, places.reshape(-1), counts, net.bias, argmax=True)
            p = 1 / (1 + np.exp(-np.clip(x @ net.weights + net.offset, -30, 30)))
            err = ((p - labels[batch]) * weights[batch] / len(batch)).astype(np.float32)
            dx = err[:, None] * net.weights * (x > 0)
            d_table = np.zeros_like(table)
            for k, (width, (doc, f, at)) in enumerate(zip(WIDTHS, where)):
                g = dx[doc, k * FILTERS + f]
                for j in range(width):
                    np.add.at(d_table, (tokens[at + j], _COLS[width, j].start + f), g)
            d_table = d_table[:-1]
            hit = np.flatnonzero(np.any(d_table != 0, axis=1))
            d_vectors = d_table[hit] @ net.filters.T
            step("filters", vectors[hit].T @ d_table[hit])
            step("weights", x.T @ err)
            step("bias", dx.sum(axis=0))
            rows, back = np.unique(own[hit], return_inverse=True)
            grad = np.zeros((len(rows), DIM), np.float32)
            np.add.at(grad, back.reshape(-1), np.repeat(d_vectors, own.shape[1], axis=0))
            step("buckets", grad * known[rows], rows)
            offset_memory += float(err.sum()) ** 2
            net.offset -= RATE * float(err.sum()) / offset_memory ** 0.5
    return net


# ---------------------------------------------------------------- fit and score

@dataclass(frozen=True)
class Model:
    """A net and the logits that score ``CUT``, by language; without a net every score is 0.5."""

    net: Net | None = None
    cuts: dict[str, float] = field(default_factory=dict)
    other: float = 0.0

    def score(self) -> Column:
        """Score of rows with logit and language."""
        if self.net is None:
            return F.lit(0.5)
        cut = F.lit(self.other)
        for name, at in sorted(self.cuts.items()):
            cut = F.when(F.col(LANGUAGE) == name, F.lit(at)).otherwise(cut)
        z = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.col(LOGIT) - cut))
        return 1 / (1 + F.exp(-z) * ((1 - CUT) / CUT))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that never train: crc32 of the id as text is 1 mod 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, id_col: str = "doc_id", label: str = "toxic") -> DataFrame:
    """(__id, __y): ids with one known label that are not held out."""
    own = labels.select(F.col(id_col).alias("__id"), F.col(label).alias("__y")).where("__id is not null and __y in (0, 1)")
    own = own.groupBy("__id").agg(F.min("__y").alias("__y"), F.max("__y").alias("__z")).where("__y = __z").drop("__z")
    return own.where(~held_out("__id"))


def _sample(docs: DataFrame, own: DataFrame, id_col: str, text: str) -> Iterator[tuple[int, np.ndarray]]:
    """(label, pieces of each word) of the documents that train."""
    ids = docs.select(F.col(id_col).alias("__id")).join(own, "__id").distinct()
    ids = stored(ids, "labelled")
    count = {r["__y"]: r["n"] for r in ids.groupBy("__y").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(count) < 2:
        return
    place = F.shiftrightunsigned(F.xxhash64("__id"), 33)  # evenly over 31 bits
    for y in (0, 1):
        upto = min(FIT_SHARE, _SPARE * FIT_ROWS / count[y]) * (1 << 31)
        pick = ids.where((F.col("__y") == y) & (place < upto)).orderBy(place, "__id").limit(FIT_ROWS)
        # At most FIT_ROWS ids: a broadcast with a proven bound.
        rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(pick), "__id")
        rows = rows.select("__id", "__y", "__text")

        def run(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch | None:
            w = Words(texts, fold=True, sep=_BREAK)
            fits = np.flatnonzero(w.counts <= FIT_WORDS)
            if not len(fits):
                return None
            at = np.concatenate([np.arange(w.first[i], w.first[i + 1]) for i in fits])
            flat = _pieces(w, at).ravel()
            offs = np.concatenate([[0], np.cumsum(w.counts[fits])]) * (len(_BEGINS) + 2)
            own = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat))
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(fits)), batch.column(1).take(pa.array(fits)), own],
                                              ["__id", "__y", "__pieces"])

        kinds = dict(rows.dtypes)
        got = text_pass(rows, run, f"__id {kinds['__id']}, __y {kinds['__y']}, __pieces array<int>", "__text")
        seen = set()
        for r in sorted(got.toArrow().to_pylist(), key=lambda r: (r["__id"], r["__pieces"])):
            if r["__id"] not in seen:  # of repeated ids one row trains
                seen.add(r["__id"])
                yield int(r["__y"]), np.array(r["__pieces"], np.int32).reshape(-1, len(_BEGINS) + 2)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Net | None:
    """The net of the labelled rows of ``docs``; None without both labels."""
    rows = list(_sample(docs, training_labels(labels, id_col, label), id_col, text))
    y = np.array([r[0] for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    words, back = np.unique(np.concatenate([p for _, p in rows]), axis=0, return_inverse=True)
    cuts = np.cumsum([len(p) for _, p in rows])[:-1]
    share = np.bincount(y, minlength=2) / len(y)
    return _train(words, np.split(back.reshape(-1), cuts), y, (0.5 / share[y]).astype(np.float32))


def with_logits(df: DataFrame, net: Net | None, text: str = "text") -> DataFrame:
    """``df`` without its texts, with the logit and the language of each."""
    keep = [c for c in df.columns if c != text]
    if net is None:
        return df.select(*keep, F.lit(0.0).alias(LOGIT), F.lit("").alias(LANGUAGE))
    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c != text)
    tables = []

    def run(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        if not tables:
            tables.append(net.buckets @ net.filters)
        w, hashes, first, back = _distinct(texts)
        pieces, table = _pieces(w, first), np.zeros((len(first) + 1, _N_COLS), np.float32)
        for k in range(pieces.shape[1] if len(first) else 0):
            table[:-1] += tables[0][pieces[:, k]]
        z = net.logits(table, back, w.counts)
        return pa.RecordBatch.from_arrays(
            [*(rows.column(rows.schema.get_field_index(c)) for c in keep), pa.array(z), pa.array(_languages(w, hashes, back), pa.string())],
            [*keep, LOGIT, LANGUAGE])

    return text_pass(df, run, f"{kinds}, {LOGIT} double, {LANGUAGE} string", text)


def calibrate(logits: DataFrame, labels: DataFrame, net: Net | None, id_col: str = "doc_id", label: str = "toxic") -> Model:
    """Thresholds of all labelled training rows of ``logits`` (id, logit, language)."""
    if net is None:
        return Model()
    own = training_labels(labels, id_col, label)
    z = F.greatest(F.lit(-_LIMIT), F.least(F.lit(_LIMIT), F.col(LOGIT)))
    bin_ = F.least(F.floor((z + _LIMIT) * (BINS / (2 * _LIMIT))), F.lit(BINS - 1)).cast("int").alias("bin")
    rows = logits.select(F.col(id_col).alias("__id"), LANGUAGE, bin_).join(own, "__id")
    table = rows.groupBy(LANGUAGE, "__y", "bin").agg(F.count("*").alias("n")).collect()  # at most 2 * BINS a language
    counts: dict[str, np.ndarray] = {}
    for r in table:
        counts.setdefault(r[LANGUAGE], np.zeros((2, BINS)))[r["__y"], r["bin"]] += r["n"]
    total = sum(counts.values(), np.zeros((2, BINS)))
    if not total.sum(axis=1).all():
        return Model(net, {}, 0.0)
    prior = PRIOR * total / total.sum(axis=1, keepdims=True)
    return Model(net, {k: _threshold(c + prior) for k, c in counts.items()}, _threshold(prior))


def _threshold(counts: np.ndarray) -> float:
    """Middle of the cuts with the least cost: shares of label 1 below them, and ``COST`` times those of label 0 above."""
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(counts, axis=1)], axis=1) / counts.sum(axis=1, keepdims=True)
    gain = COST * below[0] - below[1]
    best = np.flatnonzero(gain >= gain.max() - 1e-9)
    return float((best[0] + best[-1]) / 2 * (2 * _LIMIT / BINS) - _LIMIT)


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(id, held_out, score, predicted, language): every row of ``docs``, after a fit on those labelled and not held out."""
    net = fit(docs, labels, id_col, text, label)
    rows = stored(with_logits(docs.select(id_col, text), net, text), "logits")
    model = calibrate(rows, labels, net, id_col, label)
    out = rows.select(id_col, held_out(id_col).alias("held_out"), model.score().alias("score"), F.col(LANGUAGE).alias("language"))
    return out.select(id_col, "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "language")
