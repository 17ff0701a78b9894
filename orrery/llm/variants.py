"""Spelling variants: words one edit apart, found in a reduced alphabet and verified on the original strings.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased.  Where 31 divides the crc32 of
``<id>:<run>``, the run loses the code point at crc32 mod its length (from 0).  Results of at least ``min_length`` code
points and ``min_count`` occurrences make up the vocabulary, counted by partial aggregates over all texts.

Search by *reduced-alphabet generation*: a hash maps every letter to one of ``symbols`` symbols.  Two words one edit
apart have reduced forms that are equal or one edit apart, so the full one-edit neighbourhood of every distinct reduced
form (itself, all deletions, replacements and insertions over the symbols) is generated and joined with the reduced
vocabulary; words behind matched forms are compared as written, and only those at distance 1 stay.  Forms are 64-bit
polynomial hashes, from which each neighbour follows in constant time: a collision can only add a candidate, never lose
one.  A neighbourhood has about ``2 * symbols * length`` forms, so work grows with the vocabulary, not with the
occurrences, and memory of a task is bounded by ``_CELLS`` for words of any length.

All joins are equi-joins on forms, none is broadcast by hand, and a form shared by many words is a skewed key that
adaptive execution splits.  Each table that is read twice is written to the shared folder.

Nulls: a null text has no words; runs of a null id are kept whole.  Repeated rows count again.  An empty table, or one
without such words, gives no rows.  Ties of ``form`` go to the smallest word in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, mix, stored

MIN_LENGTH, MIN_COUNT = 7, 2
#: A word's form has at least so many times its occurrences.
RATIO = 10
#: One in so many runs of a document loses a letter.
THINNING = 31
SYMBOLS = 8
#: Neighbour forms that a task holds at once.
_CELLS = 1 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_U = np.uint64
_BASE = _U(0xD6E8FEB86659FD93)
_BACK = _U(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """(word): one row for each occurrence with at least ``min_length`` code points."""
    # A thinned run is one letter shorter, so runs shorter than the least length never count.
    pattern = f"[A-Za-zÀ-ÿ]{{{min_length},}}"
    runs = docs.select(F.col(id_col).cast("string").alias("__id"),
                       F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("__run"))
    runs = runs.select("__id", F.translate("__run", _UPPER, _LOWER).alias("__run"))
    h = F.crc32(F.concat("__id", F.lit(":"), "__run").cast("binary"))
    runs = runs.select("__run", h.alias("__h"))
    at = (F.col("__h") % F.length("__run")).cast("int")
    thin = F.concat(F.substring("__run", F.lit(1), at), F.substring("__run", at + 2, F.length("__run")))
    out = runs.select(F.when(F.col("__h") % THINNING == 0, thin).otherwise(F.col("__run")).alias("word"))
    return out.where(F.length("word") >= min_length)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): distinct words and their occurrences."""
    n = words(docs, id_col, text, min_length).groupBy("word").agg(F.count("*").alias("n"))
    return n.where(F.col("n") >= min_count)


# ---------------------------------------------------------------- reduced forms

def _symbols(word: str, symbols: int) -> np.ndarray:
    """Hash of each code point to a symbol, from 1."""
    points = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    return (mix(points + _U(0x9E3779B97F4A7C15)) % _U(symbols)).astype(np.uint64) + _U(1)


def _powers(n: int) -> np.ndarray:
    p = np.full(n + 1, _BASE, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def _form(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of symbols; the length is a part of it, as symbols are never 0."""
    return (codes * _powers(codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def _neighbours(codes: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, form) of each distinct reduced form at most one edit from a row of ``codes`` (rows x length)."""
    rows, length = codes.shape
    power = _powers(length)
    terms = codes * power[:-1]
    before = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(terms, axis=1, out=before[:, 1:])
    whole = before[:, -1:]
    after = whole - before  # symbols from a place on, at their own powers
    index = np.broadcast_to(np.arange(rows)[:, None], (rows, length + 1))
    yield index[:, 0], whole[:, 0]
    # deletion: of equal symbols in a row only the first
    first = np.ones((rows, length), bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    yield index[:, :-1][first], (before[:, :-1] + after[:, 1:] * _BACK)[first]
    for s in range(1, symbols + 1):
        s = _U(s)
        other = codes != s
        yield index[:, :-1][other], (whole + (s - codes) * power[:-1])[other]
        # insertion: before a place whose left neighbour is another symbol
        new = np.ones((rows, length + 1), bool)
        new[:, 1:] = other
        yield index[new], (before + s * power + after * _BASE)[new]


def _by_length(batches: Iterable[pa.RecordBatch], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in the batch, symbols) of words of equal length, a bounded number of cells at once."""
    for batch in batches:
        texts = [w.as_py() for w in batch.column(0)]
        lens = np.array([len(w) for w in texts], np.int64)
        for length in np.unique(lens):
            at = np.flatnonzero(lens == length)
            step = max(1, _CELLS // (int(length) + 1))
            for lo in range(0, len(at), step):
                part = at[lo:lo + step]
                codes = _symbols("".join(texts[i] for i in part), symbols).reshape(len(part), -1)
                yield batch, part, codes


def _forms(vocab: DataFrame, symbols: int) -> DataFrame:
    """(word, form): the reduced form of each word."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part, codes in _by_length(batches, symbols):
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(part)), pa.array(_form(codes).view(np.int64))],
                                             ["word", "form"])
    return vocab.select("word").mapInArrow(run, "word string, form long")


def _near_forms(reduced: DataFrame, symbols: int) -> DataFrame:
    """(form, near): the full one-edit neighbourhood of each distinct form, of which ``word`` is an example."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, codes in _by_length(batches, symbols):
            own = _form(codes).view(np.int64)
            for row, near in _neighbours(codes, symbols):
                for lo in range(0, len(row), _CELLS):
                    yield pa.RecordBatch.from_arrays([pa.array(own[row[lo:lo + _CELLS]]),
                                                      pa.array(near[lo:lo + _CELLS].view(np.int64))], ["form", "near"])
    return reduced.select("word").mapInArrow(run, "form long, near long")


def near_words(vocab: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, near): all ordered pairs of words of ``vocab`` (word) that are exactly one edit apart."""
    words_ = stored(_forms(vocab, symbols), "forms")
    reduced = words_.groupBy("form").agg(F.min("word").alias("word"))
    made = _near_forms(reduced, symbols)
    known = words_.select(F.col("form").alias("near")).distinct()
    met = stored(made.join(known, "near"), "near-forms")  # pairs of reduced forms that are both in the vocabulary
    other = words_.select(F.col("word").alias("__other"), F.col("form").alias("near"))
    pairs = met.join(words_, "form").join(other, "near").where("word <> __other")
    pairs = pairs.where(F.abs(F.length("word") - F.length("__other")) <= 1)
    return pairs.where(F.levenshtein("word", "__other", 1) == 1).select("word", F.col("__other").alias("near"))


def _roots(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(word, root): where the chain of ``forms`` (word, form) ends.

    Each round doubles the steps taken.  Occurrences grow tenfold with every step, so chains have no cycle and at most
    19 steps.
    """
    jump = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        to = jump.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        step = stored(jump.join(to, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("__moved")), "roots")
        forget(jump)
        jump = step.drop("__moved")
        jump.stored_path = step.stored_path
        if step.where("__moved").isEmpty():
            return jump
    raise RuntimeError("chains of forms did not end")


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word with its most frequent near word, if frequent enough."""
    vocab = stored(vocabulary(docs, id_col, text, min_length, min_count), "vocabulary")
    pairs = near_words(vocab, symbols)
    pairs = pairs.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("__n")), "near")
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col("near").alias("word")))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("__best"))
    each = vocab.join(near, "word", "left")
    fits = -F.col("__best.n") >= ratio * F.col("n")
    each = stored(each.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                              F.when(fits, F.col("__best.word")).alias("form"),
                              F.when(fits, -F.col("__best.n")).alias("form_n")), "words")
    roots = _roots(each.where("form is not null"))
    out = each.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
