"""Quality rules with thresholds learned per language and source.

Each document is measured once.  Six ratios are put into logarithmic bins, a
quantile sketch with a relative error of 1 % whose merge is the sum of the
counts: the sketch of a language is the merge of those of its sources, that of
the table the merge of all.  Counts are partial sums before the shuffle, and a
sketch has a few hundred bins, however many rows its source holds.

The upper fence of a ratio is its third quartile plus ``REACH`` times the
interquartile range, at least ``SLACK`` of that ratio above the quartile (a
range of nothing is no reason to drop a document); mean word length also has a
lower one.  On the given tables ``SLACK`` is the larger of the two for every
group and ratio, so constants decide there (figures in the README).  To the
sketch of a (language, source) come ``PRIOR`` documents spread as in its
language, and to that of a language as many spread as in the table: groups of
any size have fences of their own, and small ones lean on what is around them.
Counts do not depend on the order of rows, so reruns agree.

Null language or source: a group of its own.  Null or empty text: no words,
fails the base rule.  Repeated rows are measured and kept as they are.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_pass
from .textstats import TextStats

#: Bins grow by this factor: values of one bin differ by 2 % at most.
GROWTH = 1.02
REACH = 3.0
#: Documents that a group's sketch borrows from the one around it.
PRIOR = 100
#: Least distance of a fence from its quartile.
SLACK = {"symbols": 0.03, "bangs": 0.1, "capitals": 0.15, "repeats": 0.35, "dup_lines": 0.4, "length": 3.0}

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bangs", "n_upper", "n_lines")


def measure(df: DataFrame, text: str = "text", id_col: str = "doc_id", lang: str = "lang",
            source: str = "source") -> DataFrame:
    """(id, __lang, __source, counts): one row for each row of ``df``."""
    rows = df.select(id_col, F.col(lang).alias("__lang"), F.col(source).alias("__source"), F.col(text).alias("__text"))

    def run(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        s = TextStats(texts)
        return pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(getattr(s, c), pa.int64()) for c in _COUNTS)],
                                          [id_col, "__lang", "__source", *_COUNTS])

    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:3])
    return text_pass(rows, run, kinds + "".join(f", {c} long" for c in _COUNTS), "__text")


def ratios() -> dict[str, F.Column]:
    """The ratios of a measured row; a text without words has all 0."""
    def per(a: str, b: str):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {"symbols": per("n_symbols", "word_chars"), "bangs": per("n_bangs", "n_words"),
            "capitals": per("n_upper", "word_chars"), "repeats": per("n_repeat_words", "n_words"),
            "dup_lines": per("n_dup_lines", "n_lines"), "length": per("word_chars", "n_words")}


def sketch(measured: DataFrame) -> DataFrame:
    """(__lang, __source, ratio, bin, n): counts of the logarithmic bins; bin null holds the value 0."""
    each = measured.select("__lang", "__source", F.explode(F.array(*[
        F.struct(F.lit(k).alias("ratio"), v.alias("v")) for k, v in ratios().items()])).alias("x"))
    bin_ = F.when(F.col("x.v") > 0, F.ceil(F.log("x.v") / math.log(GROWTH)).cast("int"))
    return each.groupBy("__lang", "__source", F.col("x.ratio").alias("ratio"), bin_.alias("bin")).agg(
        F.count("*").alias("n"))


def _shares(weights: DataFrame, *by: str) -> DataFrame:
    """Share of each bin in its sketch; a sketch has a bounded number of bins."""
    return weights.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by, "ratio")))


def _leaning(counts: DataFrame, around: DataFrame, own: list[str], shared: list[str]) -> DataFrame:
    """``counts`` by ``own`` columns plus ``PRIOR`` documents spread as ``around`` (by ``shared`` columns) says."""
    groups = counts.select(*own).distinct()
    around = around.select(*[F.col(c).alias(f"__in_{c}") for c in shared], "ratio", "bin", (PRIOR * F.col("share")).alias("n"))
    inside = F.lit(True)
    for c in shared:
        inside = inside & F.col(c).eqNullSafe(F.col(f"__in_{c}"))
    borrowed = groups.join(around, inside) if shared else groups.join(F.broadcast(around), F.lit(True))  # bins of one sketch
    both = counts.select(*own, "ratio", "bin", "n").union(borrowed.select(*own, "ratio", "bin", "n"))
    return both.groupBy(*own, "ratio", "bin").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame) -> DataFrame:
    """(__lang, __source, low_<ratio>, high_<ratio>): the fences of each group."""
    whole = _shares(sketches.groupBy("ratio", "bin").agg(F.sum("n").alias("n")))
    of_lang = sketches.groupBy("__lang", "ratio", "bin").agg(F.sum("n").alias("n"))
    of_lang = _shares(_leaning(of_lang, whole, ["__lang"], []), "__lang")
    by = ["__lang", "__source"]
    merged = _leaning(sketches, of_lang, by, ["__lang"])
    w = Window.partitionBy(*by, "ratio").orderBy(F.col("bin").asc_nulls_first())  # bins of one sketch: bounded
    upto = F.sum("n").over(w)
    total = F.sum("n").over(Window.partitionBy(*by, "ratio"))
    value = F.when(F.col("bin").isNull(), 0.0).otherwise(F.pow(F.lit(GROWTH), F.col("bin") - 0.5))
    q = merged.select(*by, "ratio", value.alias("v"), upto.alias("upto"), total.alias("total"))
    nearly = 1 - 1e-9  # sums of shares in any order
    q = q.groupBy(*by, "ratio").agg(*[F.min(F.when(F.col("upto") >= r * nearly * F.col("total"), F.col("v"))).alias(k)
                                      for k, r in (("q1", 0.25), ("q3", 0.75))])
    slack = F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv])[F.col("ratio")]
    reach = F.greatest(slack, REACH * (F.col("q3") - F.col("q1")))
    q = q.select(*by, "ratio", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    return q.groupBy(*by).agg(*[
        F.max(F.when(F.col("ratio") == k, F.col(side))).alias(f"{side}_{k}") for k in SLACK for side in ("low", "high")])


def judge(df: DataFrame, text: str = "text", id_col: str = "doc_id", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_ratios)."""
    m = stored(measure(df, text, id_col, lang, source), "measured")
    limits = fences(stored(sketch(m), "sketch"))
    limits = stored(limits.withColumnsRenamed({"__lang": "__l", "__source": "__s"}), "fences")
    j = m.join(limits, F.col("__lang").eqNullSafe(F.col("__l")) & F.col("__source").eqNullSafe(F.col("__s")), "left")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out_of = [F.when((v > F.col(f"high_{k}")) | ((v < F.col(f"low_{k}")) if k == "length" else F.lit(False)), F.lit(k))
              for k, v in ratios().items()]
    failed = F.array_compact(F.array(*out_of))
    return j.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), (~base & (F.size(failed) == 0)).alias("kept"),
                    F.array_join(failed, ",").alias("failed_ratios"))
