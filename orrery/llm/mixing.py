"""Mixing sources to target weights, as a time-varying curriculum.

A source's share of the mix changes over the training run: its density at
time t in [0, 1] is its target times ``1 + a (2 t - 1)``, whose integral over
the run is the target.  A document that is taken at cumulative demand u of its
source gets the time t at which the integral reaches u, and documents are
range-sorted by it.

Targets.  Sources in code point order (null last) weigh 1, 2, 3, repeating,
and share all words; a target stops at ``REPEATS`` times its source's words,
the excess goes to the others by weight until none is above.  Each round is
one aggregate over the table of sources, of which two sums reach the driver.

Taking.  A source is read ``target div words`` times in full.  What is left is
filled in hash order by size class, large documents (over 1/64 of the source)
first: each class up to its share, corrected by what the classes before it
have over or under theirs.  A document is taken whole, if its middle lies below
the budget, so a source ends within about half a small document of its target.  Running sums come from the two-level prefix
sum, which spreads a hot source over all tasks.

Null text has size 0 and is never taken.  Rows that agree in id and size are
interchangeable.  An empty table gives an empty mix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scan import prefix_sums, row_number_within
from .common import Words, stored, text_pass

REPEATS = 3
#: Sources whose totals are broadcast: some tens of bytes each.
SOURCES = 100_000
WEIGHTS = (1, 2, 3)
#: Size classes: documents over these shares of their source's words, then the rest.
CLASSES = (1 / 64, 1 / 512)
_GOLDEN = 0.6180339887498949


def sizes(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the number of words of ``text`` as ``__size``; the text column itself goes."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c != text)

    def run(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        keep = [i for i, c in enumerate(rows.schema.names) if c != text]
        return pa.RecordBatch.from_arrays(
            [*(rows.column(i) for i in keep), pa.array(Words(texts).counts.astype(np.int64))],
            [*(rows.schema.names[i] for i in keep), "__size"])

    return text_pass(df, run, f"{kinds}, __size long" if kinds else "__size long", text)


def targets(rows: DataFrame) -> DataFrame:
    """(__s, source_size, target, __lean) of each source of ``rows`` (__source, __size)."""
    src = stored(rows.groupBy("__source").agg(F.sum("__size").alias("source_size")), "sources")
    src = row_number_within(src.withColumn("__null", F.col("__source").isNull()).withColumn("__all", F.lit(1)),
                            ["__all"], ["__null", "__source"], "__rank")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("__rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    src = stored(src.select("__source", "source_size", "__rank", weight.cast("double").alias("__w")), "sources")
    cap = F.lit(float(REPEATS)) * F.col("source_size")
    total = float(src.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:  # every round but the last caps another source
        capped = cap <= level * F.col("__w")
        got = src.agg(F.count(F.when(capped, 1)).alias("n"), F.sum(F.when(capped, cap)).alias("cap"),
                      F.sum(F.when(~capped, F.col("__w"))).alias("w")).first()
        if got["n"] == full or not got["w"]:
            break
        full, level = got["n"], (total - (got["cap"] or 0.0)) / got["w"]
    target = F.when(cap <= level * F.col("__w"), cap).otherwise(level * F.col("__w"))
    lean = (F.col("__rank") * _GOLDEN % 1.0) * 1.6 - 0.8
    return src.select(F.col("__source").alias("__s"), "source_size", target.alias("target"), lean.alias("__lean"))


def _with_totals(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """``rows`` beside the one row of ``totals`` (__s, ...) of their source.

    A table of at most ``SOURCES`` sources is broadcast, so the rows of a hot source stay where they are; a larger one is
    joined by source, where adaptive execution splits skewed partitions.
    """
    totals = stored(totals, "totals")
    small = totals.limit(SOURCES + 1).count() <= SOURCES
    totals = F.broadcast(totals) if small else totals
    return rows.join(totals, F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s")


def plan(rows: DataFrame) -> DataFrame:
    """``rows`` (__key, __source, __size, ...) with source_size, target, copies and the times of the copies."""
    j = _with_totals(rows, targets(rows))
    level = F.lit(len(CLASSES))
    for i, share in reversed(list(enumerate(CLASSES))):
        level = F.when(F.col("__size") > share * F.col("source_size"), i).otherwise(level)
    sums = [f"__words{i}" for i in range(len(CLASSES) + 1)]
    j = j.withColumn("__level", level).withColumn("__hash", F.xxhash64("__key"))
    j = j.withColumns({c: F.when(F.col("__level") == i, F.col("__size")).otherwise(0) for i, c in enumerate(sums)})
    j = stored(prefix_sums(j, ["__source"], ["__hash", "__key", "__size"], sums), "mix")
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.greatest(F.lit(0.0), F.col("target") - times * F.col("source_size"))
    part = F.when(F.col("source_size") > 0, rest / F.col("source_size")).otherwise(0.0)
    j = j.withColumn("__times", times).withColumn("__part", part)
    j = j.withColumn("__in", F.lit(False)).withColumn("__left", F.lit(0.0))
    j = _with_totals(j, j.groupBy(F.col("__source").alias("__s")).agg(*[F.sum(c).alias(f"{c}_all") for c in sums]))
    for i, c in enumerate(sums):
        own = F.col("__level") == i
        j = j.withColumn("__left", F.col("__left") + F.col("__part") * F.col(f"{c}_all"))
        j = j.withColumn("__in", F.col("__in") | own & (F.col(f"{c}_before") + F.col("__size") / 2 < F.col("__left")))
        took = j.groupBy(F.col("__source").alias("__s")).agg(
            F.sum(F.when(own & F.col("__in"), F.col(c)).otherwise(0)).alias("__took"))
        j = _with_totals(j, took)
        j = j.withColumn("__left", F.col("__left") - F.col("__took")).drop("__took")
    more = (F.col("__size") > 0) & (F.col("__times") < REPEATS) & F.col("__in")
    j = j.withColumn("copies", F.when(F.col("__size") > 0, F.col("__times") + more.cast("long")).otherwise(0).cast("int"))
    before = F.col("__size") / 2
    for c in sums:
        before = before + F.col(f"{c}_before")
    a = F.col("__lean")

    def time_of(k):
        u = F.least(F.lit(1.0), (k * F.col("source_size") + before) / F.col("target"))
        return 2 * u / ((1 - a) + F.sqrt((1 - a) * (1 - a) + 4 * a * u))

    spots = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), time_of))
    return j.select(*rows.columns, F.coalesce("source_size", F.lit(0)).alias("source_size"),
                    F.coalesce("target", F.lit(0.0)).alias("target"), "copies",
                    F.coalesce(spots, F.array().cast("array<double>")).alias("times"))


def row_hash(*cols: str) -> Column:
    """Equal for equal rows only, nulls told apart by their place."""
    return F.xxhash64(*cols, *[F.col(c).isNull() for c in cols])


def curriculum(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``rows`` as often as ``planned`` takes them, with ``__id`` and ``__time`` of each, range-sorted by time.

    Both have ``__row``, the same for equal rows only; ``planned`` has an ``__id`` and ``times``.
    """
    spots = planned.select(F.col("__row").alias("__k"), "__id", F.explode("times").alias("__time"))
    whole = rows.dropDuplicates(["__row"]).join(spots, F.col("__row") == F.col("__k")).drop("__k")
    order = ["__time", "__row", "__id"]
    return whole.repartitionByRange(*order).sortWithinPartitions(*order)


def digest(planned: DataFrame, mixed: DataFrame, text: str = "text") -> DataFrame:
    """``planned`` with what ``mixed`` (``curriculum``) holds of each row: taken, copies, first_time and first_place.

    first_place is the position of the first copy in the whole mix, from 1.  A row's number within its partition and the
    rows of the partitions before give it, so one narrow row a partition is all that a window sees.
    """
    held = sizes(mixed.select("__id", "__time", F.col(text).alias("__text")), "__text")
    held = stored(held.withColumn("__at", F.monotonically_increasing_id()), "mixed")  # partition, row in it
    part = F.shiftright("__at", 33)
    parts = held.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    first = F.min(F.struct("__at", "__time"))
    got = held.groupBy("__id").agg(F.sum("__size").alias("taken"), F.count("*").alias("__copies"), first.alias("__first"))
    got = got.join(F.broadcast(parts), F.shiftright("__first.__at", 33) == F.col("__p"))
    place = F.col("__before") + F.col("__first.__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    got = got.select(F.col("__id").alias("__of"), "taken", "__copies", F.col("__first.__time").alias("first_time"),
                     place.alias("first_place"))
    out = planned.drop("copies", "times").join(got, F.col("__id") == F.col("__of"), "left").drop("__of")
    return out.withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).withColumn(
        "copies", F.coalesce("__copies", F.lit(0)).cast("int")).drop("__copies")


def mix(df: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """``df``'s rows as often as the mix takes them, range-sorted by training time: (columns of df)."""
    rows = df.withColumn("__row", row_hash(*df.columns))
    narrow = sizes(rows.select("__row", F.xxhash64(*df.columns).alias("__key"), F.col(source).alias("__source"),
                               F.col(text).alias("__text")), "__text")
    planned = plan(stored(narrow, "sizes")).withColumn("__id", F.lit(0))
    return curriculum(rows, planned).select(*df.columns)
