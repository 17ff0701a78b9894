"""Record slices, train/valid/test splits and mini-batch numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import row_number_within

# Fixed values of the reference workload: 4,000 records, 3,200 train,
# 400 validation, the remaining 400 test; mini-batches of 32.
NB_TRAIN = 3200
NB_VALID = 400
NB_RECORDS = 4000
BATCH_SIZE = 32


def slice_records(df: DataFrame, start: int | None = None, end: int | None = None,
                  id_col: str = "record_id") -> DataFrame:
    """Half-open id slice ``[start, end)``.

    Kept quirk: bounds are tested for truthiness, so ``start=0`` and
    ``end=0`` both mean *unset* (``end=0`` returns everything).
    """
    cond: Column | None = None
    if start:
        cond = F.col(id_col) >= F.lit(start)
    if end:
        c = F.col(id_col) < F.lit(end)
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def split_expr(id_col: str, train_end, valid_end) -> Column:
    i = F.col(id_col)
    return (F.when(i < train_end, F.lit("train"))
            .when(i < valid_end, F.lit("valid"))
            .otherwise(F.lit("test")))


def assign_split(df: DataFrame, id_col: str = "record_id", n_train: int | float = NB_TRAIN,
                 n_valid: int | float = NB_VALID, split_col: str = "split",
                 id_space: DataFrame | None = None) -> DataFrame:
    """Contiguous id ranges; test is the remainder.

    Integers are absolute id bounds (the reference: [0,3200), [3200,3600),
    [3600, ...)).  Fractions are shares of the id space ``max(id)+1``; that
    bound is a scalar subquery, evaluated once, not a join.  ``id_space`` is
    a narrow DataFrame holding the same ids (``id_col``) to take the maximum
    from, so an expensive ``df`` is not computed a second time for one number.
    """
    if isinstance(n_train, float) or isinstance(n_valid, float):
        src = id_space if id_space is not None else df
        size = src.select((F.max(id_col) + 1).alias("n")).scalar()
        train_end = F.floor(size * F.lit(float(n_train)))
        valid_end = F.floor(size * F.lit(float(n_train) + float(n_valid)))
    else:
        train_end = F.lit(int(n_train))
        valid_end = F.lit(int(n_train) + int(n_valid))
    return df.withColumn(split_col, split_expr(id_col, train_end, valid_end))


def batch_number(df: DataFrame, by: list[str], id_col: str = "record_id", size: int = BATCH_SIZE,
                 name: str = "batch_no") -> DataFrame:
    """Rows in id order cut into batches of ``size`` (short last batch), per group.

    The row position comes from the two-level prefix count, so a big split is
    never ranked inside one task.
    """
    rn = row_number_within(df, by, [id_col], name="__rn")
    return rn.withColumn(name, ((F.col("__rn") - 1) / F.lit(size)).cast("long")).drop("__rn")
