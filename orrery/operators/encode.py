"""Label and categorical encodings, duration buckets.

All are column expressions: they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length-of-stay classes (days) and survival classes (days).
# LOS, 8 classes: <2, 2-3, 3-4, 4-5, 5-6, 6-7, 7-30, >30.
LOS_UPPER_EXCLUSIVE = [2, 3, 4, 5, 6, 7]   # classes 0..5: days < bound
LOS_UPPER_INCLUSIVE_30 = 30                # class 6: 7 <= days <= 30; class 7: > 30
NB_LOS = 8
# Survival, 5 classes: <=7, 7-30, 30-365, >365 days, unknown.
SURVIVAL_UPPER_INCLUSIVE = [7, 30, 365]    # classes 0..2: days <= bound; class 3: > 365
SURVIVAL_UNKNOWN = 4
NB_SURVIVAL = 5


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def one_hot(col, n: int) -> Column:
    """Class index -> length-n 0/1 double array; an index outside [0, n) fails the query."""
    y = _c(col)
    checked = F.when((y >= 0) & (y < n), y).otherwise(
        F.raise_error(F.concat(F.lit(f"class index out of range [0,{n}): "), y.cast("string"))))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == checked).cast("double"))


def one_hot_nullable(col, values: Sequence) -> Column:
    """One-hot over a fixed value list; NULL or unlisted -> all zeros (unknown)."""
    x = _c(col)
    return F.array(*[F.coalesce((x == F.lit(v)).cast("double"), F.lit(0.0)) for v in values])


def los_bucket(days) -> Column:
    """8 length-of-stay classes; NULL or negative days -> NULL (undefined)."""
    d = _c(days).cast("double")
    e = F.when(d < 0, F.lit(None).cast("int"))
    for k, b in enumerate(LOS_UPPER_EXCLUSIVE):
        e = e.when(d < b, F.lit(k))
    e = e.when(d <= LOS_UPPER_INCLUSIVE_30, F.lit(len(LOS_UPPER_EXCLUSIVE)))
    return e.when(d.isNotNull(), F.lit(NB_LOS - 1)).cast("int")


def survival_bucket(days) -> Column:
    """5 survival classes; NULL or negative days -> the unknown class."""
    d = _c(days).cast("double")
    e = F.when(d.isNull() | (d < 0), F.lit(SURVIVAL_UNKNOWN))
    for k, b in enumerate(SURVIVAL_UPPER_INCLUSIVE):
        e = e.when(d <= b, F.lit(k))
    return e.otherwise(F.lit(len(SURVIVAL_UPPER_INCLUSIVE))).cast("int")
