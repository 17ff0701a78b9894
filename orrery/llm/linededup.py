"""Line dedup by site-relative frequency, in DataFrame functions only.

For each host, the documents that hold a line are counted and divided by the
host's documents.  Lines with a share of ``RATIO`` or more, in ``LEAST``
documents or more, are boilerplate and leave every document of that host.
Lines are compared without white space at their ends; blank lines stay, and a
line counts once for each document.

A document contributes its distinct line hashes, counted before the shuffle.
The boilerplate lines of a host are at most its mean number of lines over
``RATIO``, however many documents it has, so their list is bounded.  It is
written to the shared folder first: small lists are then broadcast by their
known size, others joined by host with skewed hosts split.

Null host: a host of its own.  Null text: stays null, with no lines.  A text
that loses every line becomes empty.  Repeated rows count as documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

RATIO = 0.1
#: A line on fewer documents is no boilerplate of a small host: two copies of a text are not a site's template.
LEAST = 3
_BLANK = " \t\r\x0b\x0c"


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(_BLANK)))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANK)) == ""


def boilerplate(df: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                least: int = LEAST) -> DataFrame:
    """(__host, __lines): hashes of each host's boilerplate lines."""
    docs = df.select(F.col(host).alias("__host"), F.col(text).alias("__text"))
    pages = docs.groupBy("__host").agg(F.count("*").alias("__pages"))
    keys = F.array_distinct(F.transform(F.filter(F.split("__text", "\n"), lambda x: ~_blank(x)), _key))
    held = docs.select("__host", F.explode(keys).alias("__line")).groupBy("__host", "__line").agg(
        F.count("*").alias("__n")).where(F.col("__n") >= least)
    often = held.join(pages.withColumnRenamed("__host", "__h"), F.col("__host").eqNullSafe(F.col("__h")))
    often = often.where(F.col("__n") >= ratio * F.col("__pages"))
    return often.groupBy("__host").agg(F.collect_set("__line").alias("__lines"))


def drop_lines(df: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
               least: int = LEAST) -> DataFrame:
    """``df`` with boilerplate lines taken out of ``text``, and ``__n_lines`` and ``__n_dropped`` at its end."""
    often = stored(boilerplate(df, text, host, ratio, least), "boilerplate").withColumnRenamed("__host", "__h")
    j = df.join(often, F.col(host).eqNullSafe(F.col("__h")), "left")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x: _blank(x) | ~F.array_contains("__lines", _key(x)))
    j = j.withColumn("__kept", F.when(F.col("__lines").isNull(), lines).otherwise(kept))
    n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    out = j.withColumn("__n_lines", F.when(F.col(text).isNull(), 0).otherwise(n).cast("long"))
    out = out.withColumn("__n_dropped", F.when(F.col(text).isNull(), 0).otherwise(n - F.size("__kept")).cast("long"))
    return out.select(*[F.array_join("__kept", "\n").alias(c) if c == text else F.col(c) for c in df.columns],
                      "__n_lines", "__n_dropped")


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, text, i, list_extract(string_split(text, chr(10)), i) AS line
  FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
), keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS k FROM lines
), often AS (
  SELECT h.source, h.k FROM
    (SELECT source, k, count(*) AS n FROM (SELECT DISTINCT doc_id, source, k FROM keyed WHERE k <> '')
     GROUP BY source, k HAVING count(*) >= {LEAST}) h
    JOIN (SELECT source, count(*) AS pages FROM documents GROUP BY source) p
      ON h.source IS NOT DISTINCT FROM p.source
  WHERE h.n >= {RATIO} * p.pages
), marked AS (
  SELECT x.*, o.k IS NOT NULL AS drop_it FROM keyed x LEFT JOIN often o
    ON x.k = o.k AND x.source IS NOT DISTINCT FROM o.source
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(drop_it AS INT)) AS BIGINT) AS n_dropped,
  coalesce(string_agg(CASE WHEN NOT drop_it THEN line END, chr(10) ORDER BY i), '') AS text
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
