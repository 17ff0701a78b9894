"""The registered query of each operator: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, html, jaccard, linededup, mixing, prefixtrie, quality, rules, secrets, topk, toxicity, urls, variants
from .common import read, stored

#: Vocabulary of the tokenizing query.
RANKS = "byte_bpe_50k.tiktoken"
#: Host, path and verdict of the url rules.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every whole text of ``documents``."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path(RANKS), ids=False)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts the main text of every page."""
    return html.extract_pages(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every whole text of ``documents``, learning from the labelled rows that are not held out."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    rows = stored(quality.with_features(docs).drop("text"), "features")
    model = quality.fit(rows, read(spark, sf_dir, "labels", "doc_id", "quality"))
    out = rows.select("doc_id", quality.held_out().alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= quality.CUT).cast("int"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links ``documents`` whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard.join(read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finds secrets in every whole text of ``documents``."""
    return secrets.scan(read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes all of ``documents`` in the order of training: words, target and take of each, time and place of its first copy."""
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text").withColumn(
        "__row", mixing.row_hash("doc_id", "source", "text"))
    narrow = docs.select("__row", F.col("doc_id").alias("__key"), F.col("source").alias("__source"), "text")
    planned = mixing.plan(stored(mixing.sizes(narrow), "sizes")).withColumn("__id", F.monotonically_increasing_id())
    planned = stored(planned, "planned")
    rows = mixing.digest(planned, mixing.curriculum(docs, planned))
    return rows.select(F.col("__key").alias("doc_id"), F.col("__size").alias("size"), "source_size", "target", "taken",
                       "copies", "first_time", "first_place")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finds the 20 best inner products of every 20th vector, among all others."""
    return topk.search(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges every page's url by the rules and its aliases."""
    rows = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(read(spark, sf_dir, "pages", "page_id", "url", "html"), rows)


def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Takes each source's boilerplate lines out of ``documents``."""
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    return linededup.drop_lines(docs).select("doc_id", F.col("__n_lines").alias("n_lines"),
                                             F.col("__n_dropped").alias("n_dropped"), "text")


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures every whole text of ``documents`` and judges it by its language's and source's thresholds."""
    return rules.judge(read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every whole text of ``documents`` for toxicity, learning from the labelled rows that are not held out."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.scores(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups the spelling variants of the words of all of ``documents``."""
    return variants.variants(read(spark, sf_dir, "documents", "doc_id", "text"))


def op13_prefixtrie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Builds the prefix trie of all rebuilt ``conversations``."""
    return prefixtrie.shared_trie(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


_NATIVE_RULES = """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r(rule_host, rule_path, verdict) AS (VALUES %s), best AS (
  SELECT p.page_id, r.rule_host || r.rule_path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host || r.rule_path) DESC) AS k
  FROM p JOIN r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT p.page_id, coalesce(p.host, '') AS host, coalesce(p.path, '') AS path, best.rule,
  coalesce(best.verdict, 'allow') AS verdict
FROM p LEFT JOIN best ON p.page_id = best.page_id AND best.k = 1
""" % ", ".join(map(str, URL_RULES))

_TOP = """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS q
  FROM embeddings WHERE len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len(embedding) > 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % 20 = 0
)
SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id, score FROM s) WHERE rank <= 20
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe, op2_html, op3_quality, op4_jaccard, op5_secrets, op6_mixing, op7_topk, op8_urls,
                            op9_linededup, op10_rules, op11_toxicity, op12_variants, op13_prefixtrie)}
#: The url oracle holds where no page links to another, as in the given tables; tests cover links by brute force.
ORACLE: dict[str, str] = {"op7_topk": _TOP, "op8_urls": _NATIVE_RULES, "op9_linededup": linededup.ORACLE_SQL}
