"""A training corpus from ``documents``: rejected texts, boilerplate lines and near copies go, sources are mixed, texts become ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.  Rows with a null text pass the first
three stages as empty texts and are not taken by the mix.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import bpe, jaccard, linededup, mixing, quality
from orrery.llm.common import read, stored
from orrery.llm.queries import RANKS
from orrery.session import checkpoint_root, ship_package

#: Rows sharing five words in a row, at a similarity of 0.8: near copies.
SHINGLE, NUM, DEN = 5, 80, 100


def _start(spark: SparkSession) -> None:
    ship_package(spark)
    checkpoint_root(spark)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    _start(spark)
    rows = stored(quality.with_features(docs), "features")  # the fit reads the features' column only
    model = quality.fit(rows.select("doc_id", quality.FEATURES), read(spark, sf_dir, "labels", "doc_id", "quality"))
    return rows.where(model.score() >= quality.CUT).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: each source's boilerplate lines leave its documents."""
    _start(spark)
    return linededup.drop_lines(docs).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: the document of smallest id of each group of near copies stays."""
    _start(spark)
    groups = jaccard.join(docs, k=SHINGLE, num=NUM, den=DEN)
    gone = groups.where("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(stored(gone, "gone"), F.col("doc_id") == F.col("__gone"), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as the curriculum takes it, in the order of training."""
    _start(spark)
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: the ids of every document, checked by decoding them."""
    _start(spark)
    return bpe.encode(docs, public_tokenizers.path(RANKS))


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_copies),
    ("mixing", mix),
    ("byte-level BPE", tokenize),
]

#: The classifier has no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared folder and read again."""
    _start(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage{i + 1}")
    return docs
