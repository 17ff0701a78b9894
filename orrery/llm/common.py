"""Shared pieces: byte-level word passes over Arrow batches, shared-folder tables, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, scratch_path, ship_package

#: Text bytes handled at once inside a task; bounds a Python worker's memory whatever the Arrow batch holds.
SLICE_BYTES = 2 << 20

#: Separators of words: space and the ASCII controls from tab to carriage return.
_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str | Column) -> DataFrame:
    """Columns of one table; ships the package first, so that tasks can import it."""
    ship_package(spark)
    checkpoint_root(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: fixed rows and a short lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table that ``stored`` wrote, once all that was read from it has been written itself."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


# ---------------------------------------------------------------- text passes

def text_pass(df: DataFrame, fn: Callable[[pa.RecordBatch, pa.Array], pa.RecordBatch | None], schema: str,
              text: str) -> DataFrame:
    """Apply ``fn(rows, texts)`` to slices of rows holding about ``SLICE_BYTES`` of text (a null text is empty)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from slices(batches, text, fn)
    return df.mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch], text: str,
           fn: Callable[[pa.RecordBatch, pa.Array], pa.RecordBatch | None]) -> Iterator[pa.RecordBatch]:
    """``fn(rows, texts)`` of slices of the batches."""
    for batch in batches:
        texts = pc.fill_null(batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()), "")
        for lo, hi in _cuts(texts):
            out = fn(batch.slice(lo, hi - lo), texts.slice(lo, hi - lo))
            if out is not None and out.num_rows:
                yield out


def _cuts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    if not len(texts):
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = done = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield lo, hi
        lo, done = hi, ends[hi - 1]


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the n + 1 offsets between them."""
    _, off, data = texts.buffers()
    offs = np.frombuffer(off, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_FOLD = _BYTE.copy()
_FOLD[65:91] = _BYTE[97:123]


def _powers(n: int) -> np.ndarray:
    p = np.full(max(1, n), 0xD6E8FEB86659FD93, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def hash_spans(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans that follow one another (a gap may lie between); ``fold`` ignores the case of A-Z."""
    if not len(starts):
        return np.empty(0, np.uint64)
    firsts = np.cumsum(lens) - lens
    pos = np.arange(int(lens.sum())) - np.repeat(firsts, lens)
    vals = (_FOLD if fold else _BYTE)[data[pos + np.repeat(starts, lens)]] * _powers(int(lens.max()))[pos]
    return mix(np.add.reduceat(vals, firsts) + lens.astype(np.uint64) * _ODD)


class Words:
    """Words of a slice of texts, ``[^\\x20\\x09-\\x0D]+`` unless ``sep`` (a flag of each byte) says otherwise.

    Has their byte starts and lengths, hashes, and the first word of each text.
    """

    def __init__(self, texts: pa.Array, fold: bool = False, sep: np.ndarray = _SEP):
        self.data, self.offs = raw(texts)
        word = ~sep[self.data]
        begin, end = word.copy(), word.copy()
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        inner = self.offs[1:-1]
        inner = inner[(inner > 0) & (inner < len(word))]
        begin[inner] = word[inner]
        end[inner - 1] = word[inner - 1]
        self.starts = np.flatnonzero(begin)
        self.lens = np.flatnonzero(end) + 1 - self.starts
        self.first = np.searchsorted(self.starts, self.offs)
        self.is_word, self.fold = word, fold

    @cached_property
    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.lens, self.fold)

    @cached_property
    def owner(self) -> np.ndarray:
        """Text of each word."""
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.first))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; the last k - 1 of a text reach into the next one and must be cut."""
        h, n = self.hashes, len(self.hashes) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        out = h[:n].copy()
        for i in range(1, k):
            out = out * _U(0xD6E8FEB86659FD93) + h[i:i + n]
        return mix(out)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value of every byte over each text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.offs[1:]] - total[self.offs[:-1]]


# ---------------------------------------------------------------- connected components

def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, component) for ``edges`` (a, b) of long ids: equal components mean that nodes are connected.

    Rounds of contraction: every node goes to that of itself and its
    neighbours whose hash is smallest, edges follow, and loops go.  A star is
    gone after two rounds, a path loses a third of its nodes in each, and every
    second round hashes anew.  The smallest is a partial aggregate, so a hub's
    neighbours never meet in one task, and the joins are equi-joins, which
    adaptive execution splits when a hub is skewed.  Each round is written to
    the shared folder.  Loops and null ids are ignored, repeated edges collapse.
    """
    def between(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    e = stored(between(edges.select("a", "b")), "edges")
    steps = []
    while not e.isEmpty():
        if len(steps) == max_rounds:
            raise RuntimeError("connected components did not settle")
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = [F.xxhash64(c, F.lit(len(steps) // 2)) for c in ("a", "b")]
        near = F.min(F.struct(order[1].alias("h"), F.col("b").alias("to")))
        to = both.groupBy("a").agg(F.least(near, F.struct(order[0].alias("h"), F.col("a").alias("to"))).alias("m"))
        to = stored(to.select(F.col("a").alias("node"), F.col("m.to").alias("to")), "steps")
        steps.append(to)
        moved = e.join(to.withColumnsRenamed({"node": "a", "to": "ma"}), "a")
        moved = moved.join(to.withColumnsRenamed({"node": "b", "to": "mb"}), "b")
        e, before = stored(between(moved.select(F.col("ma").alias("a"), F.col("mb").alias("b"))), "edges"), e
        forget(before)
    if not steps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = steps[0].withColumnRenamed("to", "component")
    for to in steps[1:]:
        out = out.join(to.withColumnsRenamed({"node": "component", "to": "__to"}), "component", "left")
        out = out.select("node", F.coalesce("__to", "component").alias("component"))
    return out
