"""Exact word-shingle Jaccard join by parity sketches.

Two sets link when ``100 |A & B| >= 85 |A | B|``, so a pair of sizes a, b links
only if at most ``3 (a + b) / 37`` shingles are in just one of them.

Sketch.  For each size band a set is thrown into B cells by a hash; a cell is
the XOR of its shingles' hashes, that is, their parity.  One differing shingle
changes one cell, so the number of differing cells is a lower bound of the
symmetric difference, and a linked pair has B - D equal cells or more, D being
the band's largest allowed difference: the pigeonhole join is on single cells.
A band's index holds its own sets and those larger ones that can still link.

Light cells, with no shingle (or one, where enough cells are left), are equal
in many unrelated sets.  They are left out where a set has fewer of them than
B - D: then some other cell of a linked pair is equal too.  A set with more
also enters the next of ``SEEDS`` independent throws, and after the last one all its cells: no link is lost.

Join.  Sets with the same shingles are one node.  Buckets (sets with an equal
cell) of one node end in the shuffle that made them.  In the others the node
with the most neighbours in all its buckets, as the middle of a group of near
copies has, is compared with each of the rest.  Only buckets that still hold
several components go on.  They are cut into blocks of ``BLOCK`` nodes, and for
each pair of blocks the bits of finer sketches are compared: pairs of different
components whose Hamming distance allows a link come out.  So a group of near
copies costs one comparison a node, no bucket is in one task's memory, and each
pair of a bucket is connected, ruled out by its sketches, or compared.

A comparison joins the two texts and counts the shingles both hold.  Texts
that are in no shared bucket are not moved for it.  Shingles are compared as
64-bit hashes.

Links.  The pairs compared so far connect the components; a link lies within
one, so all links are counted there: a component is cut into blocks by a hash,
and for each pair of blocks the shingles that every two of their sets share are
counted at once, by products of 0/1 matrices.  No component is in one task's
memory.  The work is quadratic in a component's different sets, as its links are.

Null and empty text: an empty set, linked with nothing.  Null ids: such rows
get null components and link nothing.  Repeated ids must agree in text; a
repeated row is returned as often as it came.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _ODD, Words, components, mix, slices, stored, text_pass

SEEDS = 8
#: Nodes of a block, and most bits of a node's finer sketch.
BLOCK = 256
BITS = 2048
#: Keys of emitted sets that a task remembers, to emit a copy's cells once.
SEEN = 200_000
#: Shingles of a block of the link count, and columns of its matrices.
HASHES = 1 << 20
COLUMNS = 4096
_U = np.uint64


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after the other, and the n + 1 offsets."""
    w = Words(texts, fold=True)
    counts, n = w.counts, len(texts)
    hashes = w.windows(k)
    owner = w.owner
    own = np.flatnonzero(owner[:len(hashes)] == owner[k - 1:]) if len(hashes) else np.empty(0, np.int64)
    keys, who = [hashes[own]], [owner[own]]
    for d in np.flatnonzero((counts > 0) & (counts < k)):  # the whole sequence as one
        h = _U(counts[d])
        with np.errstate(over="ignore"):
            for x in w.hashes[w.first[d]:w.first[d + 1]]:
                h = h * _U(0xA0761D6478BD642F) + x
        keys.append(mix(np.array([h])))
        who.append(np.array([d]))
    key, text = np.concatenate(keys), np.concatenate(who).astype(np.int64)
    order = np.lexsort((key, text))
    key, text = key[order], text[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    key, text = key[new], text[new]
    return key, np.searchsorted(text, np.arange(n + 1))


def set_keys(key: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; equal sets have equal names."""
    both = np.concatenate([[_U(0)], np.cumsum(mix(key), dtype=np.uint64)])
    size = np.diff(offs).astype(np.uint64)
    return mix(mix(both[offs[1:]] - both[offs[:-1]]) + size * _ODD)


class Bands:
    """Size bands, a factor of 5 / 4 apart, for a least Jaccard of num / den.

    A band's number of cells is the smallest whose expected number of light
    cells, and a bit more, is under the number of cells to spare.
    """

    def __init__(self, num: int = 85, den: int = 100):
        if not 4 * den <= 5 * num <= 5 * den:  # a set enters its own band and one more, which reaches no further
            raise ValueError("the least similarity must be from 0.8 to 1")
        self.num, self.den = num, den
        self.from_, self.reach, self.cells, self.spare, self.few = [], [], [], [], []
        lo = 1
        while lo < 1 << 31:
            hi = max(lo + 1, lo * 5 // 4)
            top = self.largest(hi - 1)
            least = cells = self.difference(hi - 1, top) + 1
            for few in (1, 0):  # cells of one shingle are left out where there are enough others
                if self._spared(lo, least, 2 * least + 8, few):
                    cells = bisect_left(range(2 * least + 8), True, lo=least,
                                        key=lambda n, few=few: self._spared(lo, least, n, few))
                    break
            self.few.append(few)
            self.from_.append(lo)
            self.reach.append(top)
            self.cells.append(cells)
            self.spare.append(cells - least)
            lo = hi

    @staticmethod
    def _spared(size: int, least: int, cells: int, few: int) -> bool:
        """Whether more cells are to spare than hold ``few`` shingles or less."""
        light = math.exp(-size / cells) * (1 + few * size / cells)
        return cells - least >= cells * light + 0.8 * math.sqrt(cells * light * (1 - light))

    def largest(self, n: int) -> int:
        """Size of the largest set that links with one of size n."""
        return n * self.den // self.num

    def difference(self, a: int, b: int) -> int:
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def of(self, n: int) -> list[int]:
        """Indexes that a set of size n enters."""
        k = int(np.searchsorted(self.from_, n, "right")) - 1
        return [k] if k == 0 or n > self.reach[k - 1] else [k - 1, k]

    def cell_keys(self, hashes: np.ndarray) -> np.ndarray:
        """The cells of one set to join on, named by band, throw, place and parity."""
        out = []
        for band in self.of(len(hashes)):
            cells, spare = self.cells[band], self.spare[band]
            for seed in range(SEEDS):
                salt = mix(np.array([band * SEEDS + seed + 1], np.uint64) * _ODD)[0]
                thrown = mix(hashes ^ salt)
                place = ((thrown >> _U(32)) * _U(cells) >> _U(32)).astype(np.int64)
                order = np.argsort(place, kind="stable")
                count = np.bincount(place, minlength=cells)
                parity = np.zeros(cells, np.uint64)
                held = np.flatnonzero(count)
                parity[held] = np.bitwise_xor.reduceat(mix(thrown[order]), (np.cumsum(count) - count)[held])
                heavy = count > self.few[band]
                enough = cells - int(heavy.sum()) <= spare
                use = heavy if enough or seed < SEEDS - 1 else np.ones(cells, bool)
                out.append(mix(parity[use] + mix(np.flatnonzero(use).astype(np.uint64) + salt)))
                if enough:
                    break
        return np.concatenate(out)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def sets(df: DataFrame, text: str, id_col: str, k: int) -> DataFrame:
    """(id, __n, __key): size and name of each text's set; an empty set has no name."""
    def run(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        key, offs = shingles(texts, k)
        n = np.diff(offs)
        name = pc.if_else(pa.array(n > 0), _signed(set_keys(key, offs)), pa.scalar(None, pa.int64()))
        return pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index(id_col)), pa.array(n), name],
                                          [id_col, "__n", "__key"])

    return text_pass(df.select(id_col, text), run, f"`{id_col}` {dict(df.dtypes)[id_col]}, __n long, __key long", text)


def _cells(df: DataFrame, text: str, id_col: str, k: int, bands: Bands) -> DataFrame:
    """(__cell, __key): the cells of every set, once for each task that holds it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()

        def one(_, texts: pa.Array) -> pa.RecordBatch:
            key, offs = shingles(texts, k)
            names = set_keys(key, offs)
            cells, owner = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for d in np.flatnonzero(np.diff(offs)):
                name = int(names[d])
                if name in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                got = bands.cell_keys(key[offs[d]:offs[d + 1]])
                cells.append(got)
                owner.append(np.full(len(got), names[d]))
            return pa.RecordBatch.from_arrays([_signed(np.concatenate(cells)), _signed(np.concatenate(owner))],
                                              ["__cell", "__key"])

        yield from slices(batches, text, one)

    return df.select(text).where(F.col(id_col).isNotNull()).mapInArrow(run, "__cell long, __key long")


def _compare(pairs: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b, __linked) for every pair of nodes; ``docs`` has (__key, __text)."""
    right = docs.select(F.col("__key").alias("b"), F.col("__text").alias("__text_b"))
    left = docs.select(F.col("__key").alias("a"), F.col("__text").alias("__text_a"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "__text_a", "__text_b")

    def run(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        x, xo = shingles(texts, k)
        y, yo = shingles(rows.column(3).cast(pa.large_string()), k)
        linked = []
        for i in range(len(texts)):
            p, q = x[xo[i]:xo[i + 1]], y[yo[i]:yo[i + 1]]
            same = len(np.intersect1d(p, q, assume_unique=True))
            linked.append(same > 0 and den * same >= num * (len(p) + len(q) - same))
        return pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(linked, pa.bool_())],
                                          ["a", "b", "__linked"])

    return text_pass(both, run, "a long, b long, __linked boolean", "__text_a")


def join(df: DataFrame, text: str = "text", id_col: str = "doc_id", k: int = 4, num: int = 85,
         den: int = 100) -> DataFrame:
    """(id, n_shingles, component_id, n_links): one row for each row of ``df``.

    component_id is the smallest id reachable by links of Jaccard num / den or
    more; n_links counts all other ids whose set links with the row's, copies
    included.
    """
    bands = Bands(num, den)
    named = stored(sets(df, text, id_col, k), "sets")
    nodes = named.where(F.col("__key").isNotNull() & F.col(id_col).isNotNull())
    nodes = nodes.select("__key", id_col).distinct().groupBy("__key").agg(F.min(id_col).alias("__rep"),
                                                                          F.count("*").alias("__docs"))
    cells = _cells(df, text, id_col, k, bands)
    w = Window.partitionBy("__cell")
    shared = cells.select("__cell", "__key", F.lag("__key").over(w.orderBy("__key")).alias("__last"),
                          F.min("__key").over(w).alias("__lo"), F.max("__key").over(w).alias("__hi"),
                          F.count("*").over(w).alias("__size"))
    shared = shared.where("__lo <> __hi and (__last is null or __last <> __key)")  # a set once for each cell
    shared = stored(shared.select("__cell", "__key", "__size"), "buckets")
    weight = shared.groupBy("__key").agg(F.sum("__size").alias("__weight"))
    first = w.orderBy(F.desc("__weight"), "__key")
    shared = shared.join(weight, "__key").select("__cell", "__key", F.row_number().over(first).alias("__rank"))
    shared = stored(shared, "buckets")
    used = shared.select("__key").distinct().join(nodes, "__key")
    used = used.select("__key", F.col("__rep").alias("__id"))
    texts = df.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    docs = texts.join(used, "__id").dropDuplicates(["__key"]).select("__key", "__text")
    docs = stored(docs, "texts")

    hubs = shared.where("__rank = 1").select("__cell", F.col("__key").alias("__hub"))
    pairs = shared.where("__rank > 1").join(hubs, "__cell")
    found = stored(_compare(_pairs(pairs, "__hub", "__key"), docs, k, num, den), "compared").where("__linked")
    comps = stored(components(found), "components")
    label = shared.join(comps.withColumnRenamed("node", "__key"), "__key", "left")
    label = label.select("__cell", "__key", "__rank", F.coalesce("component", "__key").alias("__comp"))
    mixed = label.groupBy("__cell").agg(F.min("__comp").alias("__lo"), F.max("__comp").alias("__hi"),
                                        F.max("__rank").alias("__last")).where("__lo <> __hi").select("__cell", "__last")
    open_ = stored(label.join(mixed, "__cell"), "open")
    near = stored(_near(open_, _sketches(docs, k), num, den), "near")
    more = stored(_compare(_pairs(near, "a", "b"), docs, k, num, den), "compared").where("__linked")
    comps = stored(components(found.union(more)), "components")
    return _result(named, nodes, comps, _links(docs, comps, nodes, k, num, den), id_col)


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _sketches(docs: DataFrame, k: int) -> DataFrame:
    """(__key, __n, __bits): size and bit parities of each node, about four bits a shingle."""
    def run(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        key, offs = shingles(texts, k)
        bits = []
        for lo, hi in zip(offs[:-1], offs[1:], strict=True):
            m = min(BITS, max(64, 1 << int(4 * (hi - lo) - 1).bit_length())) if hi > lo else 64
            odd = np.bincount((mix(key[lo:hi] ^ _ODD) % _U(m)).astype(np.int64), minlength=m) & 1
            bits.append(np.packbits(odd.astype(np.uint8)).tobytes())
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(offs)), pa.array(bits, pa.binary())],
                                          ["__key", "__n", "__bits"])

    return text_pass(docs, run, "__key long, __n long, __bits binary", "__text")


def _near(open_: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): pairs of a bucket, of different components, whose sketches allow a link."""
    rows = open_.join(sketches, "__key")
    block = ((F.col("__rank") - 1) / BLOCK).cast("long")
    blocks = ((F.col("__last") - 1) / BLOCK).cast("long")
    rows = rows.withColumn("__block", block).withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), blocks)))
    rows = rows.withColumn("__one", F.least("__block", "__other")).withColumn("__two", F.greatest("__block", "__other"))
    group = ["__cell", "__one", "__two"]
    rows = rows.select(*group, "__block", "__key", "__comp", "__n", "__bits")
    rows = rows.repartition(*[F.col(c) for c in group]).sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 3):
            a, b = _close(table, num, den)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[pa.Table]:
    """Rows of sorted batches that agree in the first ``by`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy() for i in range(by)]
        new = np.zeros(batch.num_rows, bool)
        for x in keys:
            new[1:] |= x[1:] != x[:-1]
        if held:
            new[0] = any(held[-1].column(i)[-1].as_py() != x[0] for i, x in enumerate(keys))
        lo = 0
        for hi in np.flatnonzero(new):
            held.append(batch.slice(lo, hi - lo))
            yield pa.Table.from_batches(held)
            held, lo = [], hi
        held.append(batch.slice(lo))
    if held:
        yield pa.Table.from_batches(held)


def _close(table: pa.Table, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    one, two, block, key, comp, n = (table.column(i).to_numpy() for i in range(1, 7))
    left = np.flatnonzero(block == one)
    right = left if one[0] == two[0] else np.flatnonzero(block == two)
    small, large = np.minimum.outer(n[left], n[right]), np.maximum.outer(n[left], n[right])
    allowed = (small + large) * (den - num) // (den + num)
    fit = (comp[left][:, None] != comp[right]) & (den * small >= num * large)
    if left is right:
        fit &= np.tri(len(left), k=-1, dtype=bool)
    i, j = np.nonzero(fit)
    if not len(i):
        return i, j
    bits = [np.frombuffer(b, np.uint64) for b in table.column(7).to_pylist()]
    words = min(map(len, bits))
    bits = np.array([np.bitwise_xor.reduce(b.reshape(-1, words), axis=0) for b in bits])  # folded to one length
    keep = []
    for at in range(0, len(i), 1 << 14):
        p, q = i[at:at + (1 << 14)], j[at:at + (1 << 14)]
        apart = np.bitwise_count(bits[left[p]] ^ bits[right[q]]).sum(axis=1)
        keep.append(apart <= allowed[p, q])
    keep = np.concatenate(keep)
    return key[left[i[keep]]], key[right[j[keep]]]


def _links(docs: DataFrame, comps: DataFrame, nodes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(__key, __links): ids of the other sets that link with each node of a component."""
    rows = docs.join(comps.withColumnRenamed("node", "__key"), "__key")
    rows = rows.join(nodes.select("__key", "__docs"), "__key").select("__key", "__text", "component", "__docs")

    def hashes(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        key, offs = shingles(texts, k)
        held = [key[lo:hi].tobytes() for lo, hi in zip(offs[:-1], offs[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(np.diff(offs)),
                                           pa.array(held, pa.binary())], ["__key", "component", "__docs", "__n", "__held"])

    rows = stored(text_pass(rows, hashes, "__key long, component long, __docs long, __n long, __held binary", "__text"),
                  "shingles")
    blocks = rows.groupBy("component").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("__n") / HASHES)).alias("__blocks"))
    rows = rows.join(blocks, "component")
    rows = rows.withColumn("__block", F.pmod(F.xxhash64("__key"), "__blocks"))
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1)))
    rows = rows.withColumn("__one", F.least("__block", "__other")).withColumn("__two", F.greatest("__block", "__other"))
    group = ["component", "__one", "__two"]
    rows = rows.select(*group, "__block", "__key", "__docs", "__n", "__held")
    rows = rows.repartition(*[F.col(c) for c in group]).sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 3):
            key, links = _linked(table, num, den)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(links)], ["__key", "__links"])

    return rows.mapInArrow(run, "__key long, __links long").groupBy("__key").agg(F.sum("__links").alias("__links"))


def _linked(table: pa.Table, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of two blocks (or of one) and the ids that each links with in the other."""
    one, two, block, key, docs, n = (table.column(i).to_numpy() for i in range(1, 7))
    left = np.flatnonzero(block == one)
    alone = one[0] == two[0]
    right = left if alone else np.flatnonzero(block == two)
    row = np.repeat(np.arange(len(n)), n)
    held = np.frombuffer(b"".join(table.column(7).to_pylist()), np.uint64)
    _, col, times = np.unique(held, return_inverse=True, return_counts=True)
    common = times > 1  # shingles of one set are in no intersection
    row, col = row[common[col]], (np.cumsum(common) - 1)[col[common[col]]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    same = np.zeros((len(left), len(right)))
    for at in range(0, int(common.sum()), COLUMNS):
        lo, hi = np.searchsorted(col, [at, at + COLUMNS])
        has = np.zeros((len(n), int(col[hi - 1]) - at + 1), np.float32)  # sums of up to COLUMNS ones are exact
        has[row[lo:hi], col[lo:hi] - at] = 1
        same += has[left] @ has[right].T
    same = same.astype(np.int64)
    linked = (same > 0) & (den * same >= num * (n[left][:, None] + n[right] - same))
    if alone:
        np.fill_diagonal(linked, False)
        return key[left], linked @ docs[left]
    return np.concatenate([key[left], key[right]]), np.concatenate([linked @ docs[right], docs[left] @ linked])


def _result(named: DataFrame, nodes: DataFrame, comps: DataFrame, links: DataFrame, id_col: str) -> DataFrame:
    classed = nodes.join(comps.withColumnRenamed("node", "__key"), "__key", "left")
    classed = classed.withColumn("component", F.coalesce("component", "__key"))
    least = classed.groupBy("component").agg(F.min("__rep").alias("component_id"))
    n_links = F.coalesce("__links", F.lit(0)) + F.col("__docs") - 1
    classed = classed.join(least, "component").join(links, "__key", "left").select(
        F.col("__key").alias("__k"), "component_id", n_links.alias("n_links"))
    out = named.join(classed, F.col("__key") == F.col("__k"), "left")
    return out.select(id_col, F.col("__n").alias("n_shingles"),
                      F.when(F.col(id_col).isNotNull(), F.coalesce("component_id", id_col)).alias("component_id"),
                      F.when(F.col(id_col).isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"))
