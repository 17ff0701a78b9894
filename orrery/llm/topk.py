"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors are cut into 1, 4 and 16 segments.  From a segment's mean and
deviation in two vectors follows a lower bound of their squared distance,

    sum over segments of  length (mean difference)^2 + (deviation difference)^2,

and as the norms are known, an upper bound of the inner product.  The bound is
used coarse to fine:

1. *clusters*: vectors go to the nearest of some pivots by the statistics of 16
   segments, and clusters are cut into blocks.  A block's envelope holds the
   least and greatest value of each statistic, which bounds the inner product
   of any two vectors of two blocks;
2. each query is compared with one block of its own cluster, which gives it a
   k-th best score to beat, and each block of queries the least of them;
3. only blocks whose envelope can reach that score meet the block of queries:
   rows are copied for these pairs alone;
4. within a pair, bounds of 1, 4 and 16 segments rule out candidates one by
   one, and the survivors' inner products are computed exactly.

Blocks have bounded size and each pair is one group: no task holds all queries
or all candidates.  Pivots and envelopes are broadcast; there are at most
``PIVOTS`` and ``BLOCKS`` of them, whatever the number of vectors, and blocks of
more rows meet in parts.  Each group returns its k best of each query, and a
window with a group limit merges them.  If vectors have no clusters, all pairs
of blocks meet, as in a full search.

Components are floor(64 x), x as double.  Rows whose id or vector is null, or
whose vector is empty or holds null or non-finite components, take no part, and
neither do vectors whose quantized square length is 2^63 or more, as their
scores need not fit a long.  Vectors of different length are not compared; rows
with the query's own id are not its candidates.  Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

CANDIDATES = 8192
QUERIES = 2048
SEGMENTS = (1, 4, 16)
SCALE = 64.0
PIVOTS, BLOCKS = 1024, 16_384
#: Segments of the statistics that clusters and envelopes use.
COARSE = 16
_EXACT = float(1 << 53)
_LARGEST = float(1 << 63)


def _quantized(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = col.combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return np.floor(SCALE * flat.to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dim)


def _statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products are the upper bounds: root of length times mean, and root of squared deviation."""
    cuts = np.unique(np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int))
    size = np.diff(cuts)
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / size
    square = np.add.reduceat((x - np.repeat(mean, size, axis=1)) ** 2, cuts[:-1], axis=1)
    return np.hstack([mean * np.sqrt(size), np.sqrt(square)])


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if len(score) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        own = np.flatnonzero(score >= kth)
    else:
        own = np.arange(len(score))
    return own[np.lexsort((ids[own], -score[own]))[:k]]


def block_top(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray,
              k: int, beat: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids and exact scores of the k best candidates of each query (those below ``beat`` may miss)."""
    top = max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0))
    if top * top * rows.shape[1] >= _EXACT:  # products beyond the integers that a double holds
        return _slow_top(queries, query_ids, rows, ids, k)
    levels = [(_statistics(queries, s), _statistics(rows, s)) for s in SEGMENTS]
    out_q, out_i, out_s = [], [], []
    for i, q in enumerate(queries):
        coarse = levels[1][1] @ levels[1][0][i]
        coarse[ids == query_ids[i]] = -np.inf
        live = np.flatnonzero(coarse > -np.inf)
        if not len(live):
            continue
        slack = 1e-9 * (1.0 + np.abs(coarse[live]).max()) * rows.shape[1]
        first = live if len(live) <= 4 * k else live[np.argpartition(-coarse[live], 4 * k)[:4 * k]]
        score = rows[first] @ q
        least = np.partition(score, len(score) - k)[len(score) - k] if len(score) >= k else -np.inf
        least = max(least, beat[i]) if beat is not None else least
        for mine, theirs in levels:
            if least > -np.inf:
                live = live[theirs[live] @ mine[i] >= least - slack]
        score = rows[live] @ q
        best = _best(score, ids[live], k)
        out_q.append(np.full(len(best), query_ids[i]))
        out_i.append(ids[live][best])
        out_s.append(score[best])
    if not out_q:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s).astype(np.int64)


def _slow_top(queries, query_ids, rows, ids, k):
    whole = [[int(v) for v in r] for r in rows]
    out = []
    for q, own in zip(queries, query_ids, strict=True):
        q = [int(v) for v in q]
        scored = [(-sum(a * b for a, b in zip(q, r, strict=True)), i) for r, i in zip(whole, ids.tolist(), strict=True)
                  if i != own]
        out += [(own, i, -s) for s, i in sorted(scored)[:k]]
    return tuple(np.array([o[c] for o in out], dtype=object if c == 2 else np.int64) for c in range(3))


def _flat(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return _quantized(col if isinstance(col, pa.ChunkedArray) else pa.chunked_array([col]), dim)


def _assigned(x: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``x`` with the nearest pivot of each vector and its coarse statistics."""
    bc = x.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("__dim").to_numpy()
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                s = _statistics(_flat(part.column("__x"), int(dim)), COARSE)
                p = bc.value[int(dim)]
                near = np.empty(len(s), np.int32)
                for lo in range(0, len(s), 4096):
                    near[lo:lo + 4096] = ((p ** 2).sum(axis=1) - 2 * s[lo:lo + 4096] @ p.T).argmin(axis=1)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1) * s.shape[1], pa.int32()), pa.array(s.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near), flat], [*part.schema.names, "__c", "__s"])

    return x.mapInArrow(run, "__id long, __x array<double>, __dim int, __c int, __s array<double>")


def _envelopes(rows: DataFrame, block: str) -> DataFrame:
    """(__dim, block, __lo, __hi): least and greatest of each statistic, and the block's rows."""
    each = rows.select("__dim", block, F.posexplode("__s").alias("j", "v"))
    ends = each.groupBy("__dim", block, "j").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    ends = ends.groupBy("__dim", block).agg(F.array_sort(F.collect_list(F.struct("j", "lo", "hi"))).alias("e"),
                                            F.max("n").alias("__n"))
    return ends.select("__dim", block, F.col("e.lo").alias("__lo"), F.col("e.hi").alias("__hi"), "__n")


def _pairs(asked: DataFrame, blocks: DataFrame) -> DataFrame:
    """(__dim, __block, __part): blocks of rows whose envelope reaches what a block of queries has to beat."""
    envelopes = {}
    for r in blocks.collect():  # at most BLOCKS and the numbers of vector lengths
        envelopes.setdefault(r["__dim"], []).append((r["__part"], r["__lo"], r["__hi"]))
    packed = {d: (np.array([e[0] for e in v], np.int64), np.array([e[1] for e in v]), np.array([e[2] for e in v]))
              for d, v in envelopes.items()}
    bc = asked.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                parts, lo, hi = bc.value[r["__dim"]]
                q_lo, q_hi = np.array(r["__lo"]), np.array(r["__hi"])
                most = np.maximum.reduce([lo * q_lo, lo * q_hi, hi * q_lo, hi * q_hi]).sum(axis=1)
                slack = 1e-9 * (1.0 + np.abs(most)) * max(1, r["__dim"])
                hit = parts[most >= r["__beat"] - slack]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), r["__dim"]), pa.int32()),
                                                  pa.array(np.full(len(hit), r["__block"]), pa.int64()), pa.array(hit)],
                                                 ["__dim", "__block", "__part"])

    return asked.select("__dim", "__block", "__lo", "__hi", "__beat").mapInArrow(
        run, "__dim int, __block long, __part long")


def _meet(ask: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(__dim, query_id, cand_id, score): the k best of each query in each group (__dim, __block, __part, __sub)."""
    def group(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        kinds = pa.schema([("__dim", pa.int32())] + [(c, pa.int64()) for c in ("query_id", "cand_id", "score")])
        if not left.num_rows or not right.num_rows:
            return kinds.empty_table()
        got = block_top(_quantized(left["__x"], dim), left["__id"].to_numpy(), _quantized(right["__x"], dim),
                        right["__id"].to_numpy(), k, left["__beat"].to_numpy())
        return pa.table([pa.array(np.full(len(got[0]), dim), pa.int32()), *(pa.array(c, pa.int64()) for c in got)], schema=kinds)

    keys = ["__dim", "__block", "__part", "__sub"]
    return ask.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(
        group, "__dim int, query_id long, cand_id long, score long")


def search(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", k: int = 20,
           every: int = 20) -> DataFrame:
    """(query_id, rank, <id>, score) for the queries, rows whose id is divisible by ``every``."""
    x = df.select(F.col(id_col).cast("long").alias("__id"), F.col(vector).cast("array<double>").alias("__x"))
    limit = F.lit(float("inf"))
    x = x.where(F.col("__id").isNotNull() & (F.size("__x") > 0) &
                F.forall("__x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit)))
    square = F.aggregate("__x", F.lit(0.0), lambda s, v: s + F.pow(F.floor(F.least(F.abs(v), F.lit(1e15)) * SCALE) + 1, F.lit(2.0)))
    x = x.where(square < _LARGEST).withColumn("__dim", F.size("__x"))
    is_query = F.col("__id") % every == 0
    n = x.agg(F.count("*")).first()[0]
    if not n:
        return x.sparkSession.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")
    x = stored(_assigned(x, _pivots(x, n)), "vectors")
    # Blocks of rows: parts of a cluster, so many that none is much larger than its share.
    size = max(CANDIDATES, -(-n // BLOCKS))
    hashed = F.shiftrightunsigned(F.xxhash64("__id"), 1)
    in_cluster = stored(x.groupBy("__dim", "__c").agg(F.count("*").alias("__n"), F.count(F.when(is_query, 1)).alias("__q")),
                        "clusters")
    place = F.struct("__dim", "__c", "__i")
    x = x.join(F.broadcast(in_cluster), ["__dim", "__c"])  # at most PIVOTS rows a vector length
    x = x.withColumn("__i", hashed % F.ceil(F.col("__n") / size))
    rows = stored(x.withColumn("__part", F.xxhash64(place)).select("__dim", "__part", "__c", "__id", "__x", "__s"), "rows")
    ask = x.where(is_query).withColumn("__i", hashed % F.ceil(F.col("__q") / QUERIES))
    ask = stored(ask.withColumn("__block", F.xxhash64(place)).select("__dim", "__block", "__c", "__id", "__x", "__s"), "queries")
    blocks = stored(_envelopes(rows, "__part"), "blocks")
    # What to beat: the k-th best in one block of the query's own cluster.
    one = rows.groupBy("__dim", "__c").agg(F.min("__part").alias("__part"))
    near = rows.join(F.broadcast(one), ["__dim", "__c", "__part"])
    met = _dealt(ask.withColumn("__beat", F.lit(float("-inf"))).join(F.broadcast(one), ["__dim", "__c"]),
                 near.join(stored(ask.select("__dim", "__c", "__block").distinct(), "query-blocks"), ["__dim", "__c"]), blocks)
    order = Window.partitionBy("__dim", "query_id").orderBy(F.desc("score"), "cand_id")
    first = _meet(*met, k).withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= k)
    first = stored(first, "first")
    beat = first.where(F.col("__r") == k).select("__dim", F.col("query_id").alias("__id"), F.col("score").cast("double").alias("__beat"))
    ask = stored(ask.join(beat.dropDuplicates(["__dim", "__id"]), ["__dim", "__id"], "left").withColumn(
        "__beat", F.coalesce("__beat", F.lit(float("-inf")))), "asked")
    least = ask.groupBy("__dim", "__block").agg(F.min("__beat").alias("__beat"))
    pairs = _pairs(_envelopes(ask, "__block").join(least, ["__dim", "__block"]), blocks)
    pairs = stored(pairs, "pairs")
    met = _dealt(ask.join(pairs, ["__dim", "__block"]), rows.join(pairs, ["__dim", "__part"]), blocks)
    best = _meet(*met, k).drop("__dim")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "cand_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("cand_id").alias(id_col), "score")


def _pivots(x: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Statistics of some vectors of each length, those of lowest id hash: at most ``PIVOTS`` of each."""
    want = int(min(PIVOTS, max(1, n // CANDIDATES)))
    place = F.shiftrightunsigned(F.xxhash64("__id", F.lit(7)), 33)
    order = Window.partitionBy("__dim").orderBy(place, "__id")
    # Of a length with few vectors there may be none below the mark, so the least of each length is there too.
    upto = min(1.0, 4.0 * want / n) * (1 << 31)
    least = x.groupBy("__dim").agg(F.min_by("__x", F.struct(place, "__id")).alias("__x"))
    some = x.where(place < upto).withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= want).select("__dim", "__x")
    out: dict[int, list] = {}
    for r in some.union(least.select("__dim", "__x")).collect():
        out.setdefault(r["__dim"], []).append(np.floor(SCALE * np.array(r["__x"])))
    return {d: np.unique(_statistics(np.array(v), COARSE), axis=0) for d, v in out.items()}


def _dealt(ask: DataFrame, rows: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the groups; rows of a block that is larger than ``CANDIDATES`` are dealt to several of them."""
    parts = F.broadcast(blocks.select("__dim", "__part", F.ceil(F.col("__n") / (2 * CANDIDATES)).cast("int").alias("__subs")))
    left = ask.join(parts, ["__dim", "__part"]).withColumn("__sub", F.explode(F.sequence(F.lit(0), F.col("__subs") - 1)))
    right = rows.join(parts, ["__dim", "__part"]).withColumn(
        "__sub", F.pmod(F.xxhash64("__id", F.lit(3)), F.col("__subs")).cast("int"))
    names = ["__dim", "__block", "__part", "__sub", "__id", "__x"]
    return left.select(*names, "__beat"), right.select(*names)
