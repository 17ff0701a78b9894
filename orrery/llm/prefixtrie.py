"""Conversation prefix trie by van Emde Boas recursion over depth.

A node at depth d is a distinct sequence of the first d turns (role, text); conversations that start with it are its
members.  An interval of depths is cut in the middle: the upper half of every piece of a conversation is one problem,
named cut prefixes are the roots of the lower forests, and both halves are cut again.  Level by level, all problems of
a level at once:

1. *blocks*: digests of the aligned blocks of 2, 4, 8, ... turns of each conversation, from the digests of their halves;
2. *build*: from the whole depth down, each distinct piece (start, content) of a level yields its upper piece and, named
   by its cut prefix, its lower piece; equal pieces collapse with their numbers of members.  Pieces of one turn are nodes;
3. *graft*: from the smallest intervals up, the totals of the roots of each lower forest are summed by cut prefix and
   added to the root of the upper trie above it;
4. the sums grafted to a piece count for every node on it: from the top down they go to the halves of their pieces.

Pieces halve with every level, so all levels together hold about twice the rows of the turns, and there are about
log2(longest conversation) levels.  No conversation, node or group of copies is collected: all steps are equi-joins on
keys that are unique on one side at least, and partial aggregates; a conversation of any length is numbered by two-level
prefix sums.  The driver receives the least id, the number of conversations and the longest length.  The ids that end at
a node are hashed as a stream: chunks of at most 256 ids, in order.

Names are 128-bit hashes; two different prefixes share one with a chance of about n^2 / 2^129.  Texts are read once and
replaced by such names at once.

Turns are ordered by turn (null first), then role, then a hash of the turn, so rows that tie in all are equal turns.
Null role or text is empty; rows with a null conversation id belong to no conversation.  Repeated rows are turns of their
own.  An empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scan import row_number_within
from .common import forget, stored

#: The rebuilding of conversations: the first turns of one in so many are shared, at most ``SHARED_TURNS - 1`` of them.
SHARE, SHARED_TURNS = 5, 9
#: Bits of the ids that a chunk of one node's ends covers.
_CHUNK_BITS = 8
_OUT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")


def _name(*parts: Column) -> Column:
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def _root() -> Column:
    return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


def _digest(size: Column, *parts: Column) -> Column:
    """Name of a content, with its bytes."""
    return F.struct(*(F.xxhash64(F.lit(k), *parts).alias(c) for k, c in ((3, "a"), (4, "b"))), size.cast("long").alias("n"))


# ---------------------------------------------------------------- sequences

def sequences(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """(conv, pos, token): the turns of each conversation, numbered from 1; a token names role and text."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), said[0].alias("role"),
        _digest(F.octet_length(said[1]), *said).alias("token"))
    return row_number_within(rows, ["conv"], ["turn", "role", "token"], "pos").select("conv", "pos", "token")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations with shared beginnings, as (conv, pos, token), and the ids of all, as (conv).

    Conversation c begins with the first h turns of conversation c - c % 5 (h = crc32 of c's decimal form, mod 9),
    followed by its own turns after its first h.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED_TURNS
    ids = stored(turns.groupBy("conv").agg(F.max("pos").alias("len")), "conversations")
    base = (F.col("conv") - F.col("conv") % SHARE).alias("base")
    begin = ids.select("conv", h.alias("h"), base).where("h > 0")
    had = ids.select(F.col("conv").alias("base"), F.least("len", F.lit(SHARED_TURNS)).alias("has"))
    less = begin.join(had, "base", "left").select("conv", (F.col("h") - F.coalesce("has", F.lit(0))).alias("less"))
    own = turns.where(F.col("pos") > h).join(less.where("less > 0"), "conv", "left")
    own = own.select("conv", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("pos"), "token")
    shared = turns.where((F.col("conv") % SHARE == 0) & (F.col("pos") < SHARED_TURNS))
    given = begin.join(shared.withColumnRenamed("conv", "base"), "base").where("pos <= h").select("conv", "pos", "token")
    return own.union(given), ids.select("conv")


# ---------------------------------------------------------------- blocks

def _pairs(blocks: DataFrame) -> DataFrame:
    """(conv, i, l, r): the two halves of each block of the next level; ``r`` is null where the conversation ends before."""
    half = F.struct("d", "f", "t", "tail")
    right = F.col("i") % 2 == 1
    return blocks.groupBy("conv", F.shiftright("i", 1).alias("i")).agg(
        F.max(F.when(~right, half)).alias("l"), F.max(F.when(right, half)).alias("r"))


def _blocks(pairs: DataFrame) -> DataFrame:
    """(conv, i, d, f, t, tail): digest, first and last token of a block, and the blocks cut off before the last token."""
    alone = F.col("r").isNull()
    size = F.col("l.d.n") + F.coalesce("r.d.n", F.lit(0))
    return pairs.select("conv", "i", _digest(size, F.col("l.d"), F.col("r.d")).alias("d"), F.col("l.f").alias("f"),
                        F.when(alone, F.col("l.t")).otherwise(F.col("r.t")).alias("t"),
                        F.when(alone, F.col("l.tail")).otherwise(F.concat(F.array("l.d"), F.col("r.tail"))).alias("tail"))


def _last_node(start: Column, tail: Column, token: Column) -> Column:
    """Name of the node at the end of a block: its last piece of one turn."""
    before = F.aggregate(tail, start, lambda s, d: _name(s, d))
    return _name(before, token)


# ---------------------------------------------------------------- the recursion

def _halves(pieces: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pieces of the next level down: (i, s, e, n, head, end, up, w, c), one row for each half of a piece.

    s and e name the start and the piece, ``up`` the piece that it is a half of; w members, c the least of them.  An
    upper half with a lower one has the names of its first and last node, ``head`` and ``end``.
    """
    rows = pieces.join(pairs.withColumnRenamed("conv", "c"), ["c", "i"])
    cut = _name(F.col("s"), F.col("l.d"))
    both = F.col("r").isNotNull()
    none = F.lit(None).cast("struct<a:bigint,b:bigint>")
    rows = rows.select("i", "s", "e", "w", "c", "l", "r", cut.alias("cut"))
    upper = F.struct((F.col("i") * 2).alias("i"), F.col("s").alias("s"), F.col("cut").alias("e"), F.col("l.d.n").alias("n"),
                     F.when(both, _name(F.col("s"), F.col("l.f"))).alias("head"),
                     F.when(both, _last_node(F.col("s"), F.col("l.tail"), F.col("l.t"))).alias("end"))
    lower = F.struct((F.col("i") * 2 + 1).alias("i"), F.col("cut").alias("s"),
                     _name(F.col("cut"), F.col("r.d")).alias("e"), F.col("r.d.n").alias("n"), none.alias("head"),
                     none.alias("end"))
    halves = F.when(both, F.array(upper, lower)).otherwise(F.array(upper))
    return rows.select(F.explode(halves).alias("h"), F.col("e").alias("up"), "w", "c").select("h.*", "up", "w", "c")


def _collapsed(halves: DataFrame) -> DataFrame:
    return halves.groupBy("i", "s", "e").agg(F.sum("w").alias("w"), F.min("c").alias("c"), F.max("n").alias("n"))


def _hashes(ends: DataFrame) -> DataFrame:
    """(e, sha): SHA-256 of the ids of ``ends`` (e, conv) in ascending order, comma-joined, streamed through sorted chunks."""
    chunk = F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",")
    chunks = ends.groupBy("e", F.shiftright("conv", _CHUNK_BITS).alias("k")).agg(chunk.alias("ids"))
    chunks = chunks.repartition("e").sortWithinPartitions("e", "k").select("e.a", "e.b", "ids")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*rows), (pa.int64(), pa.int64(), pa.string()))], ["a", "b", "sha"])
        key, state, done = None, None, []
        for rows in batches:
            for a, b, ids in zip(*(rows.column(c).to_pylist() for c in range(3))):
                if key == (a, b):
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256(ids.encode())
            if done:
                yield batch(done)
                done = []
        if key is not None:
            yield batch([(*key, state.hexdigest())])

    return chunks.mapInArrow(run, "a long, b long, sha string").select(F.struct("a", "b").alias("e"), "sha")


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``turns`` (conv, pos, token; pos from 1); ``ids`` (conv) may have no turns."""
    spark = turns.sparkSession
    turns = stored(turns, "turns")
    n_all, least = ids.agg(F.count("*"), F.min("conv")).first()
    if not n_all:
        return spark.createDataFrame([], _OUT)
    longest = turns.agg(F.max("pos")).first()[0] or 0
    levels = (longest - 1).bit_length() if longest else 0

    # 1. blocks of 1, 2, 4, ... turns
    blocks = turns.select("conv", (F.col("pos") - 1).alias("i"), F.col("token").alias("d"), F.col("token").alias("f"),
                          F.col("token").alias("t"), F.array().cast("array<struct<a:bigint,b:bigint,n:bigint>>").alias("tail"))
    pairs = [None]
    for _ in range(levels):
        pairs.append(stored(_pairs(blocks), "pairs"))
        blocks = _blocks(pairs[-1])
    blocks = stored(blocks, "whole")

    # 2. pieces, from whole conversations down to single turns
    whole = blocks.groupBy("d").agg(F.count("*").alias("w"), F.min("conv").alias("c"))
    pieces = whole.select(F.lit(0).cast("long").alias("i"), _root().alias("s"), _name(_root(), F.col("d")).alias("e"), "w", "c",
                          F.col("d.n").alias("n"))
    halves = [None] * levels
    for j in reversed(range(levels)):
        halves[j] = stored(_halves(pieces, pairs[j + 1]), "halves")
        pieces = _collapsed(halves[j])
    pieces = stored(pieces, "pieces")
    cuts = [h.where("head is not null").select("e", "head", "end").distinct() for h in halves]

    # Children of a cut prefix, by the name of its node.
    named = cuts[0].select("e", "end") if levels else spark.createDataFrame([], pieces.select("e", F.col("e").alias("end")).schema)
    for c in cuts[1:]:
        named = named.union(c.select("e", "end"))
    named = stored(named.withColumnsRenamed({"e": "s", "end": "e"}), "cuts")
    kids = pieces.groupBy("s").agg(F.count("*").alias("k")).join(named, "s").select("e", "k")
    leaf, saved = F.when(F.col("k") == 0, 1).otherwise(0).cast("long"), (F.col("w") - 1) * F.col("n")
    nodes = pieces.join(kids, "e", "left").withColumn("k", F.coalesce("k", F.lit(0)))
    nodes = stored(nodes.select("e", "i", "s", "w", "c", "k", leaf.alias("leaves"), saved.alias("saved")), "nodes")

    # 3. graft totals upward
    def total(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    def added(df: DataFrame, more: DataFrame, key: str) -> DataFrame:
        more = more.select(F.col(key).alias("__e"), F.col("leaves").alias("__leaves"), F.col("saved").alias("__saved"))
        out = df.join(more, F.col("e") == F.col("__e"), "left").drop("__e")
        for c in ("leaves", "saved"):
            out = out.withColumn(c, F.col(c) + F.coalesce(f"__{c}", F.lit(0))).drop(f"__{c}")
        return out

    heads, grafts = nodes.select("e", "i", "s", "leaves", "saved"), []
    for j in range(levels):
        lower = F.shiftright("i", j) % 2 == 1
        forests = total(heads.where(lower), "s").withColumnRenamed("s", "e")
        grafts.append(stored(cuts[j].join(forests, "e").select("e", "head", "leaves", "saved"), "grafts"))
        heads, before = stored(added(heads.where(~lower), total(grafts[j], "head"), "head"), "heads"), heads
        if j:
            forget(before)

    # 4. and hand them down to the nodes of their pieces
    more = None
    for j in reversed(range(levels)):
        own = grafts[j].select("e", "leaves", "saved")
        if more is not None:
            own = own.union(halves[j].select("e", "up").join(more.withColumnRenamed("e", "up"), "up")
                            .select("e", "leaves", "saved"))
        more, before = stored(total(own, "e"), "handed"), more
        if before is not None:
            forget(before)
    totals = added(nodes, more, "e") if levels else nodes

    parents = named.join(nodes.select("e", F.col("c").alias("parent")), "e").select("s", "parent")
    parents = parents.union(spark.range(1).select(_root().alias("s"), F.lit(least).cast("long").alias("parent")))
    last = blocks.select("conv", _last_node(_root(), F.col("tail"), F.col("t")).alias("e"))
    none = ids.join(last.select("conv"), "conv", "left_anti").select("conv", _root().alias("e"))
    sha = stored(_hashes(last.union(none.select("conv", "e"))), "ends")
    top = heads.agg(F.count("*").alias("k"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).select(
        _root().alias("e"), F.lit(least).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(n_all).cast("long").alias("n_convs"), "k",
        F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"))
    rows = totals.join(parents, "s").select("e", F.col("c").alias("conv_id"), (F.col("i") + 1).alias("depth"),
                                            F.col("parent").alias("parent_conv_id"), F.col("w").alias("n_convs"), "k",
                                            "leaves", "saved")
    out = rows.union(top).join(sha, "e", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("k").alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """The trie of the conversations as they are."""
    turns = stored(sequences(conversations, conv, turn, role, text), "turns")
    return trie(turns, turns.select("conv").distinct())


def shared_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuilt(stored(sequences(conversations, conv, turn, role, text), "turns")))
