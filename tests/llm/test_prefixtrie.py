"""Tries against plain dictionaries of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from orrery.llm import prefixtrie
from orrery.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5 if c >= 0 else c + -c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        seq = tuple(convs[c])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items()), key=str)


def got(df):
    assert df.columns == COLUMNS and {t for c, t in df.dtypes if c != "ends_sha256"} == {"bigint"}
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_prefixtrie"](spark, SF)) == brute(rebuilt(conversations(rows)))


def random_rows(seed, n, longest, words):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice("ab"), rnd.choice(words)) for c in rnd.sample(range(-20, 4 * n), n)
            for t in range(rnd.choice((1, 2, longest)))]


def test_random_conversations(spark):
    rows = random_rows(1, 60, 20, ["x", "yé", ""])
    assert got(prefixtrie.shared_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rebuilt(conversations(rows)))


def test_copies_and_a_long_conversation(spark):
    rows = [(c, t, "u", f"text {t}") for c in range(1000, 1400) for t in range(5)]        # one hot path
    rows += [(7, t, "u", f"text {t % 5 if t < 5 else t}") for t in range(133)]            # longer than all others
    rows += [(c, 0, "u", "text 0") for c in range(20)] + [(2000 + c, 0, "u", f"only {c}") for c in range(50)]
    assert got(prefixtrie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(conversations(rows))


def test_single_turns_and_a_single_conversation(spark):
    for rows in ([(5, 1, "u", "x"), (9, None, None, None), (6, 3, "u", "x")], [(3, 0, "u", "x")]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert got(prefixtrie.prefix_trie(df)) == brute(conversations(rows))
        assert got(prefixtrie.shared_trie(df)) == brute(rebuilt(conversations(rows)))


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [(1, None, "u", "x"), (1, 0, None, None), (1, 0, None, None), (1, 0, "u", None), (2, None, "u", "x"),
            (2, 5, "", ""), (None, 0, "u", "x"), (3, 1, "u", "long " * 50_000), (4, 1, "u", "long " * 50_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as conv", "2 as pos", "'x' as token", "3 as e", "4 as i")
    assert got(prefixtrie.prefix_trie(df)) == brute(conversations(rows))
    assert got(prefixtrie.prefix_trie(df.where("false"))) == []
    assert got(prefixtrie.shared_trie(df.where("conv_id is null"))) == []
