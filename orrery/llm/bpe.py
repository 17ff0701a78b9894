"""Byte-level BPE encoding and decoding.

Lookup has two tiers.  A minimal perfect hash (hash, displace, compress) over
the vocabulary resolves every pre-token that is itself a vocabulary entry.
The rest is merged by a heap of adjacent pairs over doubly linked bytes.

Work is done on distinct pre-tokens of a slice of texts, not on occurrences:
pre-tokens are cut from the bytes with numpy, grouped by a 64-bit hash,
looked up once, and the ids are gathered back.  The decoded bytes of every
slice are compared with its input; should two different pre-tokens ever share
a hash, the slice is redone without grouping, so results are exact.

No shuffle; what is broadcast is bounded by the vocabulary.  A null or empty
text has no ids.  Repeated rows and null ids are kept, other columns ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import _ODD, hash_spans, mix, raw, text_pass

#: Cut of text before the merges; fixed value of the public vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Merged pre-tokens that a worker keeps: so many of the latest, and as many before them.
CACHE_ENTRIES = 150_000
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the bytes, a space, the id, on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


# ---------------------------------------------------------------- minimal perfect hash

class PerfectHash:
    """Maps each of n distinct 64-bit keys to its own slot in [0, n); other keys go to any slot.

    Keys fall into n / 4 buckets.  Largest bucket first, a displacement is
    searched that sends all keys of the bucket to free slots; buckets of one
    key then take the slots left over, stored as -1 - slot.
    """

    def __init__(self, keys: np.ndarray):
        self.n = n = len(keys)
        self.buckets = max(1, n // 4)
        self.shift = np.zeros(self.buckets, np.int64)
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        free = np.ones(n, bool)
        tries = np.arange(64, dtype=np.uint64)
        for b in np.argsort(-sizes, kind="stable"):
            own = keys[order[ends[b] - sizes[b]:ends[b]]]
            if len(own) < 2:
                break
            for base in range(0, 1 << 24, 64):
                slots = np.sort(self._slot(own[:, None], tries + np.uint64(base)), axis=0)
                good = free[slots].all(axis=0) & (np.diff(slots, axis=0) > 0).all(axis=0)
                if good.any():
                    k = int(good.argmax())
                    self.shift[b] = base + k
                    free[slots[:, k]] = False
                    break
            else:
                raise ValueError("keys are not distinct")
        single = np.flatnonzero(sizes == 1)
        self.shift[single] = -1 - np.flatnonzero(free)[:len(single)]

    def _bucket(self, keys):
        return ((keys >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    def _slot(self, keys, shift):
        return (mix(keys + shift * _ODD) % np.uint64(self.n)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.zeros(len(keys), np.int64)
        shift = self.shift[self._bucket(keys)]
        return np.where(shift < 0, -1 - shift, self._slot(keys, np.maximum(shift, 0).astype(np.uint64)))


class Vocabulary:
    """Ranks with their perfect hash; plain arrays and one dict, so that it can be broadcast."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        joins = [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.byte_join = np.array(joins, np.int64)
        self.known = known_pairs(ranks)
        words = list(ranks)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        keys = hash_spans(np.frombuffer(b"".join(words), np.uint8), np.cumsum(lens) - lens, lens)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two vocabulary entries share a 64-bit hash")
        self.hash = PerfectHash(keys)
        slots = self.hash.slots(keys)
        self.slot_key = np.zeros(len(words), np.uint64)
        self.slot_id = np.zeros(len(words), np.int64)
        self.slot_key[slots] = keys
        self.slot_id[slots] = list(ranks.values())
        top = max(ranks.values(), default=-1) + 1
        by_id = [b""] * top
        for w, i in ranks.items():
            by_id[i] = w
        self.id_len = np.fromiter(map(len, by_id), np.int64, top)
        self.id_start = np.cumsum(self.id_len) - self.id_len
        self.id_bytes = np.frombuffer(b"".join(by_id), np.uint8)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Id of each key that is a vocabulary entry, else -1."""
        if not len(self.slot_key):
            return np.full(len(keys), -1, np.int64)
        slots = self.hash.slots(keys)
        return np.where(self.slot_key[slots] == keys, self.slot_id[slots], -1)

    def exact(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """As ``lookup``, comparing the bytes themselves."""
        found = self.lookup(hash_spans(data, starts, lens))
        for k in np.flatnonzero(found >= 0):
            if data[starts[k]:starts[k] + lens[k]].tobytes() != self.decode(found[k:k + 1]).tobytes():
                found[k] = -1
        return found

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a sequence of ids."""
        return self.id_bytes[_spread(self.id_start[ids], self.id_len[ids])]


def _spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, ... of every span, one span after the other."""
    return np.arange(int(lens.sum())) + np.repeat(starts - (np.cumsum(lens) - lens), lens)


def known_pairs(ranks: dict[bytes, int]) -> dict[int, int]:
    """Id of the join of two ids, by ``left << 32 | right``, for every cut of an entry into two entries."""
    get = ranks.get
    out = {}
    for word, i in ranks.items():
        for cut in range(1, len(word)):
            left = get(word[:cut])
            if left is not None:
                right = get(word[cut:])
                if right is not None:
                    out[left << 32 | right] = i
    return out


#: Above every heap entry: a pair that has no join.
_NONE = 1 << 62


def merge(part: list[int], heap: list[int], known: dict[int, int]) -> list[int]:
    """Ids of one pre-token from the ids of its bytes: the adjacent pair whose join has the lowest id, leftmost
    first, is joined until none is known.  A heap holds the pairs, two lists link the parts that are left.

    ``heap`` has ``join << 32 | place`` of the pair that begins at each place, ``_NONE`` where there is no join.
    """
    n, get = len(part), known.get
    live = heap[:]
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        top = pop(heap)
        if top == _NONE:
            break
        i = top & 0xFFFFFFFF
        if live[i] != top:
            continue  # its left or right part has been joined with another since
        j = after[i]
        k = after[i] = after[j]
        r = part[i] = top >> 32
        part[j] = -1
        live[j] = live[i] = _NONE
        if k < n:
            before[k] = i
            s = get(r << 32 | part[k])
            if s is not None:
                live[i] = s = s << 32 | i
                push(heap, s)
        k = before[i]
        if k >= 0:
            s = get(part[k] << 32 | r)
            if s is None:
                live[k] = _NONE
            else:
                live[k] = s = s << 32 | k
                push(heap, s)
    return [p for p in part if p >= 0]


# ---------------------------------------------------------------- pre-tokens

@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point, from the same properties that the pattern names."""
    out = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, prop in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(prop, every):
            out[ord(m[0][0]):ord(m[0][-1]) + 1] = kind
    out[0xD800:0xE000] = _OTHER
    return out


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and code point of every character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    b = data[at].astype(np.int32)
    wide = np.flatnonzero(b >= 0xC0)
    if len(wide):
        x, p = b[wide], at[wide]
        pad = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
        c1, c2, c3 = (pad[p + i] & 0x3F for i in (1, 2, 3))
        b[wide] = np.where(x < 0xE0, (x & 0x1F) << 6 | c1,
                           np.where(x < 0xF0, (x & 0x0F) << 12 | c1 << 6 | c2, (x & 7) << 18 | c1 << 12 | c2 << 6 | c3))
    return at, b


def pretokens(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Byte starts of the matches of ``PATTERN`` in texts that lie one after the other, ``offs`` between them.

    Matches are the runs of one character class, but for three rules: the last
    white space before another character leaves its run, and a plain space
    then opens that character's match; an apostrophe that opens a match takes
    s, t, m, d, re, ve or ll after it.
    """
    at, cp = _code_points(data)
    n = len(cp)
    if not n:
        return np.empty(0, np.int64)
    kind = _classes()[cp]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[np.searchsorted(at, offs)] = True
    edge[n] = True
    run = np.ones(n + 1, bool)
    run[1:n] = kind[1:] != kind[:-1]
    run |= edge
    start = run.copy()
    last = np.flatnonzero((kind == _SPACE) & run[1:] & ~edge[1:])  # last white space before another character
    start[last] = True
    start[last[cp[last] == 0x20] + 1] = False
    quote = np.flatnonzero((cp == 0x27) & start[:n] & run[1:] & ~edge[1:])
    quote = quote[kind[quote + 1] == _LETTER]
    if len(quote):
        after = np.concatenate([cp, [0, 0, 0]])
        a, b = after[quote + 1], after[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
        two &= ~run[np.minimum(quote + 2, n)]
        taken = one | two
        quote, size = quote[taken], np.where(two[taken], 2, 1)
        start[quote + 1] = False
        start[quote + 1 + size] = True
    return at[start[:n]]


# ---------------------------------------------------------------- a slice of texts

class Encoder:
    """Encodes slices of texts in a worker; keeps merged pre-tokens, up to ``CACHE_ENTRIES``."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.new, self.old = vocabulary, {}, {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the n + 1 offsets between them, and the decoded bytes."""
        data, offs = raw(texts)
        starts = pretokens(data, offs)
        lens = np.diff(np.append(starts, len(data)))
        keys = hash_spans(data, starts, lens)
        first = np.searchsorted(starts, offs)
        for group in (True, False):
            if group:
                _, pick, back = np.unique(keys, return_index=True, return_inverse=True)
            else:
                pick = back = np.arange(len(keys))
            flat, size = self._distinct(data, starts[pick], lens[pick], keys[pick], group)
            begin = np.cumsum(size) - size
            counts = size[back]
            ids = flat[_spread(begin[back], counts)]
            decoded = self.v.decode(ids)
            if np.array_equal(decoded, data):
                break
        else:
            raise ValueError("decoding does not give the text back")
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, total[first], decoded

    def _merged(self, words: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as unsigned 32-bit integers; the first pairs of all are looked up at once."""
        v = self.v
        data = np.frombuffer(b"".join(words), np.uint8)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        ids = v.byte_id[data]
        if len(ids) and ids.min() < 0:
            raise ValueError("the vocabulary lacks single bytes that a text holds")
        ends = np.cumsum(lens)
        heap = np.full(len(data), _NONE, np.int64)
        join = v.byte_join[data[:-1].astype(np.int64) << 8 | data[1:]]
        known = np.flatnonzero(join >= 0)
        place = np.arange(len(data)) - np.repeat(ends - lens, lens)
        heap[known] = join[known] << 32 | place[known]
        heap[ends - 1] = _NONE
        ids, heap, out, lo = ids.tolist(), heap.tolist(), [], 0
        for hi in ends.tolist():
            out.append(array("I", merge(ids[lo:hi], heap[lo:hi], v.known)).tobytes())
            lo = hi
        return out

    def _distinct(self, data, starts, lens, keys, perfect):
        found = self.v.lookup(keys) if perfect else self.v.exact(data, starts, lens)
        misses = np.flatnonzero(found < 0)
        size = np.ones(len(keys), np.int64)
        buf, new, old = data.tobytes(), self.new, self.old
        words = [buf[s:e] for s, e in zip(starts[misses].tolist(), (starts + lens)[misses].tolist(), strict=True)]
        parts = [new.get(w) or old.get(w) for w in words]
        lacking = [k for k, got in enumerate(parts) if got is None]
        for k, got in zip(lacking, self._merged([words[k] for k in lacking]) if lacking else (), strict=True):
            parts[k] = got
        if len(new) + len(words) > CACHE_ENTRIES:
            self.new, self.old = new, old = {}, new
        new.update(zip(words, parts, strict=True))
        size[misses] = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.empty(int(size.sum()), np.int64)
        begin = np.cumsum(size) - size
        hits = found >= 0
        flat[begin[hits]] = found[hits]
        flat[_spread(begin[misses], size[misses])] = np.frombuffer(b"".join(parts), np.uint32)
        return flat, size


_WORKER: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder for each worker and vocabulary, as a worker runs many tasks."""
    key = f"{shared.value[0]}"
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(shared.value[1])
    return _WORKER[key]


def encode(df: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", ids: bool = True) -> DataFrame:
    """Ids of every text: (id, n_tokens, ids_sha256, decoded_sha256[, ids]).

    ``path`` is a rank file, read once by the driver.  The digests are of the
    ids as little-endian unsigned 32-bit integers, and of the bytes that they
    decode to; ``ids=False`` leaves the id lists out.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((path, Vocabulary(load_ranks(path))))
    kind = dict(df.dtypes)[id_col]

    def run(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        got, offs, decoded = _encoder(shared)(texts)
        small = got.astype("<u4")
        _, bytes_at = raw(texts)
        cols = [rows.column(rows.schema.get_field_index(id_col)), pa.array(np.diff(offs)),
                pa.array([hashlib.sha256(small[a:b]).hexdigest() for a, b in zip(offs[:-1], offs[1:], strict=True)],
                         pa.string()),
                pa.array([hashlib.sha256(decoded[a:b]).hexdigest()
                          for a, b in zip(bytes_at[:-1], bytes_at[1:], strict=True)], pa.string())]
        names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
        if ids:
            cols.append(pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(got, pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(cols, names)

    return text_pass(df.select(id_col, text), run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, "
                     "decoded_sha256 string" + ", ids array<int>" * ids, text)


def decode(df: DataFrame, path: str, ids: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """Bytes of every list of ids: (id, decoded binary); a null list gives no bytes, an unknown id fails."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((path, Vocabulary(load_ranks(path))))
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        for batch in batches:
            v = shared.value[1]
            out = []
            for row in batch.column(1):
                own = np.asarray(row.as_py() or [], np.int64)
                if len(own) and (own.min() < 0 or own.max() >= len(v.id_len) or (v.id_len[own] == 0).any()):
                    raise ValueError("an id is not in the vocabulary")
                out.append(v.decode(own).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [id_col, "decoded"])

    return df.select(id_col, ids).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


