"""Secret scan with multipart credential linking.

Strong parts stand for themselves: keyword assignments, access identifiers
with their prefix, and long hex strings.  Weak parts are reported only in
company: an unprefixed identifier, a mixed string, an endpoint, the first two
of 16 characters or more and an entropy that words do not have.  The scope of a
weak part is ``SCOPE`` code points before and after it.  It is linked when its
scope holds parts of both other roles, strong or weak, apart from one another;
an identifier is complemented by secrets and endpoints, and so on.  A single
strong part of one other role completes it too if it is plainly random itself
(three digits and three letters), as there is less company to go by.

Parts of one role do not overlap, so the interval join is four binary searches
on their sorted bounds for each weak part.  All parts of a scope lie in one
text, so nothing is shuffled.  A text is searched in full only if its bytes
hold a keyword, the prefix, a long hex run, or an endpoint and a long run.

Null and empty texts have no spans; repeated rows and null ids are kept.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import raw, text_pass

SCOPE = 300
ENTROPY = 3.5

#: Fixed patterns of the base kinds, with the least length of what they take.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
BASE = ("assign", "access", "hex")

WEAK = {
    "weak_access": re.compile(r"(?<![A-Za-z0-9])[A-Z0-9]{16,}(?![A-Za-z0-9])"),
    "weak_secret": re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{16,}={0,2}(?![A-Za-z0-9+/=])"),
    "endpoint": re.compile(r"https?://[^\s\"'<>]+"),
}
ROLE = {"assign": "secret", "hex": "secret", "weak_secret": "secret", "access": "access", "weak_access": "access",
        "endpoint": "endpoint"}
KINDS = (*BASE, *WEAK)
_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Strong parts: each kind leftmost and without overlaps, too short ones dropped afterwards."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]{%d,}" % LEAST["hex"], text)]
    return out


#: Capitals and digits alone are an identifier; from this length on they may be a secret as well.
BOTH = 33


def _entropy(word: str) -> bool:
    n = len(word)
    return -sum(c / n * math.log2(c / n) for c in Counter(word).values()) >= ENTROPY - (n < 24)


def _mixed(word: str) -> bool:
    """Digits and letters, or small letters before a capital: not the spelling of a word."""
    if any(c.isdigit() for c in word):
        return any(c.isalpha() for c in word)
    return any(a.islower() and b.isupper() for a, b in zip(word, word[1:]))


def _random(word: str) -> bool:
    return sum(c.isdigit() for c in word) >= 3 and sum(c.isalpha() for c in word) >= 3


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Weak parts that do not share a place with a strong one."""
    taken = _Parts((s, e) for _, s, e in base)
    out = []
    for kind, rule in WEAK.items():
        for m in rule.finditer(text):
            word = m[0]
            if kind != "endpoint" and not (_mixed(word) and _entropy(word)):
                continue
            if kind == "weak_secret" and len(word) < BOTH and WEAK["weak_access"].fullmatch(word):
                continue
            if not taken.within(*m.span()):
                out.append((kind, *m.span()))
    return out


class _Parts:
    """Spans of one role, none inside another, in order."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts, self.ends = [], []
        for s, e in sorted(spans):
            if not self.ends or e > self.ends[-1]:
                self.starts.append(s)
                self.ends.append(e)

    def within(self, lo: int, hi: int) -> bool:
        """Whether one shares a place with [lo, hi)."""
        return bisect_right(self.ends, lo) < bisect_left(self.starts, hi)

    def beside(self, lo: int, hi: int, s: int, e: int) -> tuple[int, int] | None:
        """Of those that share a place with [lo, hi) but none with [s, e): the first end and the last start."""
        a, b = bisect_right(self.ends, lo), bisect_left(self.starts, hi)
        p, q = min(max(bisect_right(self.ends, s), a), b), min(max(bisect_left(self.starts, e), a), b)
        if a == p and q >= b:
            return None
        return self.ends[a if a < p else q], self.starts[b - 1 if q < b else p - 1]


def linked_spans(text: str, base: list[Span], scope: int = SCOPE) -> list[Span]:
    """The weak parts whose scope completes them."""
    weak = candidates(text, base)
    if not weak:
        return []
    roles = ("access", "secret", "endpoint")
    strong = {r: _Parts((s, e) for k, s, e in base if ROLE[k] == r) for r in roles}
    every = {r: _Parts((s, e) for k, s, e in [*base, *weak] if ROLE[k] == r) for r in roles}
    out = []
    for kind, s, e in weak:
        one, two = (r for r in roles if r != ROLE[kind])
        lo, hi = s - scope, e + scope
        near = every[one].beside(lo, hi, s, e), every[two].beside(lo, hi, s, e)
        # Two of different roles lie apart if one of them can end before the other starts.
        if all(near) and (near[0][0] <= near[1][1] or near[1][0] <= near[0][1]):
            out.append((kind, s, e))
        elif (kind == "endpoint" or _random(text[s:e])) and (strong[one].within(lo, hi) or strong[two].within(lo, hi)):
            out.append((kind, s, e))
    return out


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def _runs(member: np.ndarray, offs: np.ndarray, least: int) -> np.ndarray:
    """Texts that hold a run of so many bytes of a class."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], member.view(np.int8), [0]])))
    begin, end = edge[::2], edge[1::2]
    # a run may cross into the next text, which is then searched in vain
    begin, end = begin[end - begin >= least], end[end - begin >= least]
    hit = np.zeros(len(offs), bool)
    first, last = np.searchsorted(offs, begin, "right") - 1, np.searchsorted(offs, end - 1, "right") - 1
    for a, b in zip(first, last, strict=True):
        hit[a:b + 1] = True
    return hit[:-1]


_IS_HEX = np.zeros(256, bool)
_IS_HEX[list(b"0123456789abcdef")] = True
_IS_MIXED = np.zeros(256, bool)
_IS_MIXED[[*range(48, 58), *range(65, 91), *range(97, 123), 43, 47]] = True


def scan(df: DataFrame, text: str = "text", id_col: str = "doc_id", scope: int = SCOPE) -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_linked, base_sha256, spans): one row for each row of ``df``."""
    def run(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        data, offs = raw(texts)
        search = _runs(_IS_HEX[data], offs, LEAST["hex"])
        long = _runs(_IS_MIXED[data], offs, 16)
        whole = data.tobytes()
        lower = whole.lower()
        found = []
        for i in range(len(texts)):
            lo, hi = int(offs[i]), int(offs[i + 1])
            if not (search[i] or long[i] and lower.find(b"://", lo, hi) >= 0 or lower.find(b"akia", lo, hi) >= 0 or any(lower.find(k, lo, hi) >= 0 for k in _KEYS)):
                found.append(((), ()))
                continue
            own = whole[lo:hi].decode()
            base = base_spans(own)
            found.append((base, linked_spans(own, base, scope)))
        counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in BASE]
        return pa.RecordBatch.from_arrays(
            [rows.column(rows.schema.get_field_index(id_col)), *counts, pa.array([len(x) for _, x in found], pa.int64()),
             pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found], pa.string()),
             pa.array([written([*base, *more]) for base, more in found], pa.string())],
            [id_col, "n_assign", "n_access", "n_hex", "n_linked", "base_sha256", "spans"])

    return text_pass(df.select(id_col, text), run, f"`{id_col}` {dict(df.dtypes)[id_col]}, n_assign long, n_access long, "
                     "n_hex long, n_linked long, base_sha256 string, spans string", text)
