"""Counts of whole texts, for the quality classifier and the quality rules."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import _ODD, Words, hash_spans, mix


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _table(b"#*$%&|<>")
_UPPER = _table(bytes(range(65, 91)))
_LOWER = _table(bytes(range(97, 123)))
_DIGIT = _table(b"0123456789")
_STOP = _table(b".?")


class TextStats:
    """Counts per text, as arrays; words are ``[^\\x20\\x09-\\x0D]+``, lines are split at \\n."""

    def __init__(self, texts: pa.Array):
        w = Words(texts)
        data, n = w.data, len(w.offs) - 1
        lead = (data & 0xC0) != 0x80
        self.n_words = w.counts
        self.word_chars = w.per_text(lead & w.is_word)
        self.n_symbols = w.per_text(_SYMBOL[data])
        self.n_upper = w.per_text(_UPPER[data])
        self.n_lower = w.per_text(_LOWER[data])
        self.n_digits = w.per_text(_DIGIT[data])
        self.n_stops = w.per_text(_STOP[data])
        self.n_bangs = w.per_text(data == 0x21)
        self.n_wide = w.per_text(lead & (data >= 0xC0))
        self.n_bars = np.bincount(w.owner[(w.lens == 1) & (data[w.starts] == 0x7C)], minlength=n)
        self.n_distinct = self._distinct(mix(w.hashes + w.owner.astype(np.uint64) * _ODD), w.owner, n)
        self.n_repeat_words = self._repeats(w, n)
        self.n_lines, self.n_dup_lines = self._lines(w, n)

    @staticmethod
    def _distinct(keys, owner, n):
        _, first = np.unique(keys, return_index=True)
        return np.bincount(owner[first], minlength=n)

    @staticmethod
    def _repeats(w, n):
        """Words inside a 3-word window that its text has twice or more."""
        hashes, owner = w.windows(3), w.owner
        own = np.flatnonzero(owner[:len(hashes)] == owner[2:]) if len(hashes) else np.empty(0, np.int64)
        keys = mix(hashes[own] + owner[own].astype(np.uint64) * _ODD)
        _, back, count = np.unique(keys, return_inverse=True, return_counts=True)
        at = own[count[back] > 1]
        inside = np.zeros(len(owner), bool)
        for i in range(3):
            inside[at + i] = True
        return np.bincount(owner[inside], minlength=n)

    @staticmethod
    def _lines(w, n):
        """Lines that hold a word, and how many of them equal an earlier one of their text."""
        data, offs = w.data, w.offs
        breaks = np.flatnonzero(data == 0x0A)
        begin = np.union1d(breaks + 1, offs[:-1][np.diff(offs) > 0])
        begin = begin[begin < len(data)]
        end = np.minimum(np.append(begin[1:], len(data)), len(data))
        end = end - ((end > begin) & (data[end - 1] == 0x0A))
        has = np.searchsorted(w.starts, end) > np.searchsorted(w.starts, begin)
        begin, end = begin[has], end[has]
        owner = np.searchsorted(offs, begin, "right") - 1
        keys = mix(hash_spans(data, begin, end - begin) + owner.astype(np.uint64) * _ODD)
        lines = np.bincount(owner, minlength=n)
        return lines, lines - TextStats._distinct(keys, owner, n)
