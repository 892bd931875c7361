"""Lines, words and repeats of a run of texts, as arrays (see ``common``)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import (WHITESPACE, byte_class, covered, flat, mix, span_hashes, spans, window_hashes, _powers)

REPEAT_WINDOW = 8
_WORD = byte_class(WHITESPACE)
SYMBOLS = byte_class(bytes(set(range(256)) - set(b"#*$%&|<>")))


class Lines:
    """``off``: first byte of each text; ``starts/ends``: words; ``wb``: first
    word of each text; ``ls/le``: lines (without line feed); ``lb``: first line
    of each text; ``lw``: first word of each line (one more entry)."""

    def __init__(self, run: pa.Array):
        self.data, self.off = flat(run, "\n")
        self.n = len(run)
        self.is_word = _WORD[self.data]
        self.starts, self.ends = spans(self.is_word)
        self.wb = np.searchsorted(self.starts, self.off)
        self.le = np.flatnonzero(self.data == 10)
        self.ls = np.concatenate(([0], self.le[:-1] + 1)) if len(self.le) else self.le
        self.lb = np.searchsorted(self.ls, self.off)
        self.lw = np.searchsorted(self.starts, np.concatenate((self.ls, self.off[-1:])))
        self.line_text = np.repeat(np.arange(self.n), np.diff(self.lb))
        self.word_text = np.repeat(np.arange(self.n), np.diff(self.wb))
        self.line_words = np.diff(self.lw)
        self.hash = span_hashes(self.data, self.starts, self.ends)

    def repeated_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their text."""
        h = span_hashes(self.data, self.ls, self.le) ^ mix(self.line_text.astype(np.uint64))
        h = h[self.line_words > 0]
        order = np.argsort(h, kind="stable")
        again = np.zeros(len(h), bool)
        again[order[1:]] = h[order[1:]] == h[order[:-1]]
        out = np.zeros(len(self.ls), bool)
        out[self.line_words > 0] = again
        return out

    def repeated_words(self) -> np.ndarray:
        """Words in windows of eight words found twice or more in their text."""
        n, k = len(self.hash), REPEAT_WINDOW
        h = window_hashes(self.hash, k)
        if not len(h):
            return np.zeros(n, bool)
        at = np.flatnonzero(self.word_text[: len(h)] == self.word_text[k - 1:])
        h = h[at] ^ mix(self.word_text[at].astype(np.uint64))
        s = np.sort(h)
        twice = np.unique(s[1:][s[1:] == s[:-1]])
        if not len(twice):
            return np.zeros(n, bool)
        found = twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h
        return covered(at[found], k, n)

    def normal_lines(self) -> np.ndarray:
        """Hash of each line's words, A-Z lower-cased, blanks between them alike."""
        w = span_hashes(self.data, self.starts, self.ends, fold_case=True)
        up, down = _powers(len(w) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(w * up[: len(w)], dtype=np.uint64)))
        a, b = self.lw[:-1], self.lw[1:]
        return mix((total[b] - total[a]) * down[a])
