"""Token ids of whole texts from a public tokenizer file.

Byte-pair encoders cut a text into words before any merge, so the ids of a text
are the ids of its words in order.  ``TextEncoder`` therefore encodes a distinct
word once (``tokenizers`` does the encoding) and looks it up after that: Arrow
cuts a block of texts and finds its distinct words, Python sees each of them once a
block.  Texts are told apart by how they can be cut:

* plain: at spaces and line feeds and before a full stop or comma, as each of
  these follows a letter or digit that stays one in the tokenizer's normal form;
* by pattern: at blanks, and before ``.,!`` only after A-Z;
* whole: those that quote an added token of the file (one id), and, where blanks
  belong to words, those with blanks beside space and line feed.

``tests/llm`` holds it against direct encoding of whole texts by the file's own
settings.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: how a text is cut into independently encodable pieces
BYTE_LEVEL = "byte_level"  # a piece keeps the blanks before it
WORD_END = "word_end"  # the tokenizer drops blanks and case

# between a letter and one of .,! there is always a cut
_WITH_BLANKS = re.compile(r"[ \n]*(?:[^ \n]*[A-Za-z](?=[.,!])|[^ \n]+)|[ \n]+")
_WITHOUT_BLANKS = re.compile(r"[^ \n]*[A-Za-z](?=[.,!])|[^ \n]+")

# A word of the table stands for itself with a blank before it, or without
# one if it begins with this mark, or as it is if it begins with a line feed
_AS_IT_IS = "\x01"


def _ranges(points: list[int]) -> str:
    """A pattern class of code points."""
    out, i = [], 0
    while i < len(points):
        j = i
        while j + 1 < len(points) and points[j + 1] == points[j] + 1:
            j += 1
        out.append(f"\\x{{{points[i]:x}}}-\\x{{{points[j]:x}}}")
        i = j + 1
    return "".join(out)


def _steady(c: str) -> bool:
    """A letter or digit that lower-casing and composition leave one letter or digit."""
    low = unicodedata.normalize("NFC", c.lower())
    return unicodedata.category(c)[0] in "LN" and len(low) == 1 and unicodedata.category(low)[0] in "LN"


_TAIL = _ranges([p for p in range(0x250) if _steady(chr(p))] + [p for p in range(0x370, 0x530) if _steady(chr(p))])
_SPACES = _ranges([p for p in range(0x10000) if chr(p).isspace() and chr(p) not in " \n"])
_BY_PATTERN = {WORD_END: f"(?:^|[^{_TAIL}])[.,]", BYTE_LEVEL: f"(?:^|[^{_TAIL}])[.,]|  |\n\n| \n|\n |\x01"}
_BATCH = 64


def _literal(word: str) -> str:
    return word[1:] if word[:1] == _AS_IT_IS else word if word[:1] == "\n" else " " + word


def _strings(words: pa.Array) -> list[str]:
    """Words without spaces as Python strings: one long string, cut (several times
    faster than one by one)."""
    if not len(words):
        return []
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words)
    return pc.binary_join(whole, pa.scalar(" ", words.type))[0].as_py().split(" ")


class TextEncoder:
    """Ids of texts as ``uint32`` arrays.  When the table of known words reaches
    ``table_words`` it keeps the more used half (only speed depends on it)."""

    def __init__(self, path: str, cut: str, table_words: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.cut, self.table_words = cut, table_words
        self.added = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)  # ids of all known words
        self.ends = np.zeros(1, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _direct(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]):
        texts = words if self.cut == WORD_END else list(map(_literal, words))
        if self.added:
            # an added token cuts a text before anything else: many words in one text, told apart by its id
            mark, mark_id = next(iter(self.added.items()))
            joined = [mark.join([*texts[i:i + _BATCH], ""]) for i in range(0, len(texts), _BATCH)]
            ids = np.fromiter(chain.from_iterable(self._direct(joined)), np.uint32)
            at = np.flatnonzero(ids == mark_id)
            lens = np.diff(at, prepend=-1) - 1
            ids = np.delete(ids, at)
        else:
            got = self._direct(texts)
            lens = np.fromiter(map(len, got), np.int64, len(got))
            ids = np.fromiter(chain.from_iterable(got), np.uint32, int(lens.sum()))
        size, more = int(self.ends[-1]), len(ids)
        if size + more > len(self.flat):
            grown = np.zeros(2 * (size + more), np.uint32)
            grown[:size] = self.flat[:size]
            self.flat = grown
        self.flat[size: size + more] = ids
        self.index.update(zip(words, range(len(self.ends) - 1, len(self.ends) - 1 + len(words))))
        self.ends = np.concatenate((self.ends, size + np.cumsum(lens)))
        self.uses = np.concatenate((self.uses, np.zeros(len(words), np.int64)))

    def _forget(self):
        least = max(2, int(np.partition(self.uses, len(self.uses) // 2)[len(self.uses) // 2]) + 1)
        keep = np.flatnonzero(self.uses >= least)
        place = np.full(len(self.uses), -1, np.int64)
        place[keep] = np.arange(len(keep))
        self.index = {w: p for w, i in self.index.items() if (p := int(place[i])) >= 0}
        starts, lens = self.ends[keep], self.ends[keep + 1] - self.ends[keep]
        ends = np.concatenate(([0], np.cumsum(lens)))
        kept = self.flat[np.repeat(starts - ends[:-1], lens) + np.arange(ends[-1])]
        self.flat, self.ends, self.uses = kept, ends, np.zeros(len(keep), np.int64)

    def _places(self, words: list[str]) -> np.ndarray:
        """Places of distinct words in the table; unknown ones are learned."""
        which = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(which < 0)
        if len(new):
            first = len(self.ends) - 1
            self._learn([words[i] for i in new.tolist()])
            which[new] = np.arange(first, first + len(new))
        return which

    def _plain_words(self, texts: pa.Array) -> pa.Array:
        """Words of plain texts, one list a text."""
        texts = pc.replace_substring(texts, ",", " ," if self.cut == WORD_END else " \x01,")
        texts = pc.replace_substring(texts, ".", " ." if self.cut == WORD_END else " \x01.")
        texts = pc.replace_substring(texts, "\n", " " if self.cut == WORD_END else " \n")
        if self.cut == BYTE_LEVEL:
            texts = pc.binary_join_element_wise(pa.scalar(_AS_IT_IS, texts.type), texts, pa.scalar("", texts.type))
        return pc.split_pattern(texts, " ")

    def _pattern_words(self, text: str) -> list[str]:
        if self.cut == WORD_END:
            return _WITHOUT_BLANKS.findall(text)
        return [p[1:] if p[0] == " " and p[1:2] not in ("", " ", "\n", _AS_IT_IS) else p if p[0] == "\n" else _AS_IT_IS + p
                for p in _WITH_BLANKS.findall(text)]

    def kinds(self, texts: pa.Array, low: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which texts are encoded whole, and which are cut by pattern."""
        whole = np.zeros(len(texts), bool)
        for content in self.added:
            whole |= pc.match_substring(low, content.lower()).to_numpy(zero_copy_only=False)
        if self.cut == BYTE_LEVEL:
            whole |= pc.match_substring_regex(texts, f"[{_SPACES}]").to_numpy(zero_copy_only=False)
        pattern = pc.match_substring_regex(low, _BY_PATTERN[self.cut]).to_numpy(zero_copy_only=False)
        return whole, pattern & ~whole

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (strings, no nulls) in one array, and where each
        text's begin (one more entry than texts)."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        # a copy whose bytes begin at 0: ascii_lower misreads a cast slice
        texts = pc.binary_join_element_wise(texts, *[pa.scalar("", texts.type)] * 2)
        if len(self.index) > self.table_words or self.ends[-1] > 16 * self.table_words:
            self._forget()
        ascii_low = pc.ascii_lower(texts)
        whole, pattern = self.kinds(texts, ascii_low)
        texts_cut = ascii_low if self.cut == WORD_END else texts  # other letters are left to the tokenizer
        plain = ~whole & ~pattern
        lists = self._plain_words(texts_cut if plain.all() else texts_cut.filter(pa.array(plain)))
        words = lists.flatten().dictionary_encode()
        counts = np.zeros(len(texts), np.int64)
        counts[plain] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        which = self._places(_strings(words.dictionary)).take(words.indices.to_numpy(zero_copy_only=False))
        if pattern.any():
            cut = [self._pattern_words(t) for t in texts_cut.filter(pa.array(pattern)).to_pylist()]
            counts[pattern] = list(map(len, cut))
            rest = pa.array(list(chain.from_iterable(cut)), pa.large_string()).dictionary_encode()
            more = self._places(rest.dictionary.to_pylist())[rest.indices.to_numpy(zero_copy_only=False)]
            owner = np.repeat(np.arange(len(texts)), counts)
            both = np.empty(len(owner), np.int64)
            both[plain[owner]], both[pattern[owner]] = which, more
            which = both
        self.uses += np.bincount(which, minlength=len(self.uses))
        ends = self.ends.astype(np.int32)  # a table and a block have less than 2 ** 31 ids
        lens = np.diff(ends)[which]
        upto = np.concatenate(([0], np.cumsum(lens, dtype=np.int32)))
        at = np.repeat(ends[:-1][which] - upto[:-1], lens)
        at += np.arange(len(at), dtype=np.int32)
        ids = self.flat.take(at)
        bounds = upto[np.concatenate(([0], np.cumsum(counts)))].astype(np.int64)
        if not whole.any():
            return ids, bounds
        sizes = np.diff(bounds)
        direct = self._direct(texts.filter(pa.array(whole)).to_pylist())
        sizes[whole] = list(map(len, direct))
        out = np.empty(int(sizes.sum()), np.uint32)
        owner = np.repeat(whole, sizes)
        out[~owner], out[owner] = ids, np.fromiter(chain.from_iterable(direct), np.uint32)
        return out, np.concatenate(([0], np.cumsum(sizes)))


_ENCODERS: dict[tuple, TextEncoder] = {}


def encoder(path: str, cut: str) -> TextEncoder:
    """One encoder per worker process."""
    if (path, cut) not in _ENCODERS:
        _ENCODERS[path, cut] = TextEncoder(path, cut)
    return _ENCODERS[path, cut]


def id_type(path: str, end_id: int) -> str:
    """Little-endian numpy type that holds all ids."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(path).get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"
