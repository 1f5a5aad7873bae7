"""Token ids of whole texts by a public tokenizer, encoding each distinct word once.

The tokenizer never joins text across blanks, so a text's ids are those of
its blank-separated words in order; it also always cuts between a letter and
a comma or full stop, and ignores case. Words are found and hashed with numpy;
each Python worker keeps a bounded table of words it has encoded.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from seismerge.llm.common import byte_sums, lower_ascii, space_words, span_hash

TOKENIZER = "word_bpe_49k.json"
#: Words kept by one Python worker. A full table stays as it is, since common
#: words come early, unless it misses more than half of a slice's words.
KEPT_WORDS = 400_000

_LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[97:123] = True
_STOP[[ord(","), ord(".")]] = True


class WordEncoder:
    def __init__(self, name: str = TOKENIZER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(name if os.path.sep in name else public_tokenizers.path(name))
        self.clear()

    def clear(self) -> None:
        self.index: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1, np.int64)
        self.kept = 0  # entries that stay; those behind serve the last slice only

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The table entry of each word."""
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        self.start = self.start[:self.kept + 1]
        keys, get = distinct.tolist(), self.index.get
        at = np.fromiter((get(h, -1) for h in keys), np.int64, len(keys))
        new = np.flatnonzero(at < 0)
        full = self.kept >= KEPT_WORDS
        if full and 2 * len(new) > len(keys):
            self.clear()
            at[:], new, full = -1, np.arange(len(keys)), False
        if len(new):
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())]
            got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            at[new] = np.arange(len(new)) + (len(self.start) - 1)
            if not full:
                self.index.update(zip([keys[i] for i in new], at[new].tolist()))
            ends = self.start[-1] + np.cumsum([len(g) for g in got])
            while len(self.ids) < ends[-1]:
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.start[-1]:ends[-1]] = list(chain.from_iterable(got))
            self.start = np.concatenate([self.start, ends])
            if not full:
                self.kept = len(self.start) - 1
        return at[back]

    def pieces(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Table entry and start of each separately encoded piece."""
        if b"<|" not in data.tobytes():  # special tokens, if any, are matched as written
            data = lower_ascii(data)
        start, end, _ = space_words(data, off)
        if len(data) > 1:
            inner = np.flatnonzero(_LETTER[data[:-1]] & _STOP[data[1:]]) + 1
            inner = inner[~np.isin(inner, off)] if len(inner) else inner
            start, end = np.sort(np.concatenate([start, inner])), np.sort(np.concatenate([end, inner]))
        return self.words(data, start, end, span_hash(byte_sums(data), start, end)), start

    def expand(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the given entries, and each entry's first position (one more at the end)."""
        size = self.start[at + 1] - self.start[at]
        before = np.concatenate([[0], np.cumsum(size)])
        return self.ids[np.arange(before[-1]) + np.repeat(self.start[at] - before[:-1], size)], before

    def encode(self, data: np.ndarray, off: np.ndarray, tail: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """ids of all rows and each row's first position in them (one more at the
        end); ``tail``: an id after every row."""
        at, start = self.pieces(data, off)
        ids, before = self.expand(at)
        bounds = before[np.searchsorted(start, off)]
        if tail is not None:
            ids = np.insert(ids, bounds[1:], tail)
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds


_encoders: dict[str, WordEncoder] = {}


def encoder(name: str = TOKENIZER) -> WordEncoder:
    """This worker's encoder."""
    if name not in _encoders:
        _encoders[name] = WordEncoder(name)
    return _encoders[name]
