"""A table of distinct words with their token ids, joined back by position."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words that one task keeps; beyond it the table starts anew.
WORDS = 300_000
#: Bytes of text that are split into words at a time.
BLOCK = 2_000_000

Ids = tuple[np.ndarray, np.ndarray]


def from_lists(ids: list[list[int]]) -> Ids:
    """Lists of ids as one flat array and their sizes."""
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    return np.fromiter((x for y in ids for x in y), dtype=np.int32, count=int(sizes.sum())), sizes


class WordTable:
    """Encodes each distinct word of a task once while the table holds it: beyond
    WORDS it starts anew, and words that come again are encoded again.
    ``encode`` gives the ids of words end to end, and how many each has."""

    def __init__(self, encode: Callable[[pa.Array], Ids]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def _add(self, new: pa.Array) -> None:
        ids, sizes = self.encode(new)
        first, n, total = len(self.words), len(new), len(ids)
        while first + n + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = ids
        self.start[first + 1 : first + n + 1] = self.used + np.cumsum(sizes)
        self.used += total
        self.words = pa.concat_arrays([self.words, new])

    def ids(self, words: pa.Array) -> Ids:
        """All words' ids in order, and how many each has."""
        if len(self.words) > WORDS:
            self.clear()
        coded = words.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.words)
        if at.null_count:
            new = coded.dictionary.filter(at.is_null())
            place = np.arange(len(self.words), len(self.words) + len(new), dtype=np.int32)
            self._add(new)
            at = pc.replace_with_mask(at, at.is_null(), pa.array(place))
        at = at.to_numpy()[coded.indices.to_numpy()]
        start = self.start[at]
        n = self.start[at + 1] - start
        end = np.cumsum(n)
        return self.flat[np.repeat(start - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)], n

    def texts(self, texts: pa.Array, split: Callable[[pa.Array], pa.ListArray]) -> Iterator[np.ndarray]:
        """The ids of each text, split and looked up a block of texts at a time."""
        for block in blocks(texts):
            lists = split(block)
            ids, n = self.ids(lists.flatten())
            ends = np.concatenate(([0], np.cumsum(n)))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            del lists, n
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                yield ids[a:b]


def blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in blocks of about BLOCK bytes (one text at least)."""
    end = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(end, (end[first - 1] if first else 0) + BLOCK, side="right")))
        yield texts.slice(first, last - first)
        first = last
