"""Words of many texts at once, as arrays: the tokens that end each prefix of each distinct word.

Words are sorted, so that a beginning which several words share is worked on once. Prefixes are taken by
length; of each, an automaton over the vocabulary's bytes gives the longest token that ends it, and shorter ones are tried
where that token may not follow the last token of what stands before it. What may follow what is a
function over arrays of tokens; the counting and the encoding operator have one each.
Nothing is kept from one batch of texts to the next.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from partloom.llm.vocabulary import Vocabulary

#: Words of more bytes are worked on one by one.
LONG = 64
#: Words of at most so many bytes are worked on together.
WIDTHS = (12, 24, LONG)


class Table:
    """Whole numbers for whole-number keys, looked up by arrays: open addressing, at most half full."""

    def __init__(self, keys: Sequence[int], values: Sequence[int], room: int = 0):
        """room: how many keys it will hold in the end."""
        bits = max(4, int(max(len(keys), room) * 2).bit_length())
        self._shift, self._mask, self._size = np.uint64(64 - bits), (1 << bits) - 1, 0
        self._keys, self._values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        self.add(keys, values)

    def __len__(self) -> int:
        return self._size

    def add(self, keys: Sequence[int], values: Sequence[int]) -> None:
        """Adds keys that it does not hold, each once."""
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int64)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self._keys[at[left]] < 0]
            self._keys[at[free]] = keys[free]
            placed = self._keys[at[left]] == keys[left]
            self._values[at[left[placed]]] = values[left[placed]]
            left = left[~placed]
            at[left] = (at[left] + 1) & self._mask
        self._size += len(keys)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray, missing: int) -> np.ndarray:
        at = self._slot(keys)
        met = self._keys[at]
        out = np.where(met == keys, self._values[at], missing)
        left = np.flatnonzero((met != keys) & (met >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self._mask
            met = self._keys[at[left]]
            hit = met == keys[left]
            out[left[hit]] = self._values[at[left[hit]]]
            left = left[~hit & (met >= 0)]
        return out


class Endings:
    """An automaton over bytes; each state knows the longest token that ends what was read."""

    def __init__(self, vocab: Vocabulary):
        size, shorter, self.reach = vocab.endings()
        self.size, self.shorter = np.array(size, np.int64), np.array(shorter, np.int64)
        children: list[dict[int, int]] = [{}]
        own: list[int] = [-1]
        for token, i in vocab.bytes_to_id.items():
            node = 0
            for b in token:
                if (after := children[node].get(b)) is None:
                    after = children[node][b] = len(children)
                    children.append({})
                    own.append(-1)
                node = after
            own[node] = i
        back, longest, level = [0] * len(children), list(own), [0]
        while level:
            below = []
            for node in level:
                for b, after in children[node].items():
                    if node:
                        at = back[node]
                        while at and b not in children[at]:
                            at = back[at]
                        back[after] = children[at].get(b, 0)
                    if longest[after] < 0:
                        longest[after] = longest[back[after]]
                    below.append(after)
            level = below
        arcs = [(node << 8 | b, after) for node, c in enumerate(children) for b, after in c.items()]
        self._arcs = Table(*zip(*arcs, strict=True))
        self._back, self.longest = np.array(back), np.array(longest)

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Every byte is a token, so that the start has an arc for each."""
        out = self._arcs.get(nodes << 8 | letters, -1)
        left = np.flatnonzero(out < 0)
        while len(left):
            nodes = self._back[nodes[left]] if len(nodes) == len(out) else self._back[nodes]
            got = self._arcs.get(nodes << 8 | letters[left], -1)
            out[left] = got
            stay = got < 0
            left, nodes = left[stay], nodes[stay]
        return out


@dataclass
class Prefixes:
    """Distinct words of one width. ``cell[w, n]`` is the number of the prefix of n bytes of word w; token and count are of prefixes."""

    rows: np.ndarray
    letters: np.ndarray
    length: np.ndarray
    cell: np.ndarray
    token: np.ndarray
    count: np.ndarray


def prefixes(words: pa.Array, endings: Endings, follows: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[Prefixes]:
    """words: distinct strings; those of more than ``LONG`` bytes are left out. follows(last, token): whether they may stand together."""
    order = pc.array_sort_indices(words).to_numpy()
    size = pc.binary_length(words).to_numpy()[order]
    out, least = [], 1
    for width in WIDTHS:
        rows = order[(size >= least) & (size <= width)]
        least = width + 1
        if len(rows):
            out.append(_prefixes(words.take(pa.array(rows)), rows, width, endings, follows))
    return out


def _prefixes(words: pa.Array, rows: np.ndarray, width: int, endings: Endings, follows: Callable) -> Prefixes:
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
    length = np.diff(offsets)
    inside = np.arange(width) < length[:, None]
    letters = np.zeros((n, width), np.int64)
    letters[inside] = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    same = np.zeros(n, np.int64)
    same[1:] = np.logical_and.accumulate((letters[1:] == letters[:-1]) & inside[1:] & inside[:-1], axis=1).sum(1)
    fresh = inside & (np.arange(width) >= same[:, None])
    cell = np.zeros((n, width + 1), np.int32)
    total = 1 + int(fresh.sum())
    token, count, node = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, np.int64)
    begin = 1
    for end in range(1, width + 1):
        rows_here = np.flatnonzero(fresh[:, end - 1])
        if not len(rows_here):
            continue
        own = np.arange(begin, begin + len(rows_here))
        begin += len(rows_here)
        cell[rows_here, end] = own
        cell[:, end] = np.maximum.accumulate(cell[:, end])
        node[own] = endings.step(node[cell[rows_here, end - 1]], letters[rows_here, end - 1])
        t = endings.longest[node[own]]
        start = end - endings.size[t]
        left = np.flatnonzero(start > 0)
        while len(left):  # just one token fits, mostly the longest; any may stand first
            ok = follows(token[cell[rows_here[left], start[left]]], t[left])
            left = left[~ok]
            t[left] = endings.shorter[t[left]]
            start[left] = end - endings.size[t[left]]
            left = left[start[left] > 0]
        token[own] = t
        count[own] = count[cell[rows_here, start]] + 1
    return Prefixes(rows, letters, length, cell, token, count)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... sizes[0] numbers, then those of starts[1], and so on."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
