"""Elias-Fano sequences and the n-gram trie made of them, read by whole arrays of queries.

All parts are flat arrays in one block of bytes, so a trie can be opened from a file as a
memory map or from a buffer, without a copy.
"""

from __future__ import annotations

import json
import struct

import numpy as np

U = np.uint64


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the ``rank``-th set bit, from 0, in each word."""
    place = np.zeros(len(words), U)
    rank = rank.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        part = (words >> place) & U((1 << width) - 1)
        count = np.bitwise_count(part).astype(np.int64)
        beyond = count <= rank
        rank -= np.where(beyond, count, 0)
        place += np.where(beyond, U(width), U(0))
    return place.astype(np.int64)


class EliasFano:
    """A sequence of numbers that never fall: low bits packed, high bits as gaps in unary."""

    def __init__(self, count: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.count, self.bits, self.low, self.high, self.ones = count, bits, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        count = len(values)
        top = int(values[-1]) + 1 if count else 1
        bits = max(0, (top // max(1, count)).bit_length() - 1)
        low = np.zeros(count * bits // 64 + 2, U)
        at = np.arange(count, dtype=np.int64) * bits
        tail = values.astype(U) & U((1 << bits) - 1)
        shift = (at & 63).astype(U)
        np.bitwise_or.at(low, at >> 6, tail << shift)
        over = (at & 63) + bits > 64
        np.bitwise_or.at(low, (at[over] >> 6) + 1, tail[over] >> (U(64) - shift[over]))
        places = (values >> bits) + np.arange(count)
        flags = np.zeros((int(places[-1]) // 64 + 2) * 64 if count else 64, np.uint8)
        flags[places] = 1
        high = np.packbits(flags, bitorder="little").view("<u8").astype(U)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return cls(count, bits, low, high, ones)

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(index), np.int64)
        at = index * self.bits
        word, shift = at >> 6, (at & 63).astype(U)
        value = self.low[word] >> shift
        # A shift by 64 is undefined, so the rest of the next word moves in two steps.
        value |= (self.low[word + 1] << U(1)) << (U(63) - shift)
        return (value & U((1 << self.bits) - 1)).astype(np.int64)

    def get(self, index: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, index, "right") - 1
        place = word * 64 + _select(self.high[word], index - self.ones[word])
        return (place - index) << self.bits | self._low(index)

    def _zero(self, rank: np.ndarray) -> np.ndarray:
        """Place of the ``rank``-th zero of the unary part."""
        word = np.searchsorted(self.zeros, rank, "right") - 1
        return word * 64 + _select(~self.high[word], rank - self.zeros[word])

    def find(self, value: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Index of each value between two indexes, or -1.

        The unary part says which elements share a value's high bits; among these, low bits
        are searched by halving, since a few contexts hold most of the words near each other.
        """
        found = np.full(len(value), -1, np.int64)
        head, tail = value >> self.bits, value & ((1 << self.bits) - 1)
        known = np.flatnonzero((head < self.zeros[-1]) & (start < end))
        head, tail = head[known], tail[known]
        low = np.zeros(len(known), np.int64)
        some = np.flatnonzero(head > 0)
        low[some] = self._zero(head[some] - 1) + 1 - head[some]
        high = self._zero(head) - head
        low, high = np.maximum(low, start[known]), np.minimum(high, end[known])
        last = high.copy()
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) >> 1
            less = self._low(middle) < tail[active]
            low[active[less]] = middle[less] + 1
            high[active[~less]] = middle[~less]
            active = active[low[active] < high[active]]
        there = np.flatnonzero(low < last)
        there = there[self._low(low[there]) == tail[there]]
        found[known[there]] = low[there]
        return found

    def parts(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "ones": self.ones}


def quantised(share: np.ndarray) -> np.ndarray:
    """Eighths of a halving, rounded down in value, so that shares of a whole stay below it."""
    with np.errstate(divide="ignore"):
        return np.clip(np.ceil(-8.0 * np.log2(share) - 1e-9), 0, 255).astype(np.uint8)


VALUES = 2.0 ** (-np.arange(256) / 8.0)


class Trie:
    """N-grams over word numbers below ``size``, one level per order from 2 on.

    A context is a word number on level 2 and the index of an n-gram of the level below on
    all others. Pointers, which never fall, say where a context's successors stand.
    Successors are stored relative to the last one of the context before, which makes one
    rising sequence per level. Each n-gram has a quantised discounted share of its context;
    each context has the weight that the shorter context's probability gets.
    """

    def __init__(self, size: int, unigrams: np.ndarray, levels: list[dict]):
        self.size, self.unigrams, self.levels = size, unigrams, levels

    @staticmethod
    def level(
        contexts: np.ndarray, words: np.ndarray, counts: np.ndarray, totals: np.ndarray, discount: float
    ) -> dict:
        """A level from n-grams sorted by context and word; ``totals`` has a count per context."""
        share = quantised((counts - discount) / totals[contexts])
        used = np.bincount(contexts, weights=VALUES[share], minlength=len(totals))
        pointers = np.concatenate([[0], np.cumsum(np.bincount(contexts, minlength=len(totals)))])
        last = np.flatnonzero(np.diff(contexts, append=-1))
        spans = np.zeros(len(totals), np.int64)
        spans[contexts[last]] = words[last] + 1
        base = np.cumsum(spans) - spans
        return {
            "pointers": EliasFano.of(pointers),
            "successors": EliasFano.of(base[contexts] + words),
            "share": share,
            "weight": np.round(np.clip(1.0 - used, 0.0, 1.0) * 65535).astype(np.uint16),
        }

    def find(self, order: int, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Index of n-grams on a level, -1 for those it does not have or whose context is -1.

        Each different context and n-gram of the arrays is looked up once, in sorted order.
        """
        level = self.levels[order - 2]
        found = np.full(len(words), -1, np.int64)
        known = np.flatnonzero(contexts >= 0)
        if not len(level["share"]) or not len(known):
            return found
        keys, place = np.unique(contexts[known] * self.size + words[known], return_inverse=True)
        owner, word = keys // self.size, keys % self.size
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        context = owner[first]
        start, end = level["pointers"].get(context), level["pointers"].get(context + 1)
        before = np.zeros(len(context), np.int64)
        later = np.flatnonzero((start > 0) & (start < end))
        before[later] = level["successors"].get(start[later] - 1) + 1
        each = np.diff(np.append(first, len(keys)))
        before, start, end = (np.repeat(x, each) for x in (before, start, end))
        found[known] = level["successors"].find(before + word, start, end)[place]
        return found

    def probabilities(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of each word after those before it; ``first`` marks where a text begins."""
        value = self.unigrams[words]
        context = np.full(len(words), -1, np.int64)
        context[1:] = words[:-1]
        context[first] = -1
        for order, level in enumerate(self.levels, 2):
            index = self.find(order, context, words)
            known, hit = context >= 0, index >= 0
            value[known] *= level["weight"][context[known]] / 65535.0
            value[hit] += VALUES[level["share"][index[hit]]]
            context = np.full(len(words), -1, np.int64)
            context[1:] = index[:-1]
            context[first] = -1
        return value

    def to_bytes(self) -> bytes:
        arrays: list[np.ndarray] = [self.unigrams]
        shape: list[dict] = []
        for level in self.levels:
            entry = {}
            for name in ("pointers", "successors"):
                entry[name] = [level[name].count, level[name].bits]
                arrays += level[name].parts().values()
            arrays += [level["share"], level["weight"]]
            shape.append(entry)
        head = {"size": self.size, "levels": shape, "arrays": [[a.dtype.str, len(a)] for a in arrays]}
        text = json.dumps(head).encode()
        out = [struct.pack("<q", len(text)), text, bytes(-(8 + len(text)) % 8)]
        for array in arrays:
            data = array.tobytes()
            out += [data, bytes(-len(data) % 8)]
        return b"".join(out)

    @classmethod
    def from_buffer(cls, data) -> Trie:
        """A trie over a buffer or a memory map; its arrays are views, not copies."""
        (size,) = struct.unpack_from("<q", data, 0)
        head = json.loads(bytes(data[8 : 8 + size]))
        at = 8 + size + -(8 + size) % 8
        arrays = []
        for kind, count in head["arrays"]:
            arrays.append(np.frombuffer(data, kind, count, at))
            used = arrays[-1].nbytes
            at += used + -used % 8
        feed = iter(arrays)
        unigrams = next(feed)
        levels = []
        for entry in head["levels"]:
            level = {
                name: EliasFano(*entry[name], *(next(feed) for _ in range(3)))
                for name in ("pointers", "successors")
            }
            levels.append(level | {"share": next(feed), "weight": next(feed)})
        return cls(head["size"], unigrams, levels)

    @classmethod
    def open(cls, path: str) -> Trie:
        """A trie that stays in its file; only the pages that are read come into memory."""
        return cls.from_buffer(np.memmap(path, np.uint8, "r"))
