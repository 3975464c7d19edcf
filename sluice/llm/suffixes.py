"""Suffix arrays by induced sorting, and common prefixes in text order.

Suffixes are classified as smaller or larger than their right neighbour. Substrings that
start at a leftmost smaller suffix are sorted by one induction, named, and the string of
names is sorted recursively; a second induction from these gives the whole array in
linear time. Over bytes both inductions move whole buckets at once; over names, of which
there may be as many as places, they go place by place.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(codes: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one a place to its right; the last one is not."""
    n = len(codes)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(codes[1:].astype(np.int64) - codes[:-1])
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def leftmost_smaller(smaller: np.ndarray) -> np.ndarray:
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def _deal(places: np.ndarray, codes: np.ndarray, into: list[list[np.ndarray]]) -> None:
    """Append places to the list of their code, keeping their order."""
    if not len(places):
        return
    keys = codes[places]
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    for part, key in zip(np.split(places, cuts), keys[np.concatenate([[0], cuts])].tolist()):
        into[key].append(part)


def _join(parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else _NONE


_NONE = np.zeros(0, np.int64)


def induce_bytes(
    codes: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, size: int
) -> np.ndarray:
    """All suffixes, sorted as far as the order of the given leftmost smaller ones says."""
    seed: list[list[np.ndarray]] = [[] for _ in range(size)]
    _deal(seeds, codes, seed)
    larger: list[list[np.ndarray]] = [[] for _ in range(size)]
    larger[int(codes[-1])].append(np.array([len(codes) - 1]))
    done: list[np.ndarray] = []
    for code in range(size):
        kept, front = [], _join(larger[code])
        while len(front):
            kept.append(front)
            left = front[front > 0] - 1
            left = left[~smaller[left]]
            same = codes[left] == code
            _deal(left[~same], codes, larger)
            front = left[same]
        done.append(_join(kept))
        front = _join(seed[code])
        _deal(front - 1, codes, larger)

    small: list[list[np.ndarray]] = [[] for _ in range(size)]
    out: list[np.ndarray] = []
    for code in range(size - 1, -1, -1):
        kept, front = [], _join(small[code])
        while len(front):
            kept.append(front)
            left = front[front > 0] - 1
            left = left[smaller[left]]
            same = codes[left] == code
            _deal(left[~same], codes, small)
            front = left[same]
        out.append(_join(kept))
        back = done[code][::-1]
        left = back[back > 0] - 1
        _deal(left[smaller[left]], codes, small)
        out.append(back)
    return np.concatenate(out)[::-1]


def induce_names(codes: list[int], smaller: list[bool], seeds: list[int], size: int) -> list[int]:
    """The same over a large alphabet, place by place."""
    n = len(codes)
    counts = np.bincount(codes, minlength=size)
    ends = np.cumsum(counts)
    tails, heads = ends.tolist(), (ends - counts).tolist()
    array = [-1] * n
    for place in reversed(seeds):
        code = codes[place]
        tails[code] -= 1
        array[tails[code]] = place
    code = codes[n - 1]
    first = heads[code]
    # The last suffix is the first of its bucket; seeds stand at the ends of buckets.
    array[first] = n - 1
    heads[code] += 1
    for at in range(n):
        left = array[at] - 1
        if left >= 0 and not smaller[left]:
            code = codes[left]
            array[heads[code]] = left
            heads[code] += 1
    tails = ends.tolist()
    for at in range(n - 1, -1, -1):
        left = array[at] - 1
        if left >= 0 and smaller[left]:
            code = codes[left]
            tails[code] -= 1
            array[tails[code]] = left
    return array


def _names(codes: np.ndarray, sorted_: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the leftmost smaller substrings, in text order, and how many differ."""
    n = len(codes)
    length = np.append(starts[1:], n) - starts + 1
    number = np.empty(n, np.int64)
    number[starts] = np.arange(len(starts))
    order = number[sorted_]
    size = length[order]
    alike = size[1:] == size[:-1]
    # The last substring runs into the end of the text and is like no other one.
    alike &= (order[1:] != len(starts) - 1) & (order[:-1] != len(starts) - 1)
    pairs = np.flatnonzero(alike)
    step = 0
    while len(pairs):
        a, b = sorted_[pairs] + step, sorted_[pairs + 1] + step
        same = codes[a] == codes[b]
        alike[pairs[~same]] = False
        pairs = pairs[same]
        step += 1
        pairs = pairs[size[pairs] > step]
    rank = np.concatenate([[0], np.cumsum(~alike)])
    names = np.empty(len(starts), np.int64)
    names[order] = rank
    return names, int(rank[-1]) + 1


def suffix_array(codes: np.ndarray, size: int = 256) -> np.ndarray:
    """Start places of all suffixes in sorted order; an end of text is smaller than any code."""
    n = len(codes)
    if n < 2:
        return np.arange(n)
    smaller = smaller_than_next(codes)
    starts = leftmost_smaller(smaller)
    whole = size <= 256

    if whole:
        induce = lambda seeds: induce_bytes(codes, smaller, seeds, size)
    else:
        listed, flags = codes.tolist(), smaller.tolist()
        induce = lambda seeds: np.array(
            induce_names(listed, flags, seeds.tolist(), size), np.int64
        )
    if len(starts) > 1:
        first = np.zeros(n, bool)
        first[starts] = True
        array = induce(starts)
        sorted_ = array[first[array]]
        names, count = _names(codes, sorted_, starts)
        if count == len(starts):
            starts = sorted_
        else:
            starts = starts[suffix_array(names, max(257, count))]
    return induce(starts)


def _common(codes: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of pairs of suffixes, counted up to ``most``."""
    n = len(codes)
    padded = np.concatenate([codes.astype(np.uint8), np.zeros(8, np.uint8)])
    words = np.ndarray((n + 1,), "<u8", padded.tobytes(), strides=(1,))
    room = np.minimum(n - np.maximum(a, b), most)
    found = room.copy()
    at = np.flatnonzero(room > 0)
    step = 0
    while len(at):
        differ = words[a[at] + step] ^ words[b[at] + step]
        stop = differ != 0
        low = differ[stop] & (~differ[stop] + np.uint64(1))
        same = np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8
        where = at[stop]
        found[where] = np.minimum(room[where], step + same)
        step += 8
        at = at[~stop]
        at = at[room[at] > step]
    return found


def repeats_before(
    codes: np.ndarray, array: np.ndarray, length: int, sample: int = 64
) -> np.ndarray:
    """For each place in the array but the first: does it share ``length`` codes with the one before?

    Common prefixes are permuted into text order, where they fall by at most one from a
    place to the next. So they are measured at every ``sample``-th place, which settles
    most of the others, and only those left open are measured too.
    """
    n = len(codes)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    shared = np.zeros(n, bool)
    places = np.arange(0, n, sample)
    most = length + sample
    value = np.zeros(len(places), np.int64)
    has = before[places] >= 0
    value[has] = _common(codes, places[has], before[places[has]], most)
    offset = np.arange(n) % sample
    low = np.repeat(value, sample)[:n] - offset
    nxt = np.append(value[1:], most)
    high = np.repeat(nxt, sample)[:n] + sample - offset
    high[np.repeat(nxt, sample)[:n] >= most] = most
    shared[low >= length] = True
    unsettled = np.flatnonzero((low < length) & (high >= length) & (before >= 0))
    shared[unsettled] = _common(codes, unsettled, before[unsettled], length) >= length
    return shared[array]
