"""Fill-in-the-middle: a document cut in three and put together in another order.

A rolling hash cuts a text into chunks where its content says so, so passages that many
documents share fall into the same chunks wherever they stand. A cache keeps a summary of
each chunk: how many units begin in it, whether it holds a marker, and the bytes at its two
ends, which say whether a marker stands across a border. A chunk is looked up by its hash and
taken only if its bytes are equal. Summaries of neighbouring chunks add up, so the running
counts of a text's chunks lead to the chunk in which a cut falls, and only that chunk is
looked into. The cache is bounded and belongs to a task; what it holds changes no result.

A unit is a code point. Where a document is cut, and in which form it is put together, are
drawn from a SHA-256 of the seed and its key alone.

Defined results: a null text is the empty text, which stays plain, and so does one that holds
a marker; a null key is drawn as the empty key; rows with one key and text are equal; very long
texts are hashed a stretch at a time, and need their own size again for the result; columns
other than those asked for are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import named
from .text import as_bytes, slices

# The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
#: A chunk's bytes: at least, on average above that, and at most.
LEAST, EVERY, MOST = 64, 256, 4096
WINDOW = 32
STRETCH = 1 << 20
CACHE_BYTES = 8 << 20
#: Bytes of UTF-8 that do not begin a code point.
_INNER = bytes(range(0x80, 0xC0))


def _gear() -> np.ndarray:
    """A number for each byte, from a multiplicative hash of it."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each place; shorter windows at the start."""
    h = GEAR[data]
    width = 1
    while width < WINDOW:
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width)
        h, width = more, 2 * width
    return h


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks of a text end. A cut depends on the bytes before it alone."""
    data = np.frombuffer(text, np.uint8)
    ends, at = [], 0
    for start in range(0, len(data), STRETCH):
        before = min(start, WINDOW - 1)
        found = rolling(data[start - before : start + STRETCH])[before:]
        for place in (np.flatnonzero(found < (1 << 32) // EVERY) + start + 1).tolist():
            while place - at > MOST:
                at += MOST
                ends.append(at)
            if place - at >= LEAST:
                at = place
                ends.append(at)
    while len(data) - at > MOST:
        at += MOST
        ends.append(at)
    if at < len(data):
        ends.append(len(data))
    return ends


@dataclass(frozen=True)
class Summary:
    """What the parts of a text add up to, however it was cut."""

    units: int = 0
    marked: bool = False
    head: bytes = b""
    tail: bytes = b""

    def __add__(self, other: Summary) -> Summary:
        border = self.tail + other.head
        return Summary(
            self.units + other.units,
            self.marked or other.marked or any(m in border for m in MARKERS),
            (self.head + other.head)[:2] if len(self.head) < 2 else self.head,
            (self.tail + other.tail)[-2:],
        )


def summary(chunk: bytes) -> Summary:
    return Summary(
        len(chunk.translate(None, _INNER)), any(m in chunk for m in MARKERS), chunk[:2], chunk[-2:]
    )


@dataclass
class Cache:
    """Summaries of chunks by content: the new ones, and those of the generation before."""

    limit: int = CACHE_BYTES
    new: dict[int, tuple[bytes, Summary]] = field(default_factory=dict)
    old: dict[int, tuple[bytes, Summary]] = field(default_factory=dict)
    held: int = 0
    hits: int = 0

    def get(self, chunk: bytes) -> Summary:
        key = xxhash.xxh3_64_intdigest(chunk)
        known = self.new.get(key) or self.old.get(key)
        if known is not None and known[0] == chunk:
            self.hits += 1
        else:
            known = (chunk, summary(chunk))
        if key not in self.new:
            if self.held > self.limit:
                self.old, self.new, self.held = self.new, {}, 0
            self.new[key] = known
            self.held += len(chunk)
        return known[1]


@dataclass(frozen=True)
class Chunked:
    """A text in chunks, with the running counts of the units before each."""

    text: bytes
    ends: list[int]
    before: list[int]
    whole: Summary

    @classmethod
    def of(cls, text: bytes, cache: Cache) -> Chunked:
        ends = chunk_ends(text)
        parts = [cache.get(text[a:b]) for a, b in zip([0, *ends], ends)]
        whole = Summary()
        for part in parts:
            whole += part
        return cls(text, ends, [0, *accumulate(p.units for p in parts)], whole)

    def place(self, units: int) -> int:
        """The byte at which the unit with this number begins, from 0; the end after the last."""
        if units >= self.whole.units:
            return len(self.text)
        chunk = bisect_right(self.before, units) - 1
        start = self.ends[chunk - 1] if chunk else 0
        data = np.frombuffer(self.text[start : self.ends[chunk]], np.uint8)
        return start + int(np.flatnonzero(data & 0xC0 != 0x80)[units - self.before[chunk]])


def draws(key: object, seed: int) -> list[int]:
    """Four numbers of 32 bits from a document's key."""
    name = f"{seed}:{'' if key is None else key}".encode()
    found = hashlib.sha256(name).digest()
    return [int.from_bytes(found[i : i + 4], "big") for i in range(0, 16, 4)]


def arrange(
    text: bytes, key: object, cache: Cache, seed: int = 1, rate: int = 90, spm: int = 20
) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, units of the prefix, units of the middle, output) of one text."""
    cut = Chunked.of(text, cache)
    n = cut.whole.units
    first, second, taken, order = draws(key, seed)
    if not text or cut.whole.marked or taken % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((first % (n + 1), second % (n + 1)))
    a, b = cut.place(low), cut.place(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < spm:
        parts = (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
        return n, "spm", low, high - low, b"".join(parts)
    return n, "psm", low, high - low, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def transform(
    docs: DataFrame,
    key: str = "doc_id",
    seed: int = 1,
    rate: int = 90,
    spm: int = 20,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Columns ``keep``, then n, form, prefix_chars, middle_chars and output of each row.

    Of a hundred documents ``rate`` are cut, and of these ``spm`` have the suffix first.
    """
    count = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache()
        for batch in slices(batches, count + 1, 2 << 20):
            keys = batch.column(count).to_pylist()
            texts = as_bytes(batch.column(count + 1))
            found = [arrange(t, k, cache, seed, rate, spm) for t, k in zip(texts, keys)]
            n, form, prefix, middle, output = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:count],
                    pa.array(n, pa.int64()),
                    pa.array(form),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                names=[*keep, "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep])
    for name, kind in (("n", "long"), ("form", "string"), ("prefix_chars", "long"),
                       ("middle_chars", "long"), ("output", "string")):
        schema = schema.add(name, kind)
    read = docs.select(*[named(c) for c in keep], named(key).alias("__key"), named("text"))
    return read.mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of, from its output and form alone.

    The text holds no marker, so the first of each marker is the one that was put there.
    """
    p, s, m = (x.decode() for x in MARKERS)
    body = F.substr(output, F.lit(len(p) + 1))

    def halves(text: Column, marker: str) -> tuple[Column, Column]:
        left = F.substring_index(text, marker, 1)
        return left, F.substr(text, F.length(left) + F.lit(len(marker) + 1))

    prefix, rest = halves(body, s)
    suffix, middle = halves(rest, m)
    suffix_first, rest = halves(body, p)
    prefix_second, middle_last = halves(rest, m)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_second, middle_last, suffix_first))
        .otherwise(output)
    )
