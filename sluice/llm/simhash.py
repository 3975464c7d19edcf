"""SimHash near-duplicates by anchor-point covering.

Fingerprints that differ in at most ``max_bits`` of 64 bits agree to within a part of that
in at least one of a few blocks of bits. In a block, anchors are the words of a covering
code: a perfect Hamming code on 15 bits, so that every pattern is within covering radius 1
of exactly one anchor, its home, and any two patterns at distance t meet at an anchor
that is within 1 + t of both. A fingerprint is therefore replicated to all anchors within
covering radius plus threshold, and at each anchor compared with those at home there.

Equal fingerprints are one node. At an anchor only a spanning forest of the links found is
kept, so a dense group gives as many rows as it has members, not all its pairs. Anchors
with many members are split into a grid of parts that are compared pairwise.

Defined results: a null text has no words; no words give fingerprint zero, which is linked
like any other; fewer words than a shingle are one shingle; repeated rows have equal
fingerprints; rows whose ``doc_id`` is null get the smallest other id of their component,
or null if it has none; a very long text is hashed whole, its words and hashes held at once;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import named
from ..sources.staging import write_out
from .components import connected_components
from .text import as_bytes, fresh, picked, slices

BITS = 64
SEED = 42
#: Members of one anchor that one task compares; more are split into parts of this size.
ANCHOR_ROWS = 4096


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Bit i is set if over half of the shingles' hashes have it set."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[: count - 1]]).tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], "<u8")
    total = np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > count, bitorder="little").view("<u8")[0])


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprints(
    docs: DataFrame, shingle: int = 4, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Columns ``keep`` and ``bits``, the fingerprint as a signed long, for each row of ``docs``."""
    count = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, count, 4 << 20):
            bits = [fingerprint(t, shingle) for t in as_bytes(batch.column(count))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:count], pa.array(np.array(bits, "<u8").view("<i8"))],
                names=[*keep, "bits"],
            )

    fields = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    schema = T.StructType([*fields, T.StructField("bits", T.LongType())])
    return picked(docs, *keep, "text").mapInArrow(run, schema)


def syndrome(patterns: np.ndarray) -> np.ndarray:
    """Place, from 1, of the bit whose change leads to the anchor of 15 low bits; 0 is the anchor."""
    found = np.zeros_like(patterns)
    for bit in range(15):
        found ^= np.where(patterns >> np.uint64(bit) & np.uint64(1), np.uint64(bit + 1), np.uint64(0))
    return found


def home(patterns: np.ndarray) -> np.ndarray:
    """The anchor within distance 1 of the 15 low bits; bits above these must agree exactly."""
    at = syndrome(patterns)
    flip = np.where(at > 0, np.uint64(1) << (np.maximum(at, np.uint64(1)) - np.uint64(1)), 0)
    return patterns ^ flip.astype(np.uint64)


def anchors(patterns: np.ndarray, width: int, threshold: int) -> list[np.ndarray]:
    """All anchors within covering radius plus threshold: homes of patterns up to ``threshold`` away.

    An anchor within 1 + t of a pattern is within 1 of a pattern that is t away, so the
    homes of the ball of radius t are exactly these anchors. Repeats are left in.
    """
    ball = [np.uint64(0)]
    for _ in range(threshold):
        ball = list({a ^ (np.uint64(1) << np.uint64(i)) for a in ball for i in range(width)} | set(ball))
    return [home(patterns ^ change) for change in ball]


def blocks(max_bits: int) -> list[tuple[int, int, int]]:
    """(first bit, width, threshold) of each block: one of them is within its threshold.

    Enough blocks that the differing bits leave at most one to some block.
    """
    count = max_bits // 2 + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a, max_bits // count) for a, b in zip(edges, edges[1:])]


def replicate(bits: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, at home) of every row of ``bits``; an anchor's name holds its block."""
    names, rows, homes = [], [], []
    every = np.arange(len(bits))
    for number, (first, width, threshold) in enumerate(blocks(max_bits)):
        pattern = bits >> np.uint64(first) & np.uint64((1 << width) - 1)
        found = np.stack(anchors(pattern, width, threshold), 1)
        found.sort(axis=1)
        new = np.ones(found.shape, bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        tag = np.uint64(number) << np.uint64(56)
        names.append((found | tag)[new])
        rows.append(np.broadcast_to(every[:, None], found.shape)[new])
        homes.append((found == home(pattern)[:, None])[new])
    return np.concatenate(names), np.concatenate(rows), np.concatenate(homes)


def forest(
    probes: np.ndarray, at_home: np.ndarray, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two arrays of fingerprints, as pairs of bits."""
    nodes, place = np.unique(np.concatenate([probes, at_home]), return_inverse=True)
    left, right = place[: len(probes)], place[len(probes) :]
    parent = np.arange(len(nodes))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out: list[tuple[int, int]] = []
    step = max(1, (1 << 20) // max(1, len(at_home)))
    for at in range(0, len(probes), step):
        near = np.bitwise_count(probes[at : at + step, None] ^ at_home[None, :]) <= max_bits
        rows, columns = np.nonzero(near)
        for x, y in zip(left[at + rows].tolist(), right[columns].tolist()):
            if x != y:
                a, b = find(x), find(y)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((x, y))
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return nodes[pairs[:, 0]], nodes[pairs[:, 1]]


def links(distinct: DataFrame, max_bits: int = 4, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints whose components are those of all links.

    ``distinct`` has one column ``bits``. Nothing is dropped at any size of an anchor.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                bits = whole.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
                names, rows, homes = replicate(bits.view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names.view(np.int64)),
                        pa.array(bits[rows]),
                        pa.array(homes),
                    ],
                    names=["anchor", "bits", "home"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[], []]
            for probes, homes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = forest(
                    np.array(probes, np.int64).view(np.uint64),
                    np.array(homes, np.int64).view(np.uint64),
                    max_bits,
                )
                found[0].append(a.view(np.int64))
                found[1].append(b.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x or [np.zeros(0, np.int64)])) for x in found],
                names=["a", "b"],
            )

    copies = distinct.mapInArrow(spread, "anchor long, bits long, home boolean")
    large = (
        copies.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("home").alias("h"))
        .filter(F.col("n") > anchor_rows)
        .select(
            "anchor",
            F.ceil(F.col("n") / anchor_rows).alias("rows"),
            F.greatest(F.ceil(F.col("h") / anchor_rows), F.lit(1).cast("long")).alias("columns"),
        )
    )
    # A large anchor is a grid: probes go along a row of it, homes down a column, and each
    # cell is one comparison. All other anchors are one cell, whose members are both.
    row = F.pmod(F.xxhash64("bits"), F.col("rows"))
    column = F.pmod(F.xxhash64("bits"), F.col("columns"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    cell = lambda i, j, probe, home: F.struct(
        i.alias("i"), j.alias("j"), probe.alias("probe"), home.alias("home")
    )
    yes, no, zero = F.lit(True), F.lit(False), F.lit(0).cast("long")
    across = F.transform(upto("columns"), lambda j: cell(row, j, yes, no))
    down = F.transform(upto("rows"), lambda i: cell(i, column, no, yes))
    cells = F.when(F.col("rows").isNull(), F.array(cell(zero, zero, yes, F.col("home")))).otherwise(
        F.concat(across, F.when(F.col("home"), down).otherwise(F.slice(down, 1, 0)))
    )
    grouped = (
        copies.join(large, "anchor", "left")
        .select("anchor", "bits", F.inline(cells))
        .repartition("anchor", "i", "j")
        .groupBy("anchor", "i", "j")
        .agg(
            F.collect_list(F.when(F.col("probe"), F.col("bits"))).alias("probes"),
            F.collect_list(F.when(F.col("home"), F.col("bits"))).alias("homes"),
        )
        .filter((F.size("homes") > 0) & (F.size("probes") > 0))
        .filter((F.size("probes") > 1) | (F.get("probes", F.lit(0)) != F.get("homes", F.lit(0))))
        .select("probes", "homes")
    )
    return grouped.mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, anchor_rows: int = ANCHOR_ROWS
) -> DataFrame:
    """(row, doc_id, bits, root, component_id): one row per row of ``docs``.

    ``row`` is Spark's row number of a scan, ``root`` names the component, ``component_id``
    is the smallest ``doc_id`` that links lead to. Fingerprints are computed once and written.
    """
    numbered = docs.select(
        named("doc_id").alias("doc_id"),
        named("text").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = write_out(fingerprints(numbered, shingle, ("doc_id", "row")), "prints")
    distinct = rows.groupBy("bits").agg(F.min("doc_id").alias("first"))
    found = connected_components(links(distinct.select("bits"), max_bits, anchor_rows))
    rooted = distinct.join(found, F.col("bits") == F.col("node"), "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.drop("first").join(least, "root"), "bits")


def keep_one(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, anchor_rows: int = ANCHOR_ROWS
) -> DataFrame:
    """One row of ``docs`` per group of near-duplicates: that with the smallest ``doc_id``.

    Of rows that share this ``doc_id`` the first stays; of a group without any ``doc_id``,
    its first row. ``docs`` has to be read from files, whose rows keep their numbers.
    """
    found = near_duplicates(docs, shingle, max_bits, anchor_rows)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    best = found.groupBy("root").agg(F.min(order).alias("best"))
    rest = found.join(best, "root").filter("row <> best.row")
    number, gone = fresh(docs, "row"), fresh(docs, "gone")
    return (
        docs.withColumn(number, F.monotonically_increasing_id())
        .join(rest.select(F.col("row").alias(gone)), named(number) == named(gone), "left_anti")
        .drop(number)
    )
