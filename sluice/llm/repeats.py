"""Removing long byte strings that stand in more than one place.

A string of ``length`` bytes is sent where its copies are sent: to the smallest hash of
the grams in it. Neighbouring strings share that hash, so a text becomes a row of runs,
each a hash and the strings that have it. Hashes that occur once cannot hold a repeat and
go no further, which leaves the few runs whose text is looked at. Runs are dealt to shards
by their hash, equal runs only once, and each shard's text gets a suffix array by induced
sorting; common prefixes then say exactly which strings stand in two places.

A hash with so many different runs that they outgrow a shard is split. A split shard also
hands on a digest of each string that has no copy there, and digests that several parts
of the same hash share are counted afterwards, so nothing is lost by splitting.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; copies
are all removed, the first one too; rows are told apart by their place in the input
files, not by ``doc_id``, so repeated rows and null keys are documents like any other;
other columns are not read; a very long text is hashed by stretches and, where one byte or a
short period goes on, falls into runs of equal length; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import named
from ..sources.staging import handing_up, scratch, write_out
from .skew import spread_join
from .suffixes import repeats_before, suffix_array
from .text import as_bytes, slices

GRAM = 32
#: Text of one shard, about; a hash whose runs hold more is split.
SHARD_BYTES = 1 << 19
#: Starts of one run at most, and of the stretch of a text that is hashed at once.
RUN_STARTS, STRETCH_STARTS = 1 << 12, 1 << 20
#: Stands between texts in a shard; no byte of UTF-8 text is equal to it.
BETWEEN = 255
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each place."""
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,)).copy()
    count = len(data) - GRAM + 1
    h = words[:count] * _MIX[0]
    for i in range(1, 4):
        h ^= h >> np.uint64(29)
        h += words[8 * i : 8 * i + count]
        h *= _MIX[i]
    h ^= h >> np.uint64(32)
    h *= _MIX[0]
    return h ^ (h >> np.uint64(29))


def smallest_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window, from running minima of blocks in both directions."""
    count = len(values) - width + 1
    pad = -len(values) % width
    full = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)])
    grid = full.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def text_runs(text: bytes, length: int) -> tuple[np.ndarray, ...]:
    """Runs of one text: hash, digest of its bytes, first start, starts, and 2 if the hash repeats.

    The text is gone through by stretches that overlap, and no run has more than ``RUN_STARTS``
    starts, so that a long text of one byte, or of a short period, is many runs of one length.
    """
    found = [_NO_RUNS]
    for begin in range(0, len(text) - length + 1, STRETCH_STARTS):
        found.append(_stretch_runs(text[begin : begin + STRETCH_STARTS + length - 1], begin, length))
    return tuple(np.concatenate(x) for x in zip(*found))


def _stretch_runs(text: bytes, begin: int, length: int) -> tuple[np.ndarray, ...]:
    width = length - GRAM + 1
    grams = gram_hashes(np.frombuffer(text, np.uint8))
    least = smallest_in_window(grams, width)
    cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
    whole = np.concatenate([[0], cuts])
    sizes = np.diff(np.append(whole, len(least)))
    pieces = -(-sizes // RUN_STARTS)
    first = np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(whole, pieces) + (np.arange(len(first)) - first) * RUN_STARTS
    counts = np.diff(np.append(starts, len(least)))
    keys = least[starts]
    digest = xxhash.xxh3_64_intdigest
    sums, times = [], []
    for start, count, key in zip(starts.tolist(), counts.tolist(), keys):
        sums.append(digest(text[start : start + count + length - 1]))
        here = grams[start : start + count + width - 1] == key
        times.append(2 if np.count_nonzero(here) > 1 else 1)
    return (
        keys.view(np.int64),
        np.array(sums, np.uint64).view(np.int64),
        (starts + begin).astype(np.int32),
        counts.astype(np.int32),
        np.array(times, np.int32),
    )


_NO_RUNS = (*[np.zeros(0, np.int64)] * 2, *[np.zeros(0, np.int32)] * 3)


def runs(numbered: DataFrame, length: int) -> DataFrame:
    """(hash, digest, row, start, count, times) of all runs of (row, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 4 << 20):
            found = [text_runs(text, length) for text in as_bytes(batch.column(1))]
            at = np.repeat(np.arange(batch.num_rows), [len(x[0]) for x in found])
            arrays = [pa.array(np.concatenate(x)) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays(
                [*arrays[:2], batch.column(0).take(pa.array(at)), *arrays[2:]],
                names=["hash", "digest", "row", "start", "count", "times"],
            )

    return numbered.mapInArrow(
        run, "hash long, digest long, row long, start int, count int, times int"
    )


def shard_repeats(
    texts: list[bytes], counts: list[int], times: list[int], length: int
) -> tuple[list[list[tuple[int, int]]], np.ndarray, np.ndarray]:
    """For each run the stretches (first start, starts) of strings that stand in two places.

    Also all starts that begin a class of equal strings, and whether it has one member only.
    """
    sizes = [len(t) + 1 for t in texts]
    base = np.concatenate([[0], np.cumsum(sizes)])
    codes = np.frombuffer(bytes([BETWEEN]).join([*texts, b""]), np.uint8)
    array = suffix_array(codes)
    joined = repeats_before(codes, array, length)
    starts = np.zeros(len(codes), bool)
    for at, count in zip(base.tolist(), counts):
        starts[at : at + count] = True
    # Equal strings are next to each other; a class is a stretch of the array.
    kept = starts[array]
    places, joined = array[kept], joined[kept]
    joined[:1] = False
    number = np.cumsum(~joined) - 1
    size = np.bincount(number, minlength=1)
    marked = np.zeros(len(codes), bool)
    marked[places] = size[number] > 1
    heads = places[~joined]
    alone = size[: len(heads)] == 1
    out = []
    for at, count, n in zip(base.tolist(), counts, times):
        if n > 1:
            out.append([(0, count)])
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], marked[at : at + count].view(np.int8), [0]])))
        out.append([(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])])
    return out, heads, alone


_STRETCH = "array<struct<first:int,starts:int>>"


def find_repeats(
    docs: DataFrame, length: int = 400, shard_bytes: int = SHARD_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Numbered texts (row, doc_id, text) and, for rows that have some, (row, stretches).

    A stretch (first, starts) says that at each of these starts begins a string of
    ``length`` bytes that also begins elsewhere. ``docs`` has to be read from files.
    """
    if length < GRAM:
        raise ValueError(f"strings must have at least {GRAM} bytes")
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        named("doc_id").alias("doc_id"),
        named("text").alias("text"),
    )
    with scratch(docs.sparkSession):
        every = write_out(runs(numbered.select("row", "text"), length), "every")
        often = write_out(every.groupBy("hash").agg(F.sum("times").alias("n")).filter("n > 1"), "often")
        with handing_up():
            shared = write_out(spread_join(every, often, "hash", "n"), "runs")

    same = shared.groupBy("hash", "digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("times").alias("times"),
        F.min(F.struct("row", "start", "count")).alias("at"),
    )
    per_hash = same.groupBy("hash").agg(
        F.count(F.lit(1)).alias("kinds"),
        F.sum(F.col("at.count") + length).alias("bytes"),
    )
    same = write_out(same.join(per_hash, "hash"), "kinds")
    # Where a hash has one run only, which stands in several places, all of it repeats.
    alike = (F.col("kinds") == 1) & (F.col("n") > 1)
    clear = same.filter(alike).select(
        "hash", "digest",
        F.array(F.struct(F.lit(0).alias("first"), F.col("at.count").alias("starts"))).alias("stretches"),
    )
    open_ = same.filter(~alike)
    total = open_.agg(F.sum(F.col("at.count") + length)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    parts = F.greatest(F.ceil(F.col("bytes") / shard_bytes), F.lit(1).cast("long"))
    placed = open_.select(
        "hash", "digest", "n", F.col("at.row").alias("row"), F.col("at.start").alias("start"),
        F.col("at.count").alias("count"),
        F.pmod(F.xxhash64("hash"), F.lit(shards)).alias("shard"),
        F.when(parts > 1, F.pmod(F.xxhash64("digest"), parts) + 1).otherwise(F.lit(0)).alias("part"),
        F.when(parts > 1, F.col("hash")).otherwise(F.lit(0)).alias("split"),
    )
    needed = placed.groupBy("row").agg(
        F.collect_list(
            F.struct("hash", "digest", "n", "start", "count", "shard", "part", "split")
        ).alias("runs")
    )
    cut = (
        numbered.select("row", F.col("text").cast("binary").alias("text"))
        .join(needed, "row")
        .select("text", F.explode("runs").alias("run"))
        .select(
            "run.*",
            F.substring("text", F.col("run.start") + 1, F.col("run.count") + length - 1).alias("bytes"),
        )
    )

    def sort_shard(table: pa.Table) -> pa.Table:
        table = table.sort_by([("hash", "ascending"), ("digest", "ascending")])
        texts = table.column("bytes").to_pylist()
        counts = table.column("count").to_pylist()
        found, heads, alone = shard_repeats(texts, counts, table.column("n").to_pylist(), length)
        handed: list[list[dict]] = [[] for _ in texts]
        if table.column("split")[0].as_py():
            base = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
            number = np.searchsorted(base, heads, "right") - 1
            for i, at, single in zip(number.tolist(), (heads - base[number]).tolist(), alone.tolist()):
                digest = xxhash.xxh3_128_digest(texts[i][at : at + length])
                handed[i].append({"first": at, "string": digest, "alone": single})
        return pa.table(
            {
                "hash": table.column("hash"),
                "digest": table.column("digest"),
                "stretches": pa.array(
                    [[{"first": a, "starts": b} for a, b in x] for x in found],
                    pa.list_(pa.struct([("first", pa.int32()), ("starts", pa.int32())])),
                ),
                "handed": pa.array(
                    handed,
                    pa.list_(
                        pa.struct([("first", pa.int32()), ("string", pa.binary()), ("alone", pa.bool_())])
                    ),
                ),
            }
        )

    sorted_ = cut.groupBy("shard", "part", "split").applyInArrow(
        sort_shard,
        f"hash long, digest long, stretches {_STRETCH},"
        " handed array<struct<first:int,string:binary,alone:boolean>>",
    )
    sorted_ = write_out(sorted_, "sorted")
    found = sorted_.filter(F.size("stretches") > 0).select("hash", "digest", "stretches")
    handed = sorted_.select("hash", "digest", F.inline("handed"))
    again = handed.groupBy("string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("string")
    across = (
        handed.filter("alone")
        .join(again, "string")
        .groupBy("hash", "digest")
        .agg(F.collect_list(F.struct("first", F.lit(1).alias("starts"))).alias("stretches"))
    )
    every_kind = clear.unionAll(found).unionAll(across)
    marks = (
        shared.join(every_kind, ["hash", "digest"])
        .select("row", "start", F.explode("stretches").alias("s"))
        .groupBy("row")
        .agg(
            F.collect_list(
                F.struct((F.col("start") + F.col("s.first")).alias("first"), F.col("s.starts").alias("starts"))
            ).alias("stretches")
        )
    )
    return numbered, marks


def covered(stretches: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte spans covered by strings that begin at the starts of the stretches."""
    spans: list[tuple[int, int]] = []
    for first, starts in sorted(stretches):
        end = first + starts + length - 1
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], end))
        else:
            spans.append((first, end))
    return spans


def drop_repeats(
    docs: DataFrame, length: int = 400, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of each row: removed byte spans and the bytes that stay."""
    numbered, marks = find_repeats(docs, length, shard_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 4 << 20):
            sizes, spans, kept = [], [], []
            for text, found in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                gone = covered([(s["first"], s["starts"]) for s in found or ()], length)
                sizes.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in gone])
                ends = [0, *[b for _, b in gone]]
                kept.append(b"".join(text[a:b] for a, b in zip(ends, [*[a for a, _ in gone], len(text)])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        numbered.join(marks, "row", "left")
        .select("doc_id", "text", "stretches")
        .mapInArrow(
            run,
            f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary",
        )
    )
