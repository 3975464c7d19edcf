"""Jaccard join of documents on word shingles, filtered by several global token orders.

Two sets with similarity t share a token among the first ``n - ceil(t n) + 1`` of each, whatever
order all tokens are put in. Candidates must share such a prefix token in one order after the
other, and each order is asked only about what the earlier ones left:

1. A quarter of all tokens, picked by hash, comes first, the rarest ahead; the rest follow by
   hash. So only that quarter is counted over the corpus. Tokens of one document link nothing
   and go; documents that share a prefix token, also by way of others, form a group.
2. Another quarter comes first, counted anew inside each group, which falls apart further.
3. Inside a group all tokens stand in order of their count there. What shares a prefix token
   is verified on whole sets, as the exact size of the intersection.

Equal sets are one node. Whole sets travel only for documents that two orders left, once if
their group fits a cell, else once per part of a grid of cells: each cell compares two parts
of a group, so no task holds a group, and none is dropped or cut. Inside a cell documents that
links connect already are not compared again unless every link is asked for.

Defined results: a null text has no words; a document without words has no set and links
with nothing; fewer words than a shingle are one token; repeated rows are linked as equal
sets; rows whose ``doc_id`` is null get the smallest other id of their component, or null if
it has none; very long texts are cut into words a stretch at a time, and their set is held
whole; other columns are not read; an empty table gives an empty result. Tokens are 64-bit
hashes of shingles, and sets are told apart by 128-bit digests. ``docs`` has to be read from
files, whose rows keep their numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import named
from ..operators.lookup import join_side, settle
from ..sources.staging import write_out
from .components import connected_components
from .skew import spread_join
from .text import as_bytes, slices

STRETCH = 1 << 20
#: Tokens of one part of a large group; a cell compares two parts.
PART_TOKENS = 1 << 18
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a stretch at a time."""
    at = 0
    while at < len(text):
        end = at + STRETCH
        gap = _SPACE.search(text, end) if end < len(text) else None
        end = gap.start() if gap else len(text)
        yield text[at:end].translate(_LOWER).split()
        at = end


def token_set(text: bytes, shingle: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    digest = xxhash.xxh3_64_intdigest
    found, last = [], []
    for words in word_lists(text):
        last += words
        if len(last) < shingle:
            continue
        line = b" ".join(last)
        ends = np.cumsum([len(w) + 1 for w in last])
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        found.append(np.unique(np.array([digest(line[a:b]) for a, b in zip(starts, stops)], np.uint64)))
        last = last[len(last) - shingle + 1 :]
    if not found:
        return np.array([digest(b" ".join(last))] if last else [], np.uint64)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def prefix_size(sizes, percent: int):
    """How many first tokens of a set one must be shared of."""
    return sizes - (percent * sizes + 99) // 100 + 1


def leading(tokens: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The quarter of tokens that comes first in an order, or the prefix if that is longer."""
    place = np.sort(tokens ^ (np.uint64(order) << np.uint64(62)))
    first = int(np.searchsorted(place, np.uint64(1 << 62)))
    place = place[: max(first, prefix_size(len(tokens), percent))]
    return place ^ (np.uint64(order) << np.uint64(62))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    values = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _sets(numbered: DataFrame, shingle: int, percent: int, order: int, whole: bool) -> DataFrame:
    """(row, doc_id, label, n, digest, tokens, first) of (row, doc_id, label, text) rows.

    ``first`` holds what an order puts first; ``tokens`` is the whole set if it is asked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, 2 << 20):
            sets = [token_set(t, shingle) for t in as_bytes(batch.column(3))]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            firsts = [leading(s, order, percent) if len(s) else s for s in sets]
            none = [np.zeros(0, np.uint64)] * len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    _lists(sets if whole else none),
                    _lists(firsts),
                ],
                names=["row", "doc_id", "label", "n", "digest", "tokens", "first"],
            )

    kind = numbered.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(
        run,
        f"row long, doc_id {kind}, label long, n long, digest binary, tokens array<long>, first array<long>",
    )


def groups(firsts: DataFrame, percent: int) -> DataFrame:
    """(node, root): documents that share a prefix token with others of their label, grouped.

    ``firsts`` has (cls, label, n, first). Tokens of ``first`` that one document has count as
    the rarest ones; of the others, in order of count, those up to the end of the prefix stay.
    The groups of each label are those of its own tokens, so orders intersect.
    """
    size = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    every = firsts.select(
        "cls", (F.size("first") - size).alias("over"), F.col("label"), F.explode("first").alias("token")
    ).select("cls", "over", F.xxhash64("label", "token").alias("token"))
    often = write_out(
        every.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "often"
    )
    side = often.select("token", F.col("df"), F.col("df").alias("held"))
    shared = spread_join(every, side, "token", "held")
    tokens = F.sort_array(F.collect_list(F.struct("df", "token")))
    prefixes = shared.groupBy("cls").agg(F.first("over").alias("over"), tokens.alias("tokens"))
    live = F.slice("tokens", F.lit(1), F.greatest(F.size("tokens") - F.col("over"), F.lit(0)).cast("int"))
    held = write_out(prefixes.select("cls", F.explode(live).alias("t")).select("cls", "t.token"), "prefix")
    centres = write_out(
        held.groupBy("token")
        .agg(F.min("cls").alias("centre"), F.count(F.lit(1)).alias("held"))
        .filter("held > 1"),
        "centres",
    )
    links = spread_join(held, centres, "token", "held").filter("cls <> centre")
    return connected_components(links.select(F.col("cls").alias("a"), F.col("centre").alias("b")))


def compare(
    sets: list[np.ndarray], percent: int, parts: np.ndarray | None = None, every: bool = False
) -> list[tuple[int, int, int]]:
    """Links (i, j, size of the intersection) between sets of one cell.

    Without ``every`` a spanning forest of the links. With it all of them, but for cells of two
    ``parts`` only those between the parts.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets])
    doc = np.repeat(np.arange(count), sizes)
    tokens, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    if count == 2 and not every:
        both = int(sizes.sum()) - len(tokens)
        return [(0, 1, both)] if 100 * both >= percent * len(tokens) else []
    starts = np.concatenate([[0], np.cumsum(sizes)])
    by_count = np.lexsort((inverse, times[inverse], doc))
    rank = np.arange(len(doc)) - starts[doc]
    first = rank < prefix_size(sizes, percent)[doc]
    # Documents of each token, and those that have it in their prefix.
    held = doc[np.argsort(inverse, kind="stable")]
    held_at = np.concatenate([[0], np.cumsum(times)])
    lead = inverse[by_count][first]
    lead_doc = doc[by_count][first]
    lead_at = np.searchsorted(np.sort(lead), np.arange(len(tokens) + 1))
    lead_held = lead_doc[np.argsort(lead, kind="stable")]
    lead_start = np.searchsorted(lead_doc, np.arange(count + 1))

    parent, size = list(range(count)), [1] * count

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out: list[tuple[int, int, int]] = []
    top = 0

    def work(i: int) -> None:
        nonlocal top
        mine = lead[lead_start[i] : lead_start[i + 1]]
        near = np.unique(np.concatenate([lead_held[lead_at[t] : lead_at[t + 1]] for t in mine.tolist()]))
        small, large = np.minimum(sizes[near], sizes[i]), np.maximum(sizes[near], sizes[i])
        near = near[(100 * small >= percent * large) & (near != i)]
        if every:
            near = near[near > i]
            near = near if parts is None else near[parts[near] != parts[i]]
        else:
            own = find(i)
            near = near[[find(j) != own for j in near.tolist()]] if len(near) else near
        if len(near) > 8:
            rows = inverse[starts[i] : starts[i + 1]].tolist()
            both = np.bincount(np.concatenate([held[held_at[t] : held_at[t + 1]] for t in rows]), minlength=count)[near]
        else:
            both = np.array([len(np.intersect1d(sets[i], sets[j], True)) for j in near.tolist()], np.int64)
        linked = 100 * both >= percent * (sizes[i] + sizes[near] - both)
        for j, shared in zip(near[linked].tolist(), both[linked].tolist()):
            a, b = find(i), find(j)
            if every or a != b:
                out.append((i, j, shared))
            if a != b:
                a, b = (a, b) if size[a] >= size[b] else (b, a)
                parent[b], size[a] = a, size[a] + size[b]
                top = a if size[a] > size[find(top)] else find(top)

    # Documents that were never looked at are all in the largest component in the end, so
    # every pair of two components has one that was.
    done = [False] * count
    while True:
        todo = [i for i in range(count) if not done[i] and (every or i == 0 or find(i) != find(top))]
        if not todo:
            return out
        for i in todo:
            if every or i == 0 or find(i) != find(top):
                work(i)
                done[i] = True


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell, which stand together, however batches cut them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            if held and tuple(keys[a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            last = tuple(keys[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def links(
    sets: DataFrame, percent: int = 85, every: bool = False, part_tokens: int = PART_TOKENS
) -> DataFrame:
    """(a, b, both): links among ``sets`` (cls, label, tokens), and the sizes of intersections.

    Without ``every`` only links that connect the same components as all of them do.
    """
    sized = sets.select("label", F.size("tokens").cast("long").alias("n"))
    parts = F.greatest(F.ceil(F.col("n") / part_tokens), F.lit(1).cast("long"))
    large = sized.groupBy("label").agg(F.sum("n").alias("n")).select("label", parts.alias("parts"))
    large = settle(large.filter("parts > 1").withColumn("n", F.col("parts")), "label")
    zero = F.lit(0).cast("long")
    many = F.coalesce("parts", F.lit(1).cast("long"))
    part = F.pmod(F.xxhash64("cls"), many)
    met = F.transform(
        F.sequence(zero, many - 1),
        lambda j: F.struct(F.least("part", j).alias("i"), F.greatest("part", j).alias("j")),
    )
    placed = (
        join_side(sets, "label", large, {"parts": "parts"}, "left")
        .withColumn("part", part)
        .select("label", F.inline(met), "cls", "part", "tokens")
        .repartition("label", "i", "j")
        .sortWithinPartitions("label", "i", "j")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            rows = cell.column("cls").to_numpy()
            lists = cell.column("tokens").combine_chunks()
            values, ends = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy()
            held = [values[a - ends[0] : b - ends[0]] for a, b in zip(ends, ends[1:])]
            split = cell.column("i")[0].as_py() != cell.column("j")[0].as_py()
            found = compare(held, percent, cell.column("part").to_numpy() if split else None, every)
            if found:
                i, j, both = np.array(found, np.int64).T
                low, high = np.minimum(rows[i], rows[j]), np.maximum(rows[i], rows[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (low, high, both)], names=["a", "b", "both"]
                )

    return placed.mapInArrow(run, "a long, b long, both long")


def join(
    docs: DataFrame,
    shingle: int = 4,
    percent: int = 85,
    every: bool = True,
    part_tokens: int = PART_TOKENS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members, classes and links of the whole join.

    Members (row, doc_id, n, digest) are the rows of ``docs``, classes (cls, digest, first, n,
    held) the different sets with the smallest ``doc_id`` and the number of their rows, links
    (a, b, both) pairs of classes, with the size of their intersection.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        named("doc_id").alias("doc_id"),
        F.lit(0).cast("long").alias("label"),
        named("text").alias("text"),
    )
    members = write_out(
        _sets(numbered, shingle, percent, 0, False).select("row", "doc_id", "n", "digest", "first"), "sets"
    )
    classes = (
        members.filter("n > 0")
        .groupBy("digest")
        .agg(
            F.min("row").alias("cls"), F.min("doc_id").alias("least"), F.first("n").alias("n"),
            F.count(F.lit(1)).alias("held"), F.min_by("first", "row").alias("first"),
        )
    )
    found = groups(classes.select("cls", F.lit(0).cast("long").alias("label"), "n", "first"), percent)
    side = settle(found.withColumn("n", F.lit(1)), "node")
    left = join_side(numbered.drop("label"), "row", side, {"label": "root"})
    sets = write_out(
        _sets(left.select("row", "doc_id", "label", "text"), shingle, percent, 1, True)
        .select(F.col("row").alias("cls"), "label", "n", "tokens", "first"),
        "candidates",
    )
    again = groups(sets.select("cls", "label", "n", "first"), percent)
    side = settle(again.withColumn("n", F.lit(1)), "node")
    last = join_side(sets.select("cls", "tokens"), "cls", side, {"label": "root"})
    pairs = links(write_out(last, "verified"), percent, every, part_tokens)
    return members.drop("first"), classes.drop("first"), pairs


def near_duplicates(
    docs: DataFrame, shingle: int = 4, percent: int = 85, part_tokens: int = PART_TOKENS
) -> DataFrame:
    """(row, doc_id, n, component_id) of each row: the smallest ``doc_id`` that links lead to."""
    members, classes, pairs = join(docs, shingle, percent, False, part_tokens)
    found = connected_components(pairs.select("a", "b"))
    rooted = classes.join(found, F.col("cls") == F.col("node"), "left").select(
        "digest", "least", "held", F.coalesce("root", "cls").alias("root")
    )
    smallest = rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count(F.lit(1)).alias("kinds")
    )
    named_ = write_out(
        spread_join(rooted, write_out(smallest, "roots"), "root", "kinds").select("digest", "held", "component_id"),
        "classes",
    )
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return spread_join(members, named_, "digest", "held", "left").select(
        "row", "doc_id", "n", own.alias("component_id")
    )
