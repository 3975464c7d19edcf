"""A prefix trie over conversations, from z-fast tries of their parts.

A conversation becomes a path: for each depth a 128-bit digest of its first turns. Tasks put
paths into z-fast tries: compacted nodes, found by the digest at the two-fattest depth of
their edge. A path's exit node is found by fat binary search, in steps as many as the bits
of its length; paths come in batches, those that leave at the same node together. Then the
edges are expanded: every depth of an edge is a row with the sums of what lies below. Rows
of the same prefix from different tries are added up, so a first turn that all conversations
share is one row a trie, and no task holds the members of a node.

Every prefix belongs to its smallest member, and what a conversation owns of its path is all
from some depth on. A second pass over the same paths, which knows that depth, counts owned
turns once, and so gives sums over the different prefixes below a node without walking the
trie level by level.

Defined results: a null role or text is empty; a null turn comes first, turns of one number
in the order of their MD5, repeated rows are turns like any other; rows without ``conv_id``
are of no conversation and are left out; long texts are only hashed and counted; other
columns are not read; an empty table gives no rows. A trie is given up and begun anew after
a fixed number of turns, and one conversation's digests are held at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import named
from ..sources.staging import write_out
from .skew import spread_join
from .text import word_count

ROOT = bytes(16)
#: Turns that one trie takes.
TRIE_TURNS = 1 << 16
BATCH = 1 << 10


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): for each conversation its turns in order, as a digest and a word count."""
    role, text = (F.coalesce(named(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(named("turn").alias("turn"), mark.alias("mark"), word_count(text).alias("words"))
    return (
        conversations.filter(named("conv_id").isNotNull())
        .select(named("conv_id").alias("conv_id"), turn.alias("turn"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["mark"], t["words"])).alias("turns"))
    )


def shared_starts(ordered: DataFrame, period: int = 20, kinds: int = 4) -> DataFrame:
    """Conversations that begin like the first of their ``period`` ids, for as many turns as a hash says."""
    own = F.col("conv_id")
    first = own - own % period
    count = (F.crc32(own.cast("string").cast("binary")) % kinds).cast("int")
    starts = ordered.filter(own % period == 0).select(
        own.alias("first"), F.slice("turns", 1, kinds - 1).alias("start")
    )
    none = F.slice("turns", 1, 0)
    size = F.greatest(F.size("turns") - count, F.lit(0))
    return ordered.join(starts, first == F.col("first"), "left").select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice("start", F.lit(1), count), none), F.slice("turns", count + 1, size)
        ).alias("turns"),
    )


def paths(ordered: DataFrame) -> DataFrame:
    """(conv_id, path, words): a digest of each prefix but the empty one, and the words of its last turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, words = (batch.column(i).to_pylist() for i in (1, 2))
            found = []
            for line in marks:
                last, path = ROOT, []
                for mark in line:
                    last = hashlib.blake2b(last + mark, digest_size=16).digest()
                    path.append(last)
                found.append(path)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.binary())), pa.array(words, pa.list_(pa.int64()))],
                names=["conv_id", "path", "words"],
            )

    kind = ordered.schema["conv_id"].dataType.simpleString()
    flat = ordered.select("conv_id", F.col("turns.mark").alias("mark"), F.col("turns.words").alias("words"))
    return flat.mapInArrow(run, f"conv_id {kind}, path array<binary>, words array<long>")


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that most powers of two divide."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Compacted nodes of paths, in a table by handle.

    Node ``v`` stands for the depths from ``low[v]`` (not included) to ``deep[v]`` of the path
    ``path[v]``; its handle is that path's digest at the two-fattest of these depths. The
    digest of a prefix names it, so one table holds the first prefix of each edge.
    """

    def __init__(self) -> None:
        self.low, self.deep, self.path, self.words, self.parent = [0], [0], [[]], [[]], [0]
        self.handles: dict[bytes, int] = {}
        self.edges: dict[bytes, int] = {}
        self.turns = 0

    def _add(self, low: int, deep: int, path: list[bytes], words: list[int], parent: int) -> int:
        node = len(self.low)
        for held, value in ((self.low, low), (self.deep, deep), (self.path, path), (self.words, words),
                            (self.parent, parent)):
            held.append(value)
        self._name(node)
        self.turns += deep - low
        return node

    def _name(self, node: int) -> None:
        low, deep, path = self.low[node], self.deep[node], self.path[node]
        self.handles[path[two_fattest(low, deep) - 1]] = node
        self.edges[path[low]] = node

    def _leads(self, node: int, path: list[bytes]) -> bool:
        """Whether all of a node's path is a prefix of ``path``."""
        deep = self.deep[node]
        return deep <= len(path) and self.path[node][deep - 1] == path[deep - 1]

    def exit(self, path: list[bytes], node: int = 0) -> tuple[int, int | None]:
        """The deepest node whose whole path is a prefix, and the child on whose edge ``path`` leaves."""
        low, high = self.deep[node], len(path)
        while low < high:
            middle = two_fattest(low, high)
            found = self.handles.get(path[middle - 1])
            if found is None:
                high = middle - 1
            elif self._leads(found, path):
                node, low = found, self.deep[found]
            else:
                return self.parent[found], found
        deep = self.deep[node]
        return node, self.edges.get(path[deep]) if deep < len(path) else None

    def insert(self, path: list[bytes], words: list[int], at: tuple[int, int | None] | None = None) -> int:
        """The node at which ``path`` ends, made if need be. ``at`` is where it leaves the trie."""
        node, child = at or self.exit(path)
        deep = self.deep[node]
        if deep == len(path):
            return node
        if child is None:
            return self._add(deep, len(path), path, words, node)
        # The longest common prefix with the edge.
        other, low, high = self.path[child], deep + 1, min(len(path), self.deep[child])
        while low < high:
            middle = (low + high + 1) // 2
            if other[middle - 1] == path[middle - 1]:
                low = middle
            else:
                high = middle - 1
        del self.handles[other[two_fattest(deep, self.deep[child]) - 1]]
        self.turns -= low - deep
        self.low[child] = low
        split = self._add(deep, low, path, words, node)
        self.parent[child] = split
        self._name(child)
        return split if low == len(path) else self._add(low, len(path), path, words, split)

    def insert_batch(self, batch: list[tuple[list[bytes], list[int]]]) -> list[int]:
        """Nodes of all paths of a batch: exits are found first, and used up node by node."""
        exits = [self.exit(path) for path, _ in batch]
        order = sorted(range(len(batch)), key=lambda i: (exits[i][0], exits[i][1] or 0))
        ends, used = [0] * len(batch), set()
        for i in order:
            # Where a path of this batch has left already, the trie is another one now.
            at = exits[i] if exits[i] not in used else self.exit(batch[i][0], exits[i][0])
            used.add(exits[i])
            ends[i] = self.insert(*batch[i], at)
        return ends

    def upwards(self) -> list[int]:
        """All nodes but the root, children before parents."""
        return sorted(range(1, len(self.low)), key=lambda v: -self.deep[v])


def _tries(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[ZFastTrie, list[int], list[list]]]:
    """Tries of the rows of a task, with the end node and the columns after the paths of each row."""
    trie, ends, rest = ZFastTrie(), [], []
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            columns = [c.to_pylist() for c in whole.slice(at, BATCH).columns]
            ends += trie.insert_batch(list(zip(columns[1], columns[2])))
            rest += zip(columns[0], *columns[3:])
            if trie.turns >= limit:
                yield trie, ends, rest
                trie, ends, rest = ZFastTrie(), [], []
    if ends:
        yield trie, ends, rest


def _counted(trie: ZFastTrie, ends: list[int], rest: list) -> list[tuple]:
    """Rows of all prefixes: (prefix, parent, depth, smallest member, members, words times members below)."""
    count, least, below = [0] * len(trie.low), [None] * len(trie.low), [0] * len(trie.low)
    for node, (conv,) in zip(ends, rest):
        count[node] += 1
        least[node] = conv if least[node] is None else min(least[node], conv)
    out = []
    for v in trie.upwards():
        low, deep, path, words, n = trie.low[v], trie.deep[v], trie.path[v], trie.words[v], count[v]
        total = below[v]
        for depth in range(deep, low, -1):
            total += n * words[depth - 1]
            out.append((path[depth - 1], path[depth - 2] if depth > 1 else ROOT, depth, least[v], n, total))
        up = trie.parent[v]
        count[up] += n
        least[up] = least[v] if least[up] is None else min(least[up], least[v])
        below[up] += total
    out.append((ROOT, None, 0, least[0], count[0], below[0]))
    return out


def _owned(trie: ZFastTrie, ends: list[int], rest: list) -> list[tuple]:
    """Rows (prefix, words of the different prefixes below, leaves below) of owners' paths.

    An owner (conv, first depth it owns, whether it ends in a leaf) adds its words from that
    depth on to all prefixes before, and what is left of them to its own ones.
    """
    size = len(trie.low)
    least, begin, words_below, leaves = [None] * size, [0] * size, [0] * size, [0] * size
    sums: dict[int, list[int]] = {}

    def until(v: int) -> list[int]:
        """Running sums of the words along the path of a node."""
        if v not in sums:
            sums[v] = [0, *np.cumsum(trie.words[v][: trie.deep[v]], dtype=np.int64).tolist()]
        return sums[v]

    for node, (conv, first, leaf) in zip(ends, rest):
        words_below[node] += until(node)[trie.deep[node]] - until(node)[max(first - 1, 0)]
        leaves[node] += leaf
        if least[node] is None or conv < least[node]:
            least[node], begin[node] = conv, first
    out = []
    for v in trie.upwards():
        run, first = until(v), begin[v]
        for depth in range(trie.deep[v], trie.low[v], -1):
            before = run[depth - 1] - run[max(first - 1, 0)] if first <= depth else 0
            out.append((trie.path[v][depth - 1], words_below[v] - before, leaves[v]))
        up = trie.parent[v]
        words_below[up] += words_below[v]
        leaves[up] += leaves[v]
        if least[up] is None or least[v] < least[up]:
            least[up], begin[up] = least[v], begin[v]
        sums.pop(v)
    out.append((ROOT, words_below[0], leaves[0]))
    return out


def _rows(frame: DataFrame, work, schema: pa.Schema, kinds: str, limit: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for trie, ends, rest in _tries(batches, limit):
            columns = zip(*work(trie, ends, rest))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    return frame.mapInArrow(run, kinds)


def _ends(lines: DataFrame) -> DataFrame:
    """(node, ends_sha256): hash of the sorted ids of the conversations that end at a prefix.

    SHA-256 goes through its input in one order, so the ids of a prefix pass one task, sorted
    by Spark, one at a time: nothing but the state of the hash is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            nodes, hashes = [], []
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != last:
                    if state is not None:
                        nodes.append(last)
                        hashes.append(state.hexdigest())
                    last, state = node, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], names=["node", "ends_sha256"]
            )
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([last], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"]
            )

    end = F.when(F.size("path") > 0, F.element_at("path", -1)).otherwise(F.lit(ROOT))
    sorted_ = (
        lines.select(end.alias("node"), "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")
    )
    return sorted_.mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(ordered: DataFrame, trie_turns: int = TRIE_TURNS) -> DataFrame:
    """One row per prefix of the conversations of ``ordered`` (conv_id, turns), the empty one too.

    Columns node (its digest), conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.
    """
    lines = write_out(paths(ordered), "paths")
    kind = lines.schema["conv_id"].dataType
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind.simpleString()]
    fields = pa.schema(
        [("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", arrow),
         ("n", pa.int64()), ("below", pa.int64())]
    )
    parts = _rows(
        lines, _counted, fields,
        f"node binary, parent binary, depth long, conv_id {kind.simpleString()}, n long, below long", trie_turns,
    )
    nodes = write_out(
        parts.groupBy("node").agg(
            F.first("parent", True).alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
            F.sum("n").alias("n_convs"), F.sum("below").alias("below"),
        ),
        "nodes",
    )
    children = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    counted = write_out(
        nodes.join(children.withColumnRenamed("parent", "up"), F.col("node") == F.col("up"), "left")
        .drop("up")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
        "counted",
    )
    owners = counted.groupBy("conv_id").agg(
        F.min("depth").alias("first"),
        (F.max_by("n_children", "depth") == 0).cast("long").alias("leaf"),
    )
    sums = _rows(
        lines.join(owners, "conv_id").select("conv_id", "path", "words", "first", "leaf"),
        _owned,
        pa.schema([("node", pa.binary()), ("owned", pa.int64()), ("leaves", pa.int64())]),
        "node binary, owned long, leaves long",
        trie_turns,
    )
    sums = sums.groupBy("node").agg(F.sum("owned").alias("owned"), F.sum("leaves").alias("n_leaves"))
    parents = counted.filter("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("held")
    )
    whole = counted.join(sums, "node").join(_ends(lines), "node", "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return spread_join(whole, parents, "parent", "held", "left").select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("below") - F.col("owned")).alias("saved_tokens"),
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
