"""Nearest neighbours by cosine: a navigable small-world graph per shard, results merged.

Vectors are dealt to shards of a bounded number of rows by a hash. In each shard a task
builds a hierarchy of graphs over the distinct vectors and stores it as flat neighbour
arrays, one row of the index per shard. A search sends the queries, in blocks, to every
shard of their length, walks its graph, scores what it finds in double precision on the
original vectors, and merges the best of all shards.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers
take no part, and neither do rows without an id; equal vectors are one node that keeps
its smallest ids; a candidate never has its query's id; ties go to the smaller id; vectors
of another length than the query's are not compared; repeated rows count once; fewer
candidates than asked for give all of them; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import named
from ..sources.staging import write_out

#: Rows of a shard, about; links of a node on upper levels (twice as many on the lowest).
SHARD_ROWS, LINKS = 4096, 12
#: Breadth of the walk while building and while searching.
BUILD_WIDTH, SEARCH_WIDTH = 64, 64
BLOCK_ROWS = 2048


class Graph:
    """Levels of neighbour lists over unit vectors; ``flat[l][i]`` are neighbours, -1 is none.

    Level 0 has a row for every node, a level above for its own nodes only, whose row
    ``row[l][node]`` gives.
    """

    def __init__(self, vectors: np.ndarray, links: int, flat: list, row: list, entry: int):
        self.vectors, self.links = vectors, links
        self.flat, self.row, self.entry = flat, row, entry
        self.seen = np.zeros(len(vectors), np.int32)
        self.stamp = 0

    def near(self, level: int, node: int) -> np.ndarray:
        at = node if level == 0 else self.row[level][node]
        found = self.flat[level][at]
        return found[found >= 0]

    def walk(self, query: np.ndarray, start: list[tuple[float, int]], width: int, level: int):
        """The best ``width`` nodes reached from ``start``, as (likeness, node), best first."""
        self.stamp += 1
        seen, stamp, vectors = self.seen, self.stamp, self.vectors
        flat = self.flat[level]
        row = None if level == 0 else self.row[level]
        ahead = [(-s, n) for s, n in start]
        best = list(start)
        for _, node in start:
            seen[node] = stamp
        heapq.heapify(ahead)
        heapq.heapify(best)
        while ahead:
            far, node = heapq.heappop(ahead)
            if len(best) >= width and -far < best[0][0]:
                break
            around = flat[node if row is None else row[node]]
            around = around[(around >= 0) & (seen[around] != stamp)]
            if not len(around):
                continue
            seen[around] = stamp
            likeness = vectors[around] @ query
            for s, n in zip(likeness.tolist(), around.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (s, n))
                    heapq.heappush(ahead, (-s, n))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, n))
                    heapq.heappush(ahead, (-s, n))
        return sorted(best, reverse=True)

    def descend(self, query: np.ndarray, to: int) -> list[tuple[float, int]]:
        start = [(float(self.vectors[self.entry] @ query), self.entry)]
        for level in range(len(self.flat) - 1, to, -1):
            start = self.walk(query, start, 1, level)
        return start

    def search(self, query: np.ndarray, width: int) -> list[int]:
        if not len(self.vectors):
            return []
        return [n for _, n in self.walk(query, self.descend(query, 0), width, 0)]

    def spread_out(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Up to ``most`` nodes, each nearer to the new node than to one already taken."""
        nodes = [n for _, n in found]
        among = self.vectors[nodes] @ self.vectors[nodes].T
        taken: list[int] = []
        for at, (likeness, _) in enumerate(found):
            if not taken or likeness > among[at, taken].max():
                taken.append(at)
                if len(taken) == most:
                    break
        if len(taken) < most:  # fill up with the nearest ones, so no node is left alone
            taken += [i for i in range(len(nodes)) if i not in set(taken)][: most - len(taken)]
        return [nodes[i] for i in taken]


def build_graph(
    vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 1
) -> Graph:
    """Insert unit vectors one after the other; levels are drawn from a fixed seed."""
    count = len(vectors)
    draw = np.random.default_rng(seed).random(count)
    levels = np.minimum((-np.log(1.0 - draw) / np.log(links)).astype(int), 12)
    top = int(levels.max(initial=0))
    flat, row = [np.full((count, 2 * links), -1, np.int32)], [np.zeros(0, np.int32)]
    for level in range(1, top + 1):
        at = np.flatnonzero(levels >= level)
        place = np.full(count, -1, np.int32)
        place[at] = np.arange(len(at))
        flat.append(np.full((len(at), links), -1, np.int32))
        row.append(place)
    graph = Graph(vectors, links, flat, row, 0)
    reached = int(levels[0]) if count else 0
    graph.flat, held = flat[: reached + 1], flat
    for node in range(1, count):
        query, level = vectors[node], int(levels[node])
        start = graph.descend(query, min(level, reached))
        for at in range(min(level, reached), -1, -1):
            start = graph.walk(query, start, width, at)
            most = 2 * links if at == 0 else links
            chosen = graph.spread_out(start, links)
            own = node if at == 0 else row[at][node]
            held[at][own, : len(chosen)] = chosen
            for other in chosen:
                theirs = held[at][other if at == 0 else row[at][other]]
                free = np.flatnonzero(theirs < 0)
                if len(free):
                    theirs[free[0]] = node
                    continue
                around = np.append(theirs, node)
                likeness = vectors[around] @ vectors[other]
                order = np.argsort(-likeness, kind="stable")
                kept = graph.spread_out(
                    list(zip(likeness[order].tolist(), around[order].tolist())), most
                )
                theirs[:] = -1
                theirs[: len(kept)] = kept
        if level > reached:
            reached, graph.entry = level, node
            graph.flat = held[: reached + 1]
    return graph


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector, length) of the rows that take part."""
    values = named(vector).cast("array<double>")
    good = F.coalesce(
        F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(values, lambda x: x != 0.0),
        F.lit(False),
    )
    return vectors.filter(named(key).isNotNull() & good).select(
        named(key).cast("long").alias("id"), values.alias("vector"), F.size(values).alias("length")
    )


def build_index(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    links: int = LINKS,
    width: int = BUILD_WIDTH,
    keep: int = 16,
) -> DataFrame:
    """One row per shard: its vectors, ids and flat neighbour arrays, written once.

    ``keep`` bounds how many ids of equal vectors a node holds: a search for fewer than
    ``keep`` neighbours never needs more, since ties go to the smallest ids.
    """
    good = usable(vectors, key, vector)
    shards = max(1, -(-vectors.count() // shard_rows))
    dealt = good.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)))

    def build(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        length = table.column("length")[0].as_py()
        values = table.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, length)
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], np.ascontiguousarray(values[order])
        _, first, node = np.unique(
            values.view(f"V{8 * length}").ravel(), return_index=True, return_inverse=True
        )
        place = np.argsort(np.argsort(first))  # nodes in the order of their smallest id
        node, originals = place[node], values[np.sort(first)]
        held = np.full((len(first), keep), -1, np.int64)
        given = np.zeros((len(first), keep), bool)
        used = np.zeros(len(first), np.int64)
        last = {}
        for n, i in zip(node.tolist(), ids.tolist()):
            if used[n] < keep and last.get(n) != i:
                held[n, used[n]], given[n, used[n]] = i, True
                used[n] += 1
                last[n] = i
        norms = np.sqrt((originals * originals).sum(1))
        units = (originals / norms[:, None]).astype(np.float32)
        graph = build_graph(units, links, width)
        return pa.table(
            {
                "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
                "length": pa.array([length], pa.int32()),
                "nodes": pa.array([len(first)], pa.int32()),
                "entry": pa.array([graph.entry], pa.int32()),
                "vectors": pa.array([originals.tobytes()], pa.binary()),
                "ids": pa.array([held.tobytes()], pa.binary()),
                "given": pa.array([given.tobytes()], pa.binary()),
                "flat": pa.array([[f.tobytes() for f in graph.flat]], pa.list_(pa.binary())),
                "row": pa.array([[r.tobytes() for r in graph.row[: len(graph.flat)]]], pa.list_(pa.binary())),
            }
        )

    schema = (
        "shard long, length int, nodes int, entry int, vectors binary, ids binary,"
        " given binary, flat array<binary>, row array<binary>"
    )
    # Shards are dealt out one to a task as far as tasks go; a shard is a bounded group.
    dealt = dealt.repartition(min(shards, 10_000), "shard", "length")
    return write_out(dealt.groupBy("shard", "length").applyInArrow(build, schema), "graphs")


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    links: int = LINKS,
    width: int = SEARCH_WIDTH,
    keep: int = 16,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each query."""
    if k >= keep:
        raise ValueError("an index must keep more ids per node than a search asks for")
    good = usable(queries, key, vector).distinct()
    blocks_ = max(1, -(-queries.count() // block_rows))
    packed = (
        good.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks_)))
        .groupBy("length", "block")
        .agg(F.collect_list(F.struct("id", "vector")).alias("queries"))
    )
    # A stated set of queries, in blocks, goes to every shard that has their length.
    shards = index.groupBy("length").agg(F.collect_set("shard").alias("shards"))
    tasks = min(max(1, index.count() * blocks_), 10_000)
    sent = (
        packed.join(shards, "length")
        .select("length", "queries", F.explode("shards").alias("shard"))
        .repartition(tasks, "length", "shard")
    )
    pairs = sent.join(index.repartition(tasks, "length", "shard"), ["length", "shard"]).select(
        "length", "nodes", "entry", "vectors", "ids", "given", "flat", "row",
        F.col("queries.id").alias("query_ids"), F.flatten("queries.vector").alias("query_vectors"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield _search_block({n: batch.column(n)[at] for n in batch.schema.names})

    def _search_block(cell: dict) -> pa.RecordBatch:
        length, nodes = cell["length"].as_py(), cell["nodes"].as_py()
        originals = np.frombuffer(cell["vectors"].as_py(), np.float64).reshape(nodes, length)
        held = np.frombuffer(cell["ids"].as_py(), np.int64).reshape(nodes, keep)
        given = np.frombuffer(cell["given"].as_py(), bool).reshape(nodes, keep)
        norms = np.sqrt((originals * originals).sum(1))
        flat = [
            np.frombuffer(f, np.int32).reshape(-1, 2 * links if level == 0 else links)
            for level, f in enumerate(cell["flat"].as_py())
        ]
        row = [np.frombuffer(r, np.int32) for r in cell["row"].as_py()]
        units = (originals / norms[:, None]).astype(np.float32)
        graph = Graph(units, links, flat, row, cell["entry"].as_py())
        out: list[tuple[int, int, float]] = []
        queries_ = cell["query_vectors"].values.to_numpy().reshape(-1, length)
        for query_id, query in zip(cell["query_ids"].as_py(), queries_):
            size = np.sqrt((query * query).sum())
            found = np.array(graph.search((query / size).astype(np.float32), max(width, k + 1)), int)
            score = (originals[found] * query).sum(1) / (norms[found] * size)
            near = [
                (-s, i)
                for s, ids, there in zip(score.tolist(), held[found], given[found])
                for i in ids[there].tolist()
                if i != query_id
            ]
            out += [(query_id, i, -s) for s, i in heapq.nsmallest(k, near)]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int64()),
                pa.array(columns[2], pa.float64()),
            ],
            names=["query_id", "vec_id", "score"],
        )

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
