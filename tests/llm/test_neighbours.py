"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from sluice.llm import catalog, neighbours

from .helpers import table, with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, queries, k=5):
    good = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    unit = lambda a, b: float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
    out = {}
    for q in queries:
        for a in good.get(q, ()):
            near = {(-unit(a, b), i) for i, vs in good.items() if i != q for b in vs if len(a) == len(b)}
            out.setdefault(q, set()).update(near)
    return {q: sorted(near)[:k] for q, near in out.items()}


def found_by(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def compare(found, wanted):
    assert set(found) == {q for q, near in wanted.items() if near}
    for q, rows in found.items():
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert [r[1] for r in rows] == [i for _, i in wanted[q]]
        assert [r[2] for r in rows] == pytest.approx([-s for s, _ in wanted[q]], abs=1e-12)


def test_odd_vectors(spark, tmp_path):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=8).tolist(), 0) for i in range(60)]
    rows += [(100, None, 0), (150, [0.0] * 8, 0), (200, [None] + [1.0] * 7, 0), (250, [float("nan")] * 8, 0)]
    rows += [(300, [float("inf")] + [1.0] * 7, 0), (350, [], 0), (None, [1.0] * 8, 0), (400, [1.0, 2.0], 0), (401, [2.0, 1.0], 0)]
    rows += [(500 + i, [1.0] * 8, 0) for i in range(40)] + [(550, [1.0] * 8, 0), (550, [1.0] * 8, 0), (-50, rows[0][1], 0)]
    vectors = with_clashes(table(spark, tmp_path, rows, SCHEMA))
    for shard_rows in (4096, 16):
        index = neighbours.build_index(vectors, shard_rows=shard_rows)
        found = neighbours.search(index, vectors.filter("vec_id % 50 = 0"), block_rows=3)
        compare(found_by(found), exact(rows, [i for i, *_ in rows if i is not None and i % 50 == 0]))


def test_few_candidates_and_empty_table(spark, tmp_path):
    rows = [(0, [1.0, 0.0], 0), (7, [0.0, 1.0], 0), (3, [1.0, 1.0], 0)]
    vectors = table(spark, tmp_path, rows, SCHEMA)
    compare(found_by(neighbours.search(neighbours.build_index(vectors), vectors)), exact(rows, [0, 3, 7]))
    none = table(spark, tmp_path, [], SCHEMA, 1)
    assert neighbours.search(neighbours.build_index(none), none).count() == 0
    lone = table(spark, tmp_path, rows[:1], SCHEMA)
    assert neighbours.search(neighbours.build_index(lone), lone).count() == 0
    with pytest.raises(ValueError):
        neighbours.search(neighbours.build_index(lone), lone, k=16)


def test_recall_on_vectors_without_structure(spark, tmp_path):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=24).tolist(), 0) for i in range(3000)]
    vectors = table(spark, tmp_path, rows, SCHEMA)
    index = neighbours.build_index(vectors, shard_rows=1000)
    queries = list(range(0, 3000, 50))
    found = found_by(neighbours.search(index, vectors.filter("vec_id % 50 = 0")))
    wanted = exact(rows, queries)
    hits = sum(len({i for _, i in wanted[q]} & {r[1] for r in found[q]}) for q in queries)
    assert hits / (5 * len(queries)) >= 0.9


def test_recall_on_the_given_table(spark, folder):
    rows = [(r.vec_id, list(r.embedding)) for r in catalog.table(spark, folder, "embeddings").collect()]
    wanted = exact(rows, [i for i, _ in rows if i % 50 == 0])
    found = found_by(catalog.op5_neighbours(spark, folder))
    hits = sum(len({i for _, i in near} & {r[1] for r in found[q]}) for q, near in wanted.items())
    assert hits / sum(map(len, wanted.values())) >= 0.9


def test_graph_is_flat_and_linked():
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=(400, 8))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    graph = neighbours.build_graph(vectors.astype(np.float32))
    assert [f.ndim for f in graph.flat] == [2] * len(graph.flat) and len(graph.flat) > 1
    seen, ahead = {graph.entry}, [graph.entry]
    while ahead:
        for n in graph.near(0, ahead.pop()).tolist():
            if n not in seen:
                seen.add(n)
                ahead.append(n)
    assert len(seen) >= 395
