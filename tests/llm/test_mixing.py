"""The mix against a plain loop over sources and documents."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.llm import mixing

from .helpers import SCHEMA, doc, table, with_clashes, words


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Share the budget by weight; hand the excess over limits on until there is none."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, budget, free = {}, share * sum(sizes.values()), set(names)
    while free:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: float(most * sizes[s]) for s in over}
        free -= over
    return target


def rows_of(sizes):
    rows, i = [], 0
    for source, lengths in sizes.items():
        for n in lengths:
            rows.append(doc(i, " ".join(["w"] * n) if n is not None else None, source))
            i += 1
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": [5, 3, 8] * 9, "b": [40, 1] * 8, "c": [7] * 3, None: [2, 9, 4]},
        {"b": [100], "a": [1], "é": [3, 3], "Z": [500, 0, None]},
        {"only": [4, 4, 4]},
        {"a": [0, None], "b": [None]},
        {"a": [10] * 50, "b": [10] * 50, "c": [10] * 50},
    ],
)
def test_targets_and_readings(spark, tmp_path, sizes):
    docs = with_clashes(table(spark, tmp_path, rows_of(sizes)), but=("size",))
    found = mixing.assign(docs, keep=("doc_id", "source")).collect()
    total = {s: sum(n or 0 for n in ns) for s, ns in sizes.items()}
    target = plain_targets(total)
    taken = dict.fromkeys(total, 0)
    for r in found:
        source = r.row.source
        assert r.source_size == total[source]
        assert r.target == pytest.approx(target[source])
        assert 0 <= r.passes <= 2 and len(r.moments) == r.passes
        assert all(0 <= m <= 1 for m in r.moments) and r.moments == sorted(r.moments)
        taken[source] += r.passes * r["size"]
    longest = max((n or 0 for ns in sizes.values() for n in ns), default=0)
    for source in total:
        assert abs(taken[source] - target[source]) <= longest / 2 + 1e-6
    assert sum(target.values()) == pytest.approx(1.5 * sum(total.values()))


def test_reruns_and_file_layout_agree(spark, tmp_path):
    rows = rows_of({"a": [5, 3, 8] * 30, "b": [4, 1] * 20, None: [6] * 7})
    first = table(spark, tmp_path, rows, parts=1)
    second = table(spark, tmp_path, rows[::-1], parts=5)
    a, b = (sorted(map(str, mixing.assign(d).collect())) for d in (first, second))
    assert a == b


def test_curriculum_repeats_rows_in_order(spark, tmp_path):
    rows = rows_of({"a": [5, 3, 8] * 30, "b": [4, 1] * 20})
    docs = with_clashes(table(spark, tmp_path, rows), but=("size", "range", "row"))
    passes = {r.row.doc_id: r.passes for r in mixing.assign(docs).collect()}
    moments = {r.row.doc_id: list(r.moments) for r in mixing.assign(docs).collect()}
    order = mixing.curriculum(docs)
    assert order.columns == docs.columns
    ids = [r.doc_id for r in order.collect()]
    assert {i: ids.count(i) for i in passes} == passes
    due = [moments[i].pop(0) for i in ids]
    assert due == sorted(due)


def test_schedule_inverts_its_integral(spark):
    for start, end in ((2.0, 1.0), (1.0, 1.0), (1.0, 2.0), (0.0, 1.0), (1.0, 0.0)):
        share = F.col("id") / 10.0
        rows = spark.range(11).select(share.alias("u"), mixing.due_moment(share, F.lit(start), F.lit(end)).alias("t"))
        for r in rows.collect():
            area = start * r.t + (end - start) * r.t**2 / 2
            assert area == pytest.approx(r.u * (start + end) / 2)


def test_odd_rows(spark, tmp_path):
    rows = [doc(None, "a b c", "s"), doc(None, "d e f g", "s"), doc(1, "x y", "s"), doc(1, "x y", "s")]
    rows += [doc(2, "long " * 20_000, None), doc(3, "", ""), doc(4, None, "")]
    found = mixing.assign(table(spark, tmp_path, rows)).collect()
    assert sorted(r["size"] for r in found) == sorted(len(words(r[1])) for r in rows)
    assert mixing.assign(table(spark, tmp_path, [], SCHEMA, 1)).count() == 0
    assert mixing.curriculum(table(spark, tmp_path, [], SCHEMA, 1)).count() == 0


def test_order_key_is_a_hash_of_the_id(spark, tmp_path):
    found = mixing.assign(table(spark, tmp_path, [doc(7, "a")])).first()
    assert found.spot == hashlib.md5(b"7/mix").hexdigest()


def test_no_python_in_the_plan(spark, tmp_path):
    docs = table(spark, tmp_path, rows_of({"a": [5, 3]}))
    for frame in (mixing.assign(docs), mixing.curriculum(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
