"""The Jaccard join against all pairs of sets."""

import random

import numpy as np
import pytest

from sluice.llm import jaccard

from .helpers import LOWER, SCHEMA, doc, table, with_clashes, words


def shingles(text, k=4):
    found = words((text or "").translate(LOWER))
    if len(found) < k:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1))


def brute(rows, percent=85, k=4):
    """(n, component) of each row, and the linked pairs of different sets."""
    sets = [shingles(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = set()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
                if a != b:
                    pairs.add(frozenset((a, b)))
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(row[0], least.get(find(i), row[0]))
    return [(row[0], len(s), least.get(find(i))) for i, (row, s) in enumerate(zip(rows, sets))], pairs


def corpus(seed, groups=6, copies=8):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(300))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randrange(10, 120))]
        if rng.random() < 0.5:
            base = base[:5] + passage + base[5:]
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += ["a b", "A  b", "", None, " \t\n", "a", "x y z", "x y z w", "X y\x0bz W", "é ü x y", "É ü x y"]
    rng.shuffle(texts)
    return [doc(i, t) for i, t in enumerate(texts)]


def key(row):
    return tuple((x is None, x) for x in row)


def result(docs, **options):
    found = jaccard.near_duplicates(docs, **options).select("doc_id", "n", "component_id")
    return sorted((tuple(r) for r in found.collect()), key=key)


@pytest.mark.parametrize("part_tokens", [1 << 18, 150])
def test_equals_all_pairs(spark, tmp_path, part_tokens):
    rows = corpus(1)
    docs = table(spark, tmp_path, rows)
    assert result(docs, part_tokens=part_tokens) == sorted(brute(rows)[0], key=key)


@pytest.mark.parametrize("part_tokens", [1 << 18, 150])
def test_every_link(spark, tmp_path, part_tokens):
    rows = corpus(2)
    docs = table(spark, tmp_path, rows)
    members, classes, links = jaccard.join(docs, part_tokens=part_tokens)
    of = {r.digest: r.cls for r in classes.collect()}
    texts = {r[0]: shingles(r[1]) for r in rows}
    sets = {of[r.digest]: texts[r.doc_id] for r in members.collect() if r.digest}
    found = [(sets[r.a], sets[r.b], r.both) for r in links.collect()]
    assert len(found) == len({frozenset(x[:2]) for x in found})
    assert {frozenset(x[:2]) for x in found} == brute(rows)[1]
    assert all(len(a & b) == both for a, b, both in found)


def test_nulls_repeats_and_clashing_columns(spark, tmp_path):
    rows = [*corpus(3, 2, 3), doc(None, "one two three four five"), doc(None, "one two three four five"),
            doc(7, "ONE two three four five"), doc(7, "ONE two three four five"), doc(None, "alone " * 9)]
    rows += rows[:4]
    docs = table(spark, tmp_path, rows)
    assert result(with_clashes(docs)) == sorted(brute(rows)[0], key=key)


def test_empty_table(spark, tmp_path):
    assert result(table(spark, tmp_path, [])) == []
    assert result(table(spark, tmp_path, [doc(1, None), doc(2, "")])) == [(1, 0, 1), (2, 0, 2)]


def test_long_texts_are_read_in_stretches(monkeypatch):
    rng = random.Random(4)
    text = " ".join(str(rng.randrange(50)) for _ in range(3000)).encode() + b"  \n tail"
    whole = jaccard.token_set(text, 4)
    monkeypatch.setattr(jaccard, "STRETCH", 7)
    assert np.array_equal(jaccard.token_set(text, 4), whole)
    assert np.array_equal(jaccard.token_set(b"a  b", 4), jaccard.token_set(b"A b", 4))


@pytest.mark.parametrize("order", [0, 1, 2])
def test_linked_sets_share_leading_tokens(order):
    rng = np.random.default_rng(order)
    for size in (1, 2, 6, 7, 40, 400):
        base = np.unique(rng.integers(0, 2**64, size, np.uint64))
        for gone in range(len(base) * 15 // 100 + 1):
            other = base[gone:]
            if 100 * len(other) >= 85 * len(base):
                first = [set(jaccard.leading(x, order, 85).tolist()) for x in (base, other)]
                assert first[0] & first[1]


@pytest.mark.parametrize("seed", range(6))
def test_a_cell_finds_the_components_of_all_links(seed):
    rng = np.random.default_rng(seed)
    base = [rng.choice(10_000, 60, replace=False) for _ in range(3)]
    sets = [np.unique(np.where(rng.random(60) < rng.choice([0.02, 0.06, 0.1]), rng.integers(0, 10_000, 60),
                               base[i % 3])).astype(np.uint64) for i in range(60)]
    every = jaccard.compare(sets, 85, every=True)
    want = [(i, j, len(np.intersect1d(a, b))) for i, a in enumerate(sets) for j, b in enumerate(sets)
            if i < j and 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))]
    assert sorted(every) == want

    def components(pairs):
        root = list(range(60))
        for i, j, _ in pairs:
            a, b = root[i], root[j]
            root = [min(a, b) if x in (a, b) else x for x in root]
        return root

    forest = jaccard.compare(sets, 85)
    assert components(forest) == components(want)
    assert len(forest) == 60 - len(set(components(want)))


def test_one_group_of_near_copies_over_a_grid(spark, tmp_path):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(150):
        copy = list(base)
        copy[rng.randrange(80)] = f"x{i}"
        rows.append(doc(i, " ".join(copy)))
    docs = table(spark, tmp_path, rows)
    assert result(docs, part_tokens=1000) == sorted(brute(rows)[0], key=key)


def test_schema(spark, tmp_path):
    assert jaccard.near_duplicates(table(spark, tmp_path, [doc(1, "a")], SCHEMA)).columns == [
        "row", "doc_id", "n", "component_id",
    ]
