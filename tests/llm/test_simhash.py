"""Fingerprints, anchors, links and components against plain versions."""

import numpy as np
import pytest
import xxhash

from sluice.llm import simhash
from sluice.llm.components import connected_components

from .helpers import LOWER, SCHEMA, doc, table, with_clashes, words


def plain_print(text, shingle=4):
    w = words((text or "").translate(LOWER))
    parts = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", ["", "one", "A b c", "a b c d", "É x\x1cy " * 50, "w " * 40_000, "a b c d e f g"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_print(text)


def test_home_is_the_only_anchor_within_one():
    every = np.arange(1 << 15, dtype=np.uint64)
    home = simhash.home(every)
    assert np.bitwise_count(every ^ home).max() == 1
    anchors = np.unique(home)
    assert len(anchors) == 1 << 11 and (simhash.home(anchors) == anchors).all()


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4, 5, 6])
def test_close_fingerprints_meet_at_an_anchor(max_bits):
    draw = np.random.default_rng(max_bits)
    x = draw.integers(0, 1 << 64, 300, np.uint64)
    y = x.copy()
    for _ in range(max_bits):
        y ^= np.uint64(1) << draw.integers(0, 64, 300).astype(np.uint64)
    a = simhash.replicate(x, max_bits)
    b = simhash.replicate(y, max_bits)
    homes = {(n, r) for n, r, h in zip(*map(np.ndarray.tolist, a)) if h}
    probes = set(zip(b[0].tolist(), b[1].tolist()))
    met = {r for n, r in homes & probes}
    assert met == set(range(300))


@pytest.mark.parametrize("anchor_rows", [simhash.ANCHOR_ROWS, 3])
def test_components_equal_all_pairs(spark, tmp_path, anchor_rows):
    draw = np.random.default_rng(5)
    # Chains and dense balls around a few centres, and far-off points.
    bits = set(draw.integers(0, 1 << 64, 60, np.uint64).tolist()) | {0, 1, 3}
    for centre in list(bits)[:6]:
        at = centre
        for step in range(25):
            at ^= 1 << int(draw.integers(64))
            bits.add(at)
            bits.add(centre ^ (1 << int(draw.integers(64))))
    nodes = sorted(bits)
    linked = [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if (a ^ b).bit_count() <= 4]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = table(spark, tmp_path, [(signed(x),) for x in nodes], "bits long")
    found = simhash.links(frame, 4, anchor_rows)
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in found.collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    assert plain_roots(nodes, pairs) == plain_roots(nodes, linked)
    roots = {r.node % (1 << 64): r.root for r in connected_components(found).collect()}
    groups = {}
    for n, r in plain_roots(nodes, linked).items():
        groups.setdefault(r, set()).add(n)
    for members in groups.values():
        if len(members) > 1:
            assert {roots[m] for m in members} == {min(map(signed, members))}


def near_texts():
    base = " ".join(f"w{i}" for i in range(400))
    rows = [doc(10 + i, base.replace(f"w{i * 7}", "changed")) for i in range(8)]
    rows += [doc(i, base) for i in (40, 5, 5, 41)] + [doc(60, None), doc(61, ""), doc(62, " \n")]
    rows += [doc(None, base), doc(None, "quite alone here"), doc(None, "quite alone here")]
    rows += [doc(80, "z" * 30_000), doc(81, "other words " * 5000), doc(82, "A b C"), doc(83, "a B c")]
    return rows


def test_documents_and_the_one_that_stays(spark, tmp_path):
    rows = near_texts()
    docs = with_clashes(table(spark, tmp_path, rows))
    prints = {}
    for r in rows:
        prints.setdefault(plain_print(r[1]), []).append(r[0])
    nodes = sorted(prints)
    linked = [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if (a ^ b).bit_count() <= 4]
    roots = plain_roots(nodes, linked)
    least = {}
    for n in nodes:
        least.setdefault(roots[n], []).extend(x for x in prints[n] if x is not None)
    wanted = sorted(
        ((r[0], plain_print(r[1]), min(least[roots[plain_print(r[1])]], default=None)) for r in rows), key=str
    )
    found = simhash.near_duplicates(docs)
    got = [(r.doc_id, r.bits % (1 << 64), r.component_id) for r in found.collect()]
    assert sorted(got, key=str) == wanted
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted((min(x, default=None) for x in least.values()), key=str)


def test_empty_table(spark, tmp_path):
    docs = table(spark, tmp_path, [], SCHEMA, 1)
    assert simhash.near_duplicates(docs).count() == simhash.keep_one(docs).count() == 0


def test_long_chain_of_links(spark, tmp_path):
    frame = table(spark, tmp_path, [(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.root for r in connected_components(frame).collect()} == {0}
