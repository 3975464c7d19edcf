"""Suffix arrays, common prefixes and removed repeats against plain versions."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from sluice.llm import repeats, suffixes

from .helpers import SCHEMA, doc, table, with_clashes


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_suffix_array_and_prefixes(letters):
    draw = np.random.default_rng(letters)
    for _ in range(300):
        codes = draw.integers(0, letters, int(draw.integers(1, 60))).astype(np.uint8)
        text = bytes(codes)
        order = sorted(range(len(text)), key=lambda i: text[i:])
        assert suffixes.suffix_array(codes).tolist() == order
        assert suffixes.suffix_array(codes.astype(np.int64), 300).tolist() == order
        length = int(draw.integers(1, 6))
        shared = suffixes.repeats_before(codes, np.array(order), length, int(draw.integers(1, 9)))
        same = lambda a, b: text[a : a + length] == text[b : b + length] and max(a, b) + length <= len(text)
        assert shared.tolist() == [False] + [same(a, b) for a, b in zip(order, order[1:])]


def test_suffix_array_of_a_larger_text():
    text = (b"banana bandana " * 400 + b"cabana") * 2
    array = suffixes.suffix_array(np.frombuffer(text, np.uint8))
    assert sorted(array.tolist()) == list(range(len(text)))
    assert all(text[a : a + 13000] < text[b : b + 13000] for a, b in zip(array[:2000], array[1:2001]))


def plain(rows, length):
    counts = Counter()
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        counts.update(b[p : p + length] for p in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, data):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if counts[b[p : p + length]] > 1:
                gone[p : p + length] = True
        edge = np.diff(np.concatenate([[0], gone.view(np.int8)]))
        out.append((i, len(b), int(gone.sum()), int((edge == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


def made_up():
    draw = np.random.default_rng(3)
    text = lambda n: "".join(draw.choice(list("abcdefé \n"), n))
    passage, other = text(180), text(75)
    rows = [(i, text(int(draw.integers(0, 200))) + passage[: 70 + 3 * i] + text(90)) for i in range(25)]
    rows += [(30 + i, other[i % 3 :] + text(50) + passage[20:150]) for i in range(25)]
    rows += [(100, passage), (101, passage), (101, passage), (None, other), (102, None), (103, ""), (104, "a")]
    rows += [(105, "a" * 500), (106, "xyz" * 120), (107, text(64)), (108, text(63)), (109, "b" * 65 + "c" * 65)]
    return rows


@pytest.mark.parametrize("shard_bytes", [repeats.SHARD_BYTES, 2000, 500])
def test_removed_repeats(spark, tmp_path, shard_bytes):
    rows = made_up()
    docs = with_clashes(table(spark, tmp_path, [doc(*r) for r in rows]))
    found = repeats.drop_repeats(docs, 64, shard_bytes).collect()
    got = [
        (r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in found
    ]
    assert sorted(got, key=str) == plain(rows, 64)


def test_a_common_passage_is_split_over_shards(spark, tmp_path):
    draw = np.random.default_rng(8)
    passage = "".join(draw.choice(list("abcdefgh"), 90))
    rows = [(i, "".join(draw.choice(list("ijkl"), 80)) + passage + "".join(draw.choice(list("mnop"), 80))) for i in range(150)]
    rows.append((500, passage[:70] + "q" * 80))
    docs = table(spark, tmp_path, [doc(*r) for r in rows])
    found = repeats.drop_repeats(docs, 64, 1500).collect()
    got = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in found]
    assert sorted(got, key=str) == plain(rows, 64)


def test_no_repeats_and_empty_table(spark, tmp_path):
    docs = table(spark, tmp_path, [], SCHEMA, 1)
    assert repeats.drop_repeats(docs).count() == 0
    lone = table(spark, tmp_path, [doc(1, "x" * 399), doc(2, "some text")])
    assert {(r.doc_id, len(r.spans)) for r in repeats.drop_repeats(lone).collect()} == {(1, 0), (2, 0)}


def test_digest_columns(spark, folder):
    from sluice.llm import catalog

    docs = {r.doc_id: (r.text or "").encode() for r in catalog.table(spark, folder, "documents").collect()}
    found = catalog.op4_repeats(spark, folder).collect()
    assert {r.doc_id: r.n_bytes for r in found} == {i: len(b) for i, b in docs.items()}
    whole = [r for r in found if not r.n_spans]
    assert whole and all(r.kept_sha256 == hashlib.sha256(docs[r.doc_id]).hexdigest() for r in whole)
    assert any(r.n_removed for r in found)
    assert all(r.kept_text == docs[r.doc_id].decode() for r in whole)


@pytest.mark.parametrize("shard_bytes", [repeats.SHARD_BYTES, 2000])
def test_runs_are_cut_at_a_fixed_length(spark, tmp_path, monkeypatch, shard_bytes):
    # The functions travel with the job, with the values that the names have then.
    monkeypatch.setattr(repeats, "RUN_STARTS", 50)
    monkeypatch.setattr(repeats, "STRETCH_STARTS", 170)
    counts = repeats.text_runs(b"a" * 1000, 64)[3]
    assert counts.max() == 50 and counts.sum() == 937
    rows = [*made_up(), (200, "ab" * 700), (201, "q" + "abc" * 300 + "r"), (202, "z" * 1500)]
    docs = table(spark, tmp_path, [doc(*r) for r in rows])
    found = repeats.drop_repeats(docs, 64, shard_bytes).collect()
    got = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in found]
    assert sorted(got, key=str) == plain(rows, 64)


def test_a_long_text_of_one_byte(spark, tmp_path):
    docs = table(spark, tmp_path, [doc(1, "a" * 20_000_000), doc(2, "b" * 399), doc(3, "a" * 400)])
    found = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], len(r.kept)) for r in repeats.drop_repeats(docs).collect()}
    assert found == {1: (20_000_000, [(0, 20_000_000)], 0), 2: (399, [], 399), 3: (400, [(0, 400)], 0)}
