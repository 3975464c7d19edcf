"""Piece numbers against a plain best path through the whole text, and round trips."""

import random

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from sluice.llm import catalog, pieces

from .helpers import SCHEMA, doc, table, with_clashes

MODEL = pieces.Pieces.load()
TABLE = {p: (i, s) for p, i, s in MODEL.usable}


def best_path(text):
    if not text:
        return []
    text = " " + text
    best = [(0.0, None, None)]
    for end in range(1, len(text) + 1):
        found = None
        for start in range(max(0, end - MODEL.longest), end):
            part = text[start:end]
            hit = TABLE.get(part) or ((-1 - ord(part), MODEL.unknown) if end - start == 1 else None)
            if hit and (found is None or best[start][0] + hit[1] > found[0]):
                found = (best[start][0] + hit[1], start, hit[0])
        best.append(found)
    path, end = [], len(text)
    while end:
        _, end, i = best[end]
        path.append(i)
    out = []
    for i in reversed(path):
        out += [i] if i >= 0 else [MODEL.bytes_at[b] for b in chr(-1 - i).encode()]
    return out


ROWS = [
    doc(1, "Hello world, été\nx ▁y"), doc(2, ""), doc(3, None), doc(4, " "), doc(5, "   three  blanks   "),
    doc(None, "null id"), doc(None, "null id"), doc(6, "😀 漢字 \x00\t\r\n\x85  ﬁ"), doc(6, "twice"),
    doc(7, "a" * 120 + " " + "=" * 100), doc(8, "the quick brown fox " * 3000), doc(9, "ẞßſ Ünïcödé" * 40),
]


@pytest.mark.parametrize(("few", "block"), [(24 << 20, 16 << 20), (600, 3000), (0, 1)])
def test_best_paths_and_round_trip(spark, tmp_path, few, block):
    docs = with_clashes(table(spark, tmp_path, ROWS), but=("ids",))
    coded = pieces.encode(docs, MODEL, ("doc_id", "source"), few, block)
    found = pieces.decode(coded, MODEL).collect()
    got = sorted(((r.doc_id, r.text, r.ids) for r in found), key=str)
    assert got == sorted(((r[0], r[1] or "", best_path(r[1])) for r in ROWS), key=str)


def test_given_table(spark, folder):
    docs = catalog.table(spark, folder, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = pieces.decode(pieces.encode(docs, MODEL), MODEL).collect()
    assert {r.doc_id: r.text for r in found} == texts
    for r in found[:40]:
        assert r.ids == best_path(texts[r.doc_id])
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert all(library.decode(r.ids) == r.text for r in found[:40])


def test_long_segments_are_cut_and_come_back(spark, tmp_path):
    rows = [doc(1, "e" * 5000), doc(2, "=" * 129), doc(3, "x" * 127)]
    found = pieces.decode(pieces.encode(table(spark, tmp_path, rows), MODEL), MODEL).collect()
    assert {r.doc_id: r.text for r in found} == {r[0]: r[1] for r in rows}


def test_cuts_lie_where_no_piece_goes():
    words = ["Hello,", "a,b;c", "été\nx", "", "two", "ab" * 100, "", "😀x", "=" * 300]
    found, sizes = MODEL.cutter()(words)
    assert "".join(found) == " " + " ".join(words) and len(sizes) == len(words) and sum(sizes) == len(found)
    parts = iter(found)
    for word, size in zip(words, sizes):
        own = [next(parts) for _ in range(size)]
        assert "".join(own) == " " + word and max(map(len, own)) <= pieces.MAX_CHARS
        for a, b in zip(own, own[1:]):
            if len(a) < pieces.MAX_CHARS:
                assert not any(a[-1] + b[0] in p for p in TABLE)


def test_empty_table(spark, tmp_path):
    docs = table(spark, tmp_path, [], SCHEMA, 1)
    assert pieces.decode(pieces.encode(docs, MODEL), MODEL).count() == 0


def test_bytes_that_are_no_text(spark):
    frame = spark.createDataFrame([([MODEL.bytes_at[0x20], MODEL.bytes_at[0xFF]],), (None,)], "ids array<int>")
    assert [r.text for r in pieces.decode(frame, MODEL).collect()] == ["�", ""]


def test_blanks_have_the_pieces_of_the_model_file(spark, tmp_path):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    normal = {
        library.id_to_piece(i).replace("▁", " "): (i, library.get_score(i))
        for i in range(library.get_piece_size())
        if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))
    }
    assert TABLE == normal
    texts = ["x 9", "x  y", " été", "a   é", "    x = 1", "  ", " " * 40 + "x", "tail   ", "\n" + " " * 16]
    docs = table(spark, tmp_path, [doc(i, t) for i, t in enumerate(texts)])
    found = {r.doc_id: r.ids for r in pieces.encode(docs, MODEL).collect()}
    assert [found[i] for i in range(len(texts))] == [best_path(t) for t in texts]
    assert [found[i] for i in range(6)] == [library.encode(t) for t in texts[:6]]


def test_long_segments_have_the_best_path_of_the_whole(spark, tmp_path):
    draw = random.Random(5)
    base64 = "".join(draw.choice("ABCdefghij0123+/") for _ in range(5000))
    texts = ["e" * 5000, "=" * 5000, "a" + "-" * 1037, base64, "camelCaseName" * 400, " " * 5000 + "x", "漢" * 300]
    docs = table(spark, tmp_path, [doc(i, t) for i, t in enumerate(texts)])
    found = pieces.decode(pieces.encode(docs, MODEL), MODEL).collect()
    assert {r.doc_id: (r.text, r.ids) for r in found} == {i: (t, best_path(t)) for i, t in enumerate(texts)}


def test_segments_of_texts_are_those_of_their_words(monkeypatch):
    texts = ["Hello, été x", "  two  blanks   ", "a" * 50 + " b", " ", "😀漢字 =" + "=" * 99, "", "z  "] * 3
    cut = MODEL.segmenter()
    found, sizes = cut([(" " + t).encode() if t else b"" for t in texts])
    parts = iter(found.to_pylist())
    for text, size in zip(texts, sizes):
        own = [next(parts) for _ in range(size)]
        assert "".join(own) == (" " + text if text else "")
        for a, b in zip(own, own[1:]):
            assert not any(a[-1] + b[0] in p for p in TABLE)
    monkeypatch.setattr(pieces, "SLICE_BYTES", 20)
    again, counts = pieces._segmented(pa.array([*texts, None]), cut)
    assert [x for part in again for x in part.to_pylist()] == found.to_pylist()
    assert counts.tolist() == [*sizes.tolist(), 0]


def test_a_block_asks_each_shard_in_one_row(spark, tmp_path, monkeypatch):
    rows = [doc(i, f"word{i % 7} number{i} of été{i} and a b c {'=' * i}") for i in range(300)]
    docs = table(spark, tmp_path, rows)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "text")
    blocks = pieces.block_segments(numbered, MODEL, 2000)
    shards, n_blocks = 5, blocks.count()
    dealt = pieces._dealt(blocks, shards).collect()
    assert n_blocks < len(dealt) <= n_blocks * shards
    assert len({(r.block, r.shard) for r in dealt}) == len(dealt)
    per_block = {r.block: r["count"] for r in blocks.collect()}
    for block, count in per_block.items():
        numbers = sorted(n for r in dealt if r.block == block for n in pieces._numbers(r.number).tolist())
        assert numbers == list(range(count))
    held = {}
    for r in dealt:
        for word in pieces._unpacked(r.sizes, r.letters).to_pylist():
            assert held.setdefault(word, r.shard) == r.shard
    words = {r.word: r.n for r in pieces.segments(blocks, shards).collect()}
    assert words.keys() == held.keys() and sum(len(w) * n for w, n in words.items()) == sum(len(r[1]) + 1 for r in rows)
    monkeypatch.setattr(pieces, "SHARD_SEGMENTS", 50)
    for few in (0, 3000):
        found = {r.doc_id: r.ids for r in pieces.encode(docs, MODEL, frequent_bytes=few, block_bytes=2000).collect()}
        assert found == {r[0]: best_path(r[1]) for r in rows}
