"""Fill-in-the-middle against slicing of Python strings."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import fim

from .helpers import doc, table, with_clashes


def plain(text, key, rate=90, spm=20, seed=1):
    text = text or ""
    digits = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    x, y, z = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return (n, "spm", a, b - a, f"<S>{z}<P>{x}<M>{y}")
    return (n, "psm", a, b - a, f"<P>{x}<S>{z}<M>{y}")


def texts(seed=0):
    rng = random.Random(seed)
    letters = "ab é\n日🙂<>PSM"
    passage = "".join(rng.choice(letters[:7]) for _ in range(2500))
    out = [None, "", "a", "é", "🙂", "<P", "P>", "<S>", "x<M>y", "<<S", "a<", passage, passage * 3, "a" * 20_000]
    for _ in range(60):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(400)))
        out.append(text + passage if rng.random() < 0.5 else passage[:700] + text + passage)
    return out


def test_equals_slicing(spark, tmp_path):
    rows = [doc(i, t) for i, t in enumerate(texts())] + [doc(None, "no key at all"), doc(3, "é"), doc(3, "é")]
    docs = table(spark, tmp_path, rows)
    made = fim.transform(with_clashes(docs), keep=("doc_id", "text"))
    found = made.select("*", fim.restore(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.text, r.doc_id)
        assert r.back == (r.text or "")
    assert {r.form for r in found} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_restore_next_to_markers(spark, form):
    parts = [("<", "S>", "<"), ("<S", "<", "M>"), ("", "", "<P"), ("a", "", ""), ("P>", "<M", "<S")]
    rows = [("".join((a, b, c)), f"<P>{a}<S>{c}<M>{b}" if form == "psm" else f"<S>{c}<P>{a}<M>{b}") for a, b, c in parts]
    frame = spark.createDataFrame(rows, "text string, output string")
    found = frame.select("text", fim.restore(F.col("output"), F.lit(form)).alias("back")).collect()
    assert all(r.text == r.back for r in found)


def test_empty_table(spark, tmp_path):
    assert fim.transform(table(spark, tmp_path, [])).collect() == []


def test_chunks_are_cut_by_content(monkeypatch):
    rng = np.random.default_rng(1)
    passage = rng.integers(32, 127, 20_000, np.uint8).tobytes()
    a, b = b"start " + passage, rng.integers(32, 127, 777, np.uint8).tobytes() + passage + b" end"
    chunks = [{t[i:j] for i, j in zip([0, *fim.chunk_ends(t)], fim.chunk_ends(t))} for t in (a, b)]
    assert len(chunks[0] & chunks[1]) >= 0.9 * len(chunks[0])
    for text in (a, b, b"a" * 50_000, b""):
        ends = fim.chunk_ends(text)
        sizes = np.diff([0, *ends])
        assert (ends[-1:] or [0]) == [len(text)]
        assert not len(sizes) or (sizes.max() <= fim.MOST and (len(sizes) == 1 or sizes[:-1].min() >= fim.LEAST))
    whole = fim.chunk_ends(b)
    monkeypatch.setattr(fim, "STRETCH", 1000)
    assert fim.chunk_ends(b) == whole


def test_counts_of_chunks_find_every_unit():
    rng = random.Random(2)
    text = "".join(rng.choice("aé日🙂") for _ in range(5000))
    data = text.encode()
    cut = fim.Chunked.of(data, fim.Cache())
    assert cut.whole.units == len(text) and len(cut.ends) > 3
    for k in [0, 1, 2, 999, 4999, 5000]:
        assert cut.place(k) == len(text[:k].encode())


def test_markers_across_borders(monkeypatch):
    for gap in range(1, 5):
        monkeypatch.setattr(fim, "chunk_ends", lambda t, gap=gap: [*range(gap, len(t), gap), len(t)])
        for text, held in ((b"ab<S>cd", True), (b"<M>", True), (b"<S<P<M", False), (b"x<P>", True), (b"< P>", False)):
            assert fim.Chunked.of(text, fim.Cache()).whole.marked == held


def test_the_cache_checks_content_and_stays_small(monkeypatch):
    cache = fim.Cache(limit=1000)
    monkeypatch.setattr(fim.xxhash, "xxh3_64_intdigest", lambda chunk: 1)  # everything collides
    assert cache.get("é".encode()).units == 1
    assert cache.get(b"<P>").marked and cache.get(b"abc").units == 3
    monkeypatch.undo()
    for i in range(1000):
        cache.get(b"%05d" % i * 20)
    assert sum(len(c) for c, _ in [*cache.new.values(), *cache.old.values()]) < 2 * 1000 + 400
    before = cache.hits
    cache.get(b"%05d" % 999 * 20)
    assert cache.hits == before + 1
