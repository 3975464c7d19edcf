"""Quality rules, line dedup and licence scans against plain versions, with odd tables."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import catalog, licenses, lines, quality
from sluice.llm.skew import spread_join

from .helpers import LOWER, SCHEMA, doc, table, with_clashes, words

LONG = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    None, "", " \t\n\r\x0b\x0c", "one", LONG, LONG.upper(), "\x1f a\x1cb \x85 c d", "é ü 漢字 😀" * 30,
    "a b c a b c a b c", " ".join(["x y z"] * 40), "\n".join(["same line here"] * 9 + ["", " ", "other"]),
    "### $$$ &&& ||| <> " + LONG, "a" * 50_000, ("word " * 30_000).strip(), "a\r\nb\r\na\r\n",
]


def plain_quality(text):
    text = text or ""
    w = words(text)
    kept = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts = Counter(grams)
    covered = {p for i, g in enumerate(grams) if counts[g] > 1 for p in (i, i + 1, i + 2)}
    measured = (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(kept),
        len(kept) - len(set(kept)), len(covered),
    )
    n, chars, symbols, n_lines, dups, repeated = measured
    failed = [
        n < 50, 100 * repeated > 50 * n, 10 * symbols > n, 100 * dups > 50 * n_lines, chars > 100 * n,
    ]
    return *measured, sum(1 << i for i, f in enumerate(failed) if f)


def test_quality_measures_every_text(spark, tmp_path):
    rows = [doc(i, t) for i, t in enumerate(TEXTS)] + [doc(None, "x"), doc(3, "one"), doc(3, "one")]
    docs = with_clashes(table(spark, tmp_path, rows))
    found = [tuple(r) for r in quality.ledger(docs).collect()]
    wanted = [(r[0], *plain_quality(r[1])) for r in rows]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_quality_policies_and_ablation(spark, tmp_path):
    rows = [doc(i, t) for i, t in enumerate(TEXTS)]
    docs = with_clashes(table(spark, tmp_path, rows))
    bits = {r[0]: plain_quality(r[1])[-1] for r in rows}
    for policy in (quality.BASE, quality.DEFAULT, quality.STRICT):
        kept = {i for i, b in bits.items() if not b & policy.mask()}
        found = quality.keep_good(docs, policy)
        assert found.columns == docs.columns
        assert {r.doc_id for r in found.collect()} == kept
        for row in quality.ablation(quality.ledger(docs), policy).collect():
            bit = policy.mask() & (1 << [r.name for r in quality.RULES].index(row.rule))
            assert row.fails == sum(bool(b & bit) for b in bits.values())
            assert row.alone == sum(b & policy.mask() == bit for b in bits.values())
            assert row.kept == len(kept)


def plain_lines(rows, min_chars=40, min_docs=5):
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\r\x0b\x0c").translate(LOWER)
            if len(key) >= min_chars:
                held.setdefault(key, set()).add(i)
    out = []
    for i, text in rows:
        all_ = (text or "").split("\n")
        stay = []
        for line in all_:
            key = line.strip(" \t\n\r\x0b\x0c").translate(LOWER)
            at = held.get(key, set())
            last = max((x for x in at if x is not None), default=None)
            if not (len(at) >= min_docs and i != last):
                stay.append(line)
        out.append((i, "\n".join(stay), len(all_), len(all_) - len(stay)))
    return out


def test_line_dedup(spark, tmp_path):
    common = "É" + "this line is shared by a good many documents"
    short = "x" * 39
    edge = "ü" * 40
    rows = [(i, f"own {i}\n{common}\n  {common.lower()} \r\n{short}\n{edge if i < 5 else ''}") for i in range(8)]
    rows += [(1, common), (1, common), (None, f"{common}\nnull id"), (None, common), (50, None), (51, "")]
    rows += [(60, "\n".join([common] * 2000)), (61, "x" * 100_000), (62, "only four " * 5)]
    rows += [(i, "four documents have this line, which is too few") for i in (70, 71, 72, 73, 73, 73)]
    docs = with_clashes(table(spark, tmp_path, [doc(*r) for r in rows]))
    found = lines.dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
    assert sorted(got, key=str) == sorted(plain_lines(rows), key=str)


def test_line_dedup_takes_any_columns(spark, tmp_path):
    line = "a line that stands in all of these documents " * 2
    rows = [(i, f"{line}\nown {i}", i, "x", 1) for i in range(6)]
    docs = table(spark, tmp_path, rows, "doc_id long, text string, n_lines int, N_DROPPED string, `a.b` int")
    found = lines.dedup_lines(docs)
    assert found.columns == [*docs.columns, "_n_lines", "_n_dropped"]
    got = sorted(tuple(r) for r in found.collect())
    assert got == [(i, f"own {i}" if i < 5 else f"{line}\nown 5", i, "x", 1, 2, int(i < 5)) for i in range(6)]
    stage = corpus_pipeline.line_dedup(spark, docs, "")
    assert stage.columns == docs.columns and stage.count() == 6


def test_a_very_common_line_is_spread(spark, tmp_path):
    """The line of a third of all rows goes over several partitions, with the same result."""
    common = "this line stands in nearly every document of the table"
    rows = [(i, "\n".join([common, *[f"line {j} of {i % 40}, found in few documents of all" for j in range(2)]]))
            for i in range(400)]
    docs = table(spark, tmp_path, rows, "doc_id long, text string")
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in lines.dedup_lines(docs).collect()]
    assert sorted(got) == sorted(plain_lines(rows))
    hashes = lines.line_hashes(docs)
    side = hashes.groupBy("key").agg(F.count("*").alias("n")).withColumn("mark", F.lit(1))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        spread = spread_join(hashes, side, "key", "n").withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in spread.groupBy("p").count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 1200 and max(sizes) < 400


def plain_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_base_places(spark, tmp_path):
    texts = TEXTS + [
        "MIT License", "mit, license mit-license MIT\nLICENSE", "emit license", "mit licenses",
        "GNU General  Public_License; apache license apache license", "éMIT license mit license é",
        "general general public license public license", "x " * 5000 + "Apache License, Version 2.0",
    ]
    rows = [doc(i, t) for i, t in enumerate(texts)] + [doc(None, "mit license"), doc(0, None)]
    docs = with_clashes(table(spark, tmp_path, rows))
    found = licenses.summary(licenses.scan(docs)).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found]
    assert sorted(got, key=str) == sorted([(r[0], *plain_base(r[1])) for r in rows], key=str)
    assert all(0 <= r.score <= 1 and r.labels is not None for r in found)
    assert all((r.score > 0) == (r.labels != "") for r in found)


@pytest.mark.parametrize(
    ("text", "names", "free"),
    [
        ("MIT", {"mit"}, True),
        (" GPL-3.0-only OR MIT */", {"gpl-3.0-only", "mit"}, True),
        ("GPL-2.0+ AND MIT", {"gpl-2.0+", "mit"}, False),
        ("MIT AND (Apache-2.0 OR GPL-2.0)", {"mit", "apache-2.0", "gpl-2.0"}, True),
        ("MIT OR GPL-2.0 AND GPL-3.0", {"mit", "gpl-2.0", "gpl-3.0"}, True),
        ("(MIT OR GPL-2.0) AND GPL-3.0", {"mit", "gpl-2.0", "gpl-3.0"}, False),
        ("GPL-2.0 WITH Classpath-exception-2.0 OR MIT", {"gpl-2.0", "mit"}, True),
        ("Apache-2.0 WITH LLVM-exception and mit", {"apache-2.0", "mit"}, True),
        ("MIT see the file", {"mit"}, True),
    ],
)
def test_license_expressions(text, names, free):
    assert licenses.evaluate(licenses.to_postfix(text)) == (frozenset(names), free)


@pytest.mark.parametrize("text", ["", "AND MIT", "MIT AND", "(MIT", "MIT OR OR GPL-2.0", "()", "*"])
def test_broken_license_expressions(text):
    postfix = licenses.to_postfix(text)
    assert postfix is None or licenses.evaluate(postfix) is None


def test_license_tags(spark, tmp_path):
    rows = [
        doc(1, "# SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode"),
        doc(2, "// spdx-license-identifier: GPL-2.0-only WITH Classpath-exception-2.0 */"),
        doc(3, "SPDX-License-Identifier:"),
        doc(4, "Released under the MIT License."),
        doc(5, "SPDX-License-Identifier: the file\nSPDX-License-Identifier: see LICENSE"),
        doc(6, "license-identifier: GPL-2.0+\nSPDX-license-identifier: ISC"),
    ]
    found = {
        r.doc_id: r for r in licenses.summary(licenses.scan(table(spark, tmp_path, rows))).collect()
    }
    assert (found[1].labels, found[1].permissive) == ("apache-2.0,mit", True)
    assert (found[2].labels, found[2].permissive) == ("gpl-2.0-only", False)
    assert (found[3].labels, found[3].permissive) == ("unknown-expression", False)
    assert (found[4].labels, found[4].base_labels, found[4].permissive) == ("mit", "mit", None)
    assert [found[i].n_expressions for i in range(1, 7)] == [1, 1, 1, 0, 2, 2]
    assert found[5].labels == "unknown-expression" and found[6].labels == "gpl-2.0+,isc"
    assert found[1].score > found[4].score > found[3].score > 0


def test_empty_tables(spark, tmp_path):
    docs = table(spark, tmp_path, [], SCHEMA, 1)
    assert quality.ledger(docs).count() == quality.keep_good(docs).count() == 0
    assert {r.fails for r in quality.ablation(quality.ledger(docs)).collect()} == {0}
    assert lines.dedup_lines(docs).count() == 0
    assert licenses.summary(licenses.scan(docs)).count() == 0


def test_line_digest_is_of_the_text(spark, folder):
    found = catalog.op9_line_dedup(spark, folder).filter("n_dropped = 0").limit(5).collect()
    docs = {r.doc_id: r.text for r in catalog.table(spark, folder, "documents").collect()}
    assert all(r.kept_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest() for r in found)
