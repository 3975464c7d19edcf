"""The pipeline against its stages done by hand, and the driver's view of the folder."""

import subprocess
import sys

import corpus_pipeline
from sluice.llm import lines, pieces, quality
from sluice.sources.staging import app_folder, drop_path

from .helpers import doc, table
from .test_filters import plain_lines, plain_quality
from .test_mixing import plain_targets
from .test_pieces import best_path
from .test_simhash import plain_print, plain_roots


def corpus():
    """Clean texts, near copies, short and noisy ones, shared lines, and odd rows."""
    word = lambda i, j: f"w{(i * 7919 + j * 104729) % 9973}"
    text = lambda i, n=80: " ".join(word(i, j) for j in range(n))
    shared = "this line is found at the end of a good many documents"
    rows = [doc(i, f"{text(i)}\n{shared}", f"s{i % 4}") for i in range(24)]
    rows += [doc(100 + i, text(3, 400 + i) + " tail", "s1") for i in range(4)]
    rows += [doc(200, "too short", "s0"), doc(201, None, "s0"), doc(202, "", None), doc(203, "x y z " * 60, "s2")]
    rows += [doc(204, text(50) + " ###" * 40, "s3"), doc(205, text(51), None), doc(206, text(51), "s0")]
    rows += [doc(207, text(52), "s1"), doc(207, text(52), "s1"), doc(None, text(53), "s2")]
    return rows


def by_hand(rows):
    """Rows (doc_id, source, text) that each stage leaves, up to the mix."""
    mask = quality.DEFAULT.mask()
    kept = [r for r in rows if not plain_quality(r[1])[-1] & mask]
    texts = plain_lines([(r[0], r[1]) for r in kept])
    kept = [(r[0], r[3], t[1]) for r, t in zip(kept, texts)]
    prints = [plain_print(r[2]) for r in kept]
    nodes = sorted(set(prints))
    near = [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if (a ^ b).bit_count() <= 4]
    roots = plain_roots(nodes, near)
    groups = {}
    for r, p in zip(kept, prints):
        groups.setdefault(roots[p], []).append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def test_stages_by_hand(spark, tmp_path):
    rows = corpus()
    table(spark, tmp_path, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    wanted = by_hand(rows)
    got = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts = {r[0]: r[2] for r in wanted}
    assert all(r.ids == best_path(texts[r.doc_id]) for r in found)
    sizes = {}
    for r in wanted:
        sizes[r[1]] = sizes.get(r[1], 0) + len(r[2].split())
    target = plain_targets(sizes)
    longest = max(len(r[2].split()) for r in wanted)
    for source in sizes:
        read = sum(len(texts[r.doc_id].split()) for r in found if r.source == source)
        assert abs(read - target[source]) <= longest / 2 + 1e-6
    ids = [r.doc_id for r in found]
    assert max(ids.count(i) for i in ids) <= 2


def test_run_leaves_its_result_only(spark, folder):
    drop_path(spark, app_folder(spark))
    found = corpus_pipeline.run(spark, folder)
    assert found.count() > 0
    system = spark._jvm.org.apache.hadoop.fs.Path(app_folder(spark)).getFileSystem(spark._jsc.hadoopConfiguration())
    held = [f.getPath().getName() for f in system.listStatus(spark._jvm.org.apache.hadoop.fs.Path(app_folder(spark)))]
    assert [name.rsplit("-", 1)[0] for name in held] == ["stage-4"]


def test_clean_documents_stay(spark, folder):
    """No document of good quality is rejected for anything but its length."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").select("doc_id")
    books = quality.apply_policy(quality.ledger(docs)).join(good, "doc_id")
    assert books.filter("NOT kept AND NOT array_contains(rejected_by, 'few_words')").count() == 0


def test_rest_works_without_the_folder(tmp_path):
    """The driver's module imports, and offers the other queries, when the folder is gone."""
    code = (
        "import sys; sys.modules['sluice.llm'] = None; sys.modules['corpus_pipeline'] = None;"
        "import __spark_entry__ as e; names = e.queries();"
        "assert len(names) >= 49 and 'preprocess' in names and not any(n.startswith('op') for n in names);"
        "assert set(e.oracle_sql()) <= set(names)"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])


def test_every_operator_has_its_query():
    from sluice.llm.catalog import QUERIES, SQL

    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(SQL) <= set(QUERIES) and len(corpus_pipeline.STAGES) == 5
    assert lines and pieces
