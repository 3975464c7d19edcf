"""One query per operator of this folder, over the whole of its table, and the SQL of those SQL can say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.staging import new_path
from . import (
    fim, jaccard, licenses, lines, mixing, neighbours, ngrams, pieces, prefixes, quality, repeats, simhash, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, folder, "documents")))


@query
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece numbers of every text, and whether decoding them gives the text back."""
    model = pieces.Pieces.load()
    decoded = pieces.decode(pieces.encode(table(spark, folder, "documents"), model), model)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path, min_bytes=1000)
    found = warc.digests(warc.read_archives(spark, path))
    return found.select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


SQL["op3_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes
  FROM pages),
h AS (SELECT html, max(page_id) AS holder FROM p WHERE payload_bytes >= 1000 GROUP BY html),
j AS (
  SELECT p.*, CASE WHEN holder <> page_id THEN holder END AS refers_to
  FROM p LEFT JOIN h ON p.html = h.html)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM j
"""


@query
def op4_repeats(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = repeats.drop_repeats(table(spark, folder, "documents"), length=400)
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"]
    )
    return cleaned.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # What stays can be read; a character that lost some of its bytes shows as U+FFFD.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


@query
def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    index = neighbours.build_index(vectors)
    return neighbours.search(index, vectors.filter("vec_id % 50 = 0"), k=5)


@query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, max_bits=4)
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    books = quality.apply_policy(quality.ledger(table(spark, folder, "documents")))
    base = F.lit(quality.BASE.mask()).cast("long")
    return books.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("bits").bitwiseAND(base) != 0).alias("base_failed"), "kept", "n_lines", "bits",
    )


SQL["op7_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
g AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS i,
         unnest(list_transform(range(1, len(ws) - 1),
           lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS g
  FROM w WHERE len(ws) >= 3),
f AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
c AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM f WHERE n > 1) GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines
  FROM w LEFT JOIN c USING (r)),
b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
           + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
           + CASE WHEN word_chars > 100 * n_words THEN 16 ELSE 0 END)::BIGINT AS bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (bits & 3) <> 0 AS base_failed, (bits & 15) = 0 AS kept, n_lines, bits
FROM b
"""


@query
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.assign(table(spark, folder, "documents"))
    first = F.round(F.get("moments", F.lit(0)), 9)
    return mix.select(
        "row.doc_id", "size", "source_size", "target",
        (F.col("passes") * F.col("size")).alias("taken"), first.alias("first_moment"),
    ).orderBy(F.col("first_moment").asc_nulls_last(), "doc_id")


SQL["op8_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(doc_id::VARCHAR || '/mix') AS spot
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
w AS (
  SELECT *, [3.0, 1.0, 2.0][place % 3 + 1]::DOUBLE AS weight,
         [2.0, 1.0, 1.0][place % 3 + 1]::DOUBLE AS first, [1.0, 1.0, 2.0][place % 3 + 1]::DOUBLE AS last,
         source_size::DOUBLE * 2.0 AS top
  FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
             - coalesce(sum(top) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY top / weight, source NULLS LAST)),
t AS (SELECT *, least(top, max(level) OVER () * weight) AS target FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.first, t.last,
         coalesce(sum(d.size) OVER (PARTITION BY t.place ORDER BY spot
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2.0::DOUBLE AS middle,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE whole + CASE
              WHEN whole < 2 AND middle <= target - whole * source_size THEN 1 ELSE 0 END
            END::BIGINT AS passes,
         middle / target * (first + last) AS area
  FROM p),
m AS (SELECT *, area / (first + sqrt(greatest(first * first + (last - first) * area, 0.0))) AS due FROM n)
SELECT doc_id, size, source_size, target, passes * size AS taken,
       CASE WHEN passes > 0 THEN round(least(greatest(due, 0.0), 1.0), 9) END AS first_moment
FROM m
"""


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = lines.dedup_lines(docs, min_chars=40, min_docs=5)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL["op9_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
c AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op10_ngram_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return ngrams.score(docs, ngrams.train(docs))


@query
def op11_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, folder, "documents"), shingle=4, percent=85)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


SQL["op11_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT r, doc_id, CASE
           WHEN len(ws) = 0 THEN []
           WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
           ELSE list_distinct(list_transform(range(1, len(ws) - 2),
                  lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) END AS g
  FROM d),
x AS (SELECT r, len(g) AS n, unnest(g) AS x FROM s),
p AS (
  SELECT a.r AS a, b.r AS b, a.n + b.n - count(*) AS whole, count(*) AS met
  FROM x a JOIN x b ON a.x = b.x AND a.r < b.r GROUP BY a.r, b.r, a.n, b.n),
l AS (SELECT a, b FROM p WHERE 100 * met >= 85 * whole),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
w AS (SELECT r AS a, r AS b FROM s UNION SELECT w.a, e.b FROM w JOIN e ON w.b = e.a)
SELECT any_value(s.doc_id) AS doc_id, any_value(len(s.g))::BIGINT AS n_shingles, min(t.doc_id) AS component_id
FROM w JOIN s ON s.r = w.a JOIN s t ON t.r = w.b GROUP BY w.a
"""


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Documents cut and put together in another order, and the texts rebuilt from that alone."""
    made = fim.transform(table(spark, folder, "documents"), seed=1, rate=90, spm=20)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


SQL["op12_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
u AS (
  SELECT *, list_transform([0, 1, 2, 3], lambda i: ('0x' || substr(h, 8 * i + 1, 8))::UBIGINT::BIGINT) AS r FROM d),
c AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90
              THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (SELECT *, substr(t, 1, a) AS x, substr(t, a + 1, b - a) AS y, substr(t, b + 1) AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
                        ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    ordered = prefixes.ordered_turns(table(spark, folder, "conversations"))
    return prefixes.prefix_trie(prefixes.shared_starts(ordered, period=20, kinds=4)).drop("node")


SQL["op13_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST,
                       md5(strlen(role)::VARCHAR || ':' || role || text)) AS ts,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1),
               lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
             lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z:
               CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)),
             4294967295::BIGINT) % 4 AS h
  FROM t GROUP BY conv_id),
r AS (
  SELECT o.conv_id, list_concat(coalesce(f.ts[1:o.h], []), o.ts[o.h + 1:]) AS ts
  FROM o LEFT JOIN o f ON f.conv_id = o.conv_id - o.conv_id % 20),
m AS (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM r),
g AS (
  SELECT ts[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ts) = d) AS ids,
         CASE WHEN d > 0 THEN (count(*) - 1) * any_value(len(regexp_extract_all(ts[d].t, '[^\x20\x09-\x0D]+')))
              ELSE 0 END AS saved
  FROM m GROUP BY ts[1:d], d),
c AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM g WHERE d > 0 GROUP BY 1),
k AS (
  SELECT g.*, coalesce(c.n, 0) AS children FROM g LEFT JOIN c ON g.p = c.p AND len(c.p) = g.d),
a AS (SELECT p, children, saved, unnest(range(0, d + 1)) AS up FROM k),
b AS (SELECT p[1:up] AS p, count(*) FILTER (children = 0) AS leaves, sum(saved) AS saved FROM a GROUP BY 1)
SELECT k.conv_id, k.d::BIGINT AS depth, q.conv_id AS parent_conv_id, k.n::BIGINT AS n_convs,
       k.children::BIGINT AS n_children, b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens,
       sha256(coalesce(k.ids, '')) AS ends_sha256
FROM k JOIN b ON k.p = b.p LEFT JOIN g q ON k.d > 0 AND q.d = k.d - 1 AND q.p = k.p[1:k.d - 1]
"""
