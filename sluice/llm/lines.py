"""Dropping lines that many documents share.

Lines are exploded as 128-bit hashes of their normalised form, one row per document and
hash. Hashes are counted with a partial aggregate, so a line that stands in every
document is one row per task when it is shuffled. Only hashes that reach the threshold
go back to their documents, those of very common lines over several partitions, and each
document drops its lines in one pass over its text.

Defined results: a null or empty text is one empty line; a text that loses all its lines
becomes empty; rows that share a ``doc_id`` are one document, and so are rows whose
``doc_id`` is null, which counts as smaller than any other; a very long text is worked on
alone, and its lines are hashed one by one; other columns are kept as they are, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import named
from ..sources.staging import write_out
from .skew import spread_join
from .text import SPACE, as_bytes, fresh, picked, slices

_STRIP = SPACE.encode()


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a line's normalised form; none for lines too short to count."""
    key = line.strip(_STRIP)
    if len(key) < min_chars or (
        len(key) < 4 * min_chars and len(key.decode("utf-8", "surrogatepass")) < min_chars
    ):
        return None
    return xxhash.xxh3_128_digest(key.lower())


def line_hashes(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """(doc, key) once for each row of ``docs`` and each of its long lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 4 << 20):
            keys = []
            for text in as_bytes(batch.column(1)):
                found = {line_key(line, min_chars) for line in text.split(b"\n")}
                found.discard(None)
                keys.append(list(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.list_(pa.binary()))], names=["doc", "keys"]
            )

    schema = T.StructType(
        [
            T.StructField("doc", docs.schema["doc_id"].dataType),
            T.StructField("keys", T.ArrayType(T.BinaryType())),
        ]
    )
    return (
        picked(docs, "doc_id", "text")
        .mapInArrow(run, schema)
        .select("doc", F.explode("keys").alias("key"))
    )


def dropped_keys(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc, keys): for each document that loses lines, the hashes of these lines."""
    lines = line_hashes(docs, min_chars)
    common = write_out(
        lines.distinct()
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last"))
        .filter(F.col("docs") >= min_docs),
        "common",
    )
    return (
        spread_join(lines, common, "key", "docs")
        .filter(~F.col("doc").eqNullSafe(F.col("last")))
        .groupBy("doc")
        .agg(F.collect_set("key").alias("keys"))
    )


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with shared lines dropped from ``text``, plus ``n_lines`` and ``n_dropped``.

    These two are the last columns; where the table has such names, in any case of their
    letters, an underscore comes before them.
    """
    extra = [fresh(docs, "n_lines"), fresh(docs, "n_dropped")]
    gone = dropped_keys(docs, min_chars, min_docs)
    names = docs.columns
    doc, keys = fresh(docs, "doc"), fresh(docs, "keys")
    gone = gone.select(F.col("doc").alias(doc), F.col("keys").alias(keys))
    wide = docs.join(gone, named("doc_id").eqNullSafe(named(doc)), "left").drop(doc)
    at = names.index("text")
    wide = wide.toDF(*[f"c{i}" for i in range(len(wide.columns))])  # names with dots are no columns there

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at, 4 << 20):
            kept, total, lost = [], [], []
            for text, keys in zip(as_bytes(batch.column(at)), batch.column(len(names)).to_pylist()):
                lines = text.split(b"\n")
                total.append(len(lines))
                if keys:
                    drop = set(keys)
                    lines = [x for x in lines if line_key(x, min_chars) not in drop]
                lost.append(total[-1] - len(lines))
                kept.append(b"\n".join(lines))
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(lost, pa.int64())],
                names=[*names, *extra],
            )

    fields = [T.StructField(f.name, f.dataType) for f in docs.schema.fields]
    fields += [T.StructField(name, T.LongType()) for name in extra]
    return wide.mapInArrow(run, T.StructType(fields))
