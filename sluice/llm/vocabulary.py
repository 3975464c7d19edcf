"""The part of a table of counted words that may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Bytes that the frequent words take at most in a task's memory, each with what Python adds.
FREQUENT_BYTES = 48 << 20
OVERHEAD = 120


def frequent(counts: DataFrame, max_bytes: int = FREQUENT_BYTES) -> DataFrame:
    """The most frequent words, as many as ``max_bytes`` hold with their overhead.

    Bytes are added up by steps of a count's logarithm, and the threshold is the lowest
    step at which all words from there on fit; so the size is measured, not assumed.
    """
    step = F.floor(F.log2("n") * 16)
    size = F.sum(F.octet_length("word") + OVERHEAD).alias("size")
    sizes = counts.groupBy(step.alias("step")).agg(size).collect()
    least, held = None, 0
    for row in sorted(sizes, reverse=True):
        held += row["size"]
        if held > max_bytes:
            break
        least = row["step"]
    return counts.filter(F.lit(False) if least is None else step >= least)
