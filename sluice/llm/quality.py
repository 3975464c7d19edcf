"""Quality rules as a ledger of failure bits.

Every rule is evaluated once. The ledger keeps what was measured and one bit per rule
that failed; a policy is a mask of rules with a version name, so applying another
version, or asking what a rule contributes, reads the ledger and not the texts.

Defined results: a null text has no words and no line with a word; a document without words
fails the rule for few words; ratios are compared by multiplication, so nothing is
divided by zero; a very long text is measured whole, its windows of words held at once, which
takes some fifty times its size; repeated rows are measured each; an empty table gives an
empty ledger.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import named
from .text import as_bytes, fresh, picked, slices

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
)
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A name and the condition, over the measures, under which a document fails."""

    name: str
    fails: str


#: The bit of a rule is its place in this tuple; new rules are added at the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("wide_words", "word_chars > 100 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """Which rules reject a document, under a version name."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {rule.name: 1 << i for i, rule in enumerate(rules)}
        return sum(bits[name] for name in set(self.rules))


BASE = Policy("base-1", ("few_words", "repeated_words"))
DEFAULT = Policy("default-1", (*BASE.rules, "symbols", "repeated_lines"))
STRICT = Policy("strict-1", tuple(rule.name for rule in RULES))


def measure(text: bytes) -> tuple[int, int, int, int, int, int]:
    """Words, bytes in words, symbols, lines with a word, repeated lines, words in repeated windows."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, end = Counter(windows), 0
        for at, window in enumerate(windows):
            if counts[window] > 1:
                repeated += at + 3 - max(at, end)
                end = at + 3
    return (
        len(words),
        sum(map(len, words)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
    )


def _measured(batch: pa.RecordBatch, at: int) -> list[pa.Array]:
    column = batch.column(at)
    texts = as_bytes(column)
    rows = [measure(t) for t in texts]
    values = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES))]
    # Code points in words: all code points but the white space, which is one byte each.
    chars = pc.fill_null(pc.utf8_length(column), 0).cast(pa.int64())
    outside = pc.subtract(pa.array([len(t) for t in texts], pa.int64()), values[1])
    values[1] = pc.subtract(chars, outside)
    return values


def failure_bits(rules: Sequence[Rule] = RULES, of: dict[str, str] | None = None) -> Column:
    """One long with the bit of each failed rule set; ``of`` renames measures to columns."""
    bits = F.lit(0).cast("long")
    for at, rule in enumerate(rules):
        text = rule.fails
        for measure_name, column in (of or {}).items():
            text = text.replace(measure_name, f"`{column}`")
        bits = bits + F.when(F.expr(text), F.lit(1 << at)).otherwise(F.lit(0)).cast("long")
    return bits


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, measures, bits): one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 4 << 20):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *_measured(batch, 1)], names=["doc_id", *MEASURES]
            )

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
    fields += [T.StructField(m, T.LongType()) for m in MEASURES]
    measured = picked(docs, "doc_id", "text").mapInArrow(run, T.StructType(fields))
    return measured.withColumn("bits", failure_bits(rules))


def apply_policy(
    books: DataFrame, policy: Policy = DEFAULT, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The ledger with ``rejected_by``, the failed rules of this policy, and ``kept``."""
    hit = F.col("bits").bitwiseAND(F.lit(policy.mask(rules)).cast("long"))
    names = F.array(
        *[
            F.when(hit.bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(rule.name))
            for i, rule in enumerate(rules)
        ]
    )
    return books.withColumn("rejected_by", F.array_compact(names)).withColumn("kept", hit == 0)


def ablation(
    books: DataFrame, policy: Policy = DEFAULT, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """What each rule of a policy does, from one aggregate over the ledger.

    ``fails``: documents that fail the rule; ``alone``: those that only this rule of the
    policy rejects, which are the documents kept if it were left out; ``kept``: documents
    that the whole policy keeps.
    """
    mask = policy.mask(rules)
    hit = F.col("bits").bitwiseAND(F.lit(mask).cast("long"))
    used = [(i, rule) for i, rule in enumerate(rules) if mask >> i & 1]
    sums = [F.sum((hit == 0).cast("long")).alias("kept")]
    for i, rule in used:
        bit = F.lit(1 << i).cast("long")
        sums.append(F.sum((hit.bitwiseAND(bit) != 0).cast("long")).alias(f"fails_{i}"))
        sums.append(F.sum((hit == bit).cast("long")).alias(f"alone_{i}"))
    total = books.agg(*sums).fillna(0)
    rows = [
        F.struct(
            F.lit(policy.version).alias("policy"),
            F.lit(rule.name).alias("rule"),
            F.col(f"fails_{i}").alias("fails"),
            F.col(f"alone_{i}").alias("alone"),
            F.col("kept"),
        )
        for i, rule in used
    ]
    return total.select(F.inline(F.array(*rows)))


def keep_good(
    docs: DataFrame, policy: Policy = DEFAULT, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with their columns; nothing is shuffled."""
    names = docs.columns
    extra = {m: fresh(docs, f"q_{m}") for m in MEASURES}
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at, 4 << 20):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *_measured(batch, at)], names=[*names, *extra.values()]
            )

    fields = [T.StructField(f.name, f.dataType) for f in docs.schema.fields]
    fields += [T.StructField(c, T.LongType()) for c in extra.values()]
    books = docs.mapInArrow(run, T.StructType(fields))
    hit = failure_bits(rules, extra).bitwiseAND(F.lit(policy.mask(rules)).cast("long"))
    return books.filter(hit == 0).select(*[named(c) for c in names])
