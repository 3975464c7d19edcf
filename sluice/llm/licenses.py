"""Licence scans: phrases and tags by Aho-Corasick, expressions by shunting-yard.

A text is lower-cased in A-Z and cut into words; one automaton over the words, joined by
single blanks, finds base phrases and longer notice phrases whatever stands between the
words. A second automaton over the raw text finds identifier tags. What follows a tag is
read as a licence expression: a shunting-yard parser turns it into postfix order, which
is evaluated to the licences it names and to whether a permissive choice is open.

Defined results: a null or empty text has no words, no places, empty label texts and a
score of 0; a tag without a valid expression, or with a word that cannot name a licence in
it, gives the label ``unknown-expression``; a very long text is scanned in one pass and needs
some copies of itself; repeated rows are scanned each; other columns are not read; an empty
table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .text import as_bytes, picked, slices

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Phrases of licence notices, as words, and the licence each names.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person": "mit",
    "apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "cc by 4 0": "cc-by-4.0",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by nd 4 0": "cc-by-nd-4.0",
    "cc0 1 0": "cc0-1.0",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "reserved",
}

TAGS = ("spdx-license-identifier:", "license-identifier:")

#: Licences that ask for no more than a notice.
PERMISSIVE = frozenset(
    "mit mit-0 isc 0bsd bsd bsd-2-clause bsd-3-clause apache-2.0 zlib unlicense cc0-1.0"
    " cc-by-4.0 cc-by-3.0 bsl-1.0 postgresql python-2.0 x11".split()
)

#: Names of licences without digit or hyphen, which could else be any word.
PLAIN = PERMISSIVE | frozenset(
    "gpl lgpl agpl mpl epl cddl artistic beerware bsd curl eupl fair fsful glide imlib2 intel isc libpng"
    " miros ncsa newsletr ofl openssl php psf qhull rsa-md ruby sissl sleepycat vim w3c wtfpl xnet zend none"
    " noassertion".split()
)

# How sure a finding is that a licence applies to the text.
CONFIDENCE = {"base": 0.5, "notice": 0.8, "tag": 0.95, "broken tag": 0.3}

_SEPARATORS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
_TOKEN = re.compile(r"[ \t]*(?:(\()|(\))|([A-Za-z0-9][A-Za-z0-9.+\-]*))")
_RANK = {"or": 1, "and": 2, "with": 3}


def to_postfix(text: str) -> list[str] | None:
    """Longest valid expression at the start of a text in postfix order, by shunting-yard.

    ``WITH`` binds before ``AND``, ``AND`` before ``OR``. Reading stops at a word that cannot
    follow; an operator left without its right side and open brackets make it invalid.
    """
    output: list[str] = []
    stack: list[str] = []
    expect, at = True, 0
    while match := _TOKEN.match(text, at):
        opening, closing, word = match.groups()
        low = word.lower() if word else ""
        if opening:
            if not expect:
                break
            stack.append("(")
        elif closing:
            if expect or "(" not in stack:
                break
            while (top := stack.pop()) != "(":
                output.append(top)
        elif low in _RANK:
            if expect:
                return None
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[low]:
                output.append(stack.pop())
            stack.append(low)
            expect = True
        else:
            if not expect:
                break
            output.append(low)
            expect = False
        at = match.end()
    if expect or "(" in stack:
        return None
    return output + stack[::-1]


def evaluate(postfix: list[str]) -> tuple[frozenset[str], bool] | None:
    """Licences named, and whether the terms can be met with permissive ones only."""
    stack: list[tuple[frozenset[str], bool]] = []
    for token in postfix:
        if token not in _RANK:
            name = token.rstrip(".-")
            stack.append((frozenset([name]), name.rstrip("+") in PERMISSIVE))
            continue
        if len(stack) < 2:
            return None
        (right, free), (left, open_) = stack.pop(), stack.pop()
        if token == "with":
            if len(right) != 1 or len(left) != 1:
                return None
            stack.append((left, open_))  # an exception only adds permissions
        else:
            stack.append((left | right, open_ and free if token == "and" else open_ or free))
    return stack[0] if len(stack) == 1 else None


def is_identifier(name: str) -> bool:
    """Whether a word can name a licence: it has a digit or a hyphen, or is one of the plain names."""
    return name.rstrip("+") in PLAIN or any(c.isdigit() or c == "-" for c in name)


def automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for kind, table in (("base", BASE), ("notice", NOTICES)):
        for phrase, label in table.items():
            key = f" {phrase} "
            known = phrases.get(key, ())
            phrases.add_word(key, (*known, (kind, label, len(phrase.split()), len(key))))
    for tag in TAGS:
        tags.add_word(tag, len(tag))
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def scan_text(
    text: bytes, phrases: ahocorasick.Automaton, tags: ahocorasick.Automaton
) -> tuple[int, list[tuple], list[tuple]]:
    """Words, matches (kind, label, first word, words) and expressions (byte, text, licences, free)."""
    words = text.translate(_SEPARATORS).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    matches, last, seen = [], 0, 0
    for end, found in phrases.iter(line):
        for kind, label, length, size in found:
            start = end + 1 - size
            if start >= last:
                seen, last = seen + line.count(" ", last, start), start
                place = seen
            else:
                place = seen - line.count(" ", start, last)
            matches.append((kind, label, place, length))
    expressions = []
    # Of tags that end at one place the longest is meant, and they are one tag.
    for end in sorted({end for end, _ in tags.iter(text.lower().decode("latin-1"))}):
        stop = text.find(b"\n", end)
        tail = text[end + 1 : stop if stop >= 0 else len(text)].decode("utf-8", "replace")
        postfix = to_postfix(tail)
        value = evaluate(postfix) if postfix else None
        if value and not all(map(is_identifier, value[0])):
            value = None
        names = sorted(value[0]) if value else []
        expressions.append((end + 1, tail.strip(), names, bool(value and value[1])))
    return len(words), matches, expressions


MATCH = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("words", T.IntegerType()),
    ]
)
EXPRESSION = T.StructType(
    [
        T.StructField("at", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("licences", T.ArrayType(T.StringType())),
        T.StructField("permissive", T.BooleanType()),
    ]
)
_ARROW_MATCH = pa.list_(
    pa.struct([("kind", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("words", pa.int32())])
)
_ARROW_EXPRESSION = pa.list_(
    pa.struct(
        [("at", pa.int64()), ("text", pa.string()), ("licences", pa.list_(pa.string())), ("permissive", pa.bool_())]
    )
)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, matches, expressions): one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, tags = automata()
        for batch in slices(batches, 1, 4 << 20):
            counts, matches, expressions = [], [], []
            for text in as_bytes(batch.column(1)):
                n, found, parsed = scan_text(text, phrases, tags)
                counts.append(n)
                matches.append([dict(zip(("kind", "label", "start", "words"), m)) for m in found])
                expressions.append(
                    [dict(zip(("at", "text", "licences", "permissive"), e)) for e in parsed]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(matches, _ARROW_MATCH),
                    pa.array(expressions, _ARROW_EXPRESSION),
                ],
                names=["doc_id", "n_words", "matches", "expressions"],
            )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("matches", T.ArrayType(MATCH)),
            T.StructField("expressions", T.ArrayType(EXPRESSION)),
        ]
    )
    return picked(docs, "doc_id", "text").mapInArrow(run, schema)


def summary(scanned: DataFrame) -> DataFrame:
    """Counts, places, labels and a score in 0..1 per document, from :func:`scan`.

    The score is one less the product of the doubts of the kinds of finding present.
    """
    base = F.filter("matches", lambda m: m["kind"] == "base")
    places = F.transform(base, lambda m: m["start"])
    broken = F.exists("expressions", lambda e: F.size(e["licences"]) == 0)
    named_by_tag = F.flatten(F.transform("expressions", lambda e: e["licences"]))
    labels = F.concat(
        F.transform("matches", lambda m: m["label"]),
        named_by_tag,
        F.when(broken, F.array(F.lit("unknown-expression"))).otherwise(F.array().cast("array<string>")),
    )
    text = lambda array: F.array_join(F.array_sort(F.array_distinct(array)), ",")
    present = {
        "base": F.size(base) > 0,
        "notice": F.exists("matches", lambda m: m["kind"] == "notice"),
        "tag": F.exists("expressions", lambda e: F.size(e["licences"]) > 0),
        "broken tag": broken,
    }
    doubt = F.lit(1.0)
    for kind, there in present.items():
        doubt = doubt * F.when(there, F.lit(1.0 - CONFIDENCE[kind])).otherwise(F.lit(1.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        text(F.transform(base, lambda m: m["label"])).alias("base_labels"),
        text(labels).alias("labels"),
        (F.lit(1.0) - doubt).alias("score"),
        F.size("expressions").cast("long").alias("n_expressions"),
        F.when(F.size("expressions") > 0, F.forall("expressions", lambda e: e["permissive"])).alias(
            "permissive"
        ),
    )
