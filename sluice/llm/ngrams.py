"""Scoring texts with an n-gram model kept in Elias-Fano tries.

Texts are cut into words once, in blocks: a block is a row with its distinct words, their
counts, and its texts as places in that list. Words are counted over all blocks and numbered
in a written table; a block asks for its words once, a join answers with numbers and counts.
N-grams over these numbers are dealt to shards by their first two words, each distinct one
once per block with its training count. A shard's task adds the counts up, builds a trie of
the n-grams that occur ``least`` times or more, with discounted shares, writes it, and answers
the blocks that sent the n-grams; the answers meet the blocks' texts. Other documents can be
scored as well: their blocks ask the written tries.

The probability of a word is its discounted share after the longest known context plus
that context's weight times the probability after the next shorter one, down to smoothed
counts of numbers. All words have numbers. With ``frequent_bytes`` only the most frequent words, as many as so many
bytes hold, have numbers of their own; the others share one, and such a word's probability
is that of the shared number times its smoothed share among rare words. Probabilities after a
context add up to one.

Defined results: a null or empty text is its end token alone; a null ``doc_id`` is the
empty text for the choice of training documents; repeated rows are counted and scored
each; a very long text is a block of its own, its words held at once as numbers; other
columns are not read; words that only texts kept back have count among the different words that
smoothing spreads its share over; without training documents all counts are zero; an
empty table gives an empty result. Rows are told apart by their place in the input files.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import named
from ..sources.staging import handing_up, scratch, write_out
from .eliasfano import VALUES, Trie
from .text import as_bytes, slices, small_batches
from .vocabulary import frequent

ORDER = 3
#: Times that an n-gram of the trie occurs at least.
LEAST = 2
DISCOUNT = 0.5
#: Training tokens of one shard, about, text of one block, and text that is cut into words at once.
SHARD_TOKENS, BLOCK_BYTES, SLICE_BYTES = 1 << 20, 8 << 20, 1 << 20
#: N-grams that a trie is searched for at once.
SEARCHED = 1 << 16
#: Numbers that stand for no word and for all rare words; words have those from ``FIRST`` on.
NONE, RARE, FIRST = 0, 1, 2
#: Bits of a word's number.
NUMBER_BITS = 31
END = b""

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case and one end; no word is empty, so the empty word is the end."""
    words = text.translate(_LOWER).split()
    words.append(END)
    return words


def held_out(doc_id: Column, parts: int = 7, part: int = 2) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


@dataclass(frozen=True)
class Model:
    """What scoring needs: numbered words with counts, the tries, and totals."""

    docs: DataFrame
    split: tuple[int, int]
    words: DataFrame
    weights: DataFrame | None
    tries: DataFrame | None
    #: Answers to the n-grams of the model's own documents.
    found: DataFrame | None
    blocks: DataFrame
    order: int
    shards: int
    total: int
    distinct: int
    size: int
    rare_total: int
    rare_distinct: int


def _pack(numbers: np.ndarray) -> bytes:
    """The bytes of numbers, lowest ones first, compressed."""
    flat = np.ascontiguousarray(numbers)
    return zstandard.compress(flat.view(np.uint8).reshape(-1, flat.itemsize).T.tobytes(), 3)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def numbered_words(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, n, marked, number), written; the vocabulary's words are numbered from the commonest on."""
    spark = words.sparkSession
    by = [F.desc("marked"), F.asc("word")]
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    with scratch(spark):
        sorted_ = write_out(
            vocabulary.repartitionByRange(*by)
            .sortWithinPartitions(*by)
            .select("word", F.spark_partition_id().alias("part"), place.alias("place")),
            "places",
        )
        # One row for each partition of the sort.
        sizes = sorted(map(tuple, sorted_.groupBy("part").count().collect()))
        starts = np.cumsum([FIRST, *[n for _, n in sizes]]).tolist()
        if starts[-1] >= 1 << NUMBER_BITS:
            raise ValueError("more words than numbers")
        offsets = spark.createDataFrame([(p, a) for (p, _), a in zip(sizes, starts)], "part int, first long")
        numbers = sorted_.join(F.broadcast(offsets), "part").select(
            "word", (F.col("first") + F.col("place")).alias("number")
        )
        number = F.coalesce("number", F.lit(RARE).cast("long")).alias("number")
        with handing_up():
            return write_out(words.join(numbers, "word", "left").select("word", "n", "marked", number), "numbers")


def _places() -> dict[bytes, int]:
    """Numbers words from 0 on, as they are first asked for."""
    own: defaultdict = defaultdict()
    own.default_factory = own.__len__
    return own


def text_blocks(docs: DataFrame, parts: int, part: int) -> DataFrame:
    """Blocks of texts, written.

    A row has the block's documents with what their words give alone, its distinct words with
    their occurrences in all its texts and in training texts, and its texts as places in that list.
    """
    small_batches(docs.sparkSession)
    kept = docs.select(
        F.monotonically_increasing_id().alias("row"),
        named("text").alias("text"),
        F.struct(
            named("doc_id").alias("doc_id"), held_out(named("doc_id"), parts, part).alias("held_out")
        ).alias("doc"),
    )

    def block(own: dict[bytes, int], parts_: list[tuple]) -> pa.RecordBatch:
        starts, rows, sizes, codes = zip(*parts_)
        rows, sizes, codes = pa.concat_arrays(rows), np.concatenate(sizes), np.concatenate(codes)
        held = np.array(rows.field("held_out").to_pylist(), bool)
        inside = codes[np.repeat(~held, sizes)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(starts[:1], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                pa.array([sizes], pa.list_(pa.int32())),
                pa.array([_pack(codes)], pa.binary()),
                # No word holds a line feed.
                pa.array([zstandard.compress(b"\n".join(own), 3)], pa.binary()),
                pa.array([_pack(np.bincount(codes, minlength=len(own)))], pa.binary()),
                pa.array([_pack(np.bincount(inside, minlength=len(own)))], pa.binary()),
            ],
            names=["block", "docs", "sizes", "codes", "words", "n", "marked"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts_, held = _places(), [], 0
        for batch in slices(batches, 1, SLICE_BYTES):
            raw = as_bytes(batch.column(1))
            size = sum(map(len, raw))
            if parts_ and held + size > BLOCK_BYTES:
                yield block(own, parts_)
                own, parts_, held = _places(), [], 0
            texts = [tokens(t) for t in raw]
            sizes = np.array([len(t) for t in texts], np.int32)
            codes = np.fromiter(map(own.__getitem__, chain.from_iterable(texts)), np.uint32, int(sizes.sum()))
            # Taking copies the rows, so that the batch with its texts can go.
            rows = batch.column(2).take(pa.array(np.arange(batch.num_rows)))
            parts_.append((batch.column(0)[0].as_py(), rows, sizes, codes))
            held += size
        if parts_:
            yield block(own, parts_)

    kind = T.ArrayType(kept.schema["doc"].dataType)
    schema = T.StructType().add("block", T.LongType()).add("docs", kind).add("sizes", T.ArrayType(T.IntegerType()))
    for name in ("codes", "words", "n", "marked"):
        schema = schema.add(name, T.BinaryType())
    return write_out(kept.mapInArrow(run, schema), "texts")


def block_words(blocks: DataFrame) -> DataFrame:
    """(word, n, marked) of all words of written blocks, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, n, marked in zip(*[c.to_pylist() for c in batch.columns]):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(zstandard.decompress(words).split(b"\n"), pa.binary()),
                        pa.array(_unpack(n, "i8")),
                        pa.array(_unpack(marked, "i8")),
                    ],
                    names=["word", "n", "marked"],
                )

    counts = blocks.select("words", "n", "marked").mapInArrow(run, "word binary, n long, marked long")
    return write_out(
        counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("marked").alias("marked")), "words"
    )


def numbered_blocks(texts: DataFrame, words: DataFrame) -> DataFrame:
    """Blocks with the numbers and training counts of their distinct words, written."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, own in zip(*[c.to_pylist() for c in batch.columns]):
                own = zstandard.decompress(own).split(b"\n")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), block, np.int64)),
                        pa.array(np.arange(len(own), dtype=np.int32)),
                        pa.array(own, pa.binary()),
                    ],
                    names=["block", "at", "word"],
                )

    answers = (
        texts.select("block", "words")
        .mapInArrow(ask, "block long, at int, word binary")
        .join(words.select("word", "marked", "number"), "word", "left")
        .select(
            "block", "at", F.coalesce("marked", F.lit(0)).alias("marked"),
            F.coalesce("number", F.lit(RARE)).alias("number"),
        )
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("at")
        numbers = right.column("number").to_numpy().astype(np.uint32)
        seen = right.column("marked").to_numpy().astype(np.int64)
        return pa.table(
            {
                **{c: left.column(c) for c in ("block", "docs", "sizes", "codes")},
                "numbers": pa.array([_pack(numbers)], pa.binary()),
                "seen": pa.array([_pack(seen)], pa.binary()),
            }
        )

    sent = texts.select("block", "docs", "sizes", "codes")
    schema = T.StructType([*sent.schema.fields]).add("numbers", T.BinaryType()).add("seen", T.BinaryType())
    return write_out(sent.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(meet, schema), "blocks")


def _shard(first: np.ndarray, second: np.ndarray, shards: int) -> np.ndarray:
    """The shard of the n-grams that begin with two words."""
    key = _key(first, 7919, second)
    key %= shards
    return key


def _grams(flat: np.ndarray, sizes: np.ndarray, order: int) -> tuple[np.ndarray, ...]:
    """First places of n-grams of two words, and their first, second and third word, -1 for none."""
    inside = np.ones(len(flat), bool)
    ends = np.cumsum(sizes)
    inside[ends - 1] = False
    at = np.flatnonzero(inside).astype(np.int32)
    third = np.append(flat, flat.dtype.type(-1))[at + 2]
    third[(order < 3) | ~inside[at + 1]] = -1
    return at, flat[at], flat[at + 1], third


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.unique`` with the inverse, as half-width places, of fewer than 2^31 keys in less memory."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    keys = keys[new]
    place = np.empty(len(order), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return keys, place


def _key(high: np.ndarray, size: int, low: np.ndarray, more: int = 0) -> np.ndarray:
    """``high * size + low + more`` without a second array of that width."""
    key = high.astype(np.int64)
    key *= size
    key += low
    key += more
    return key


def _unique(numbers: np.ndarray, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct n-grams in order (a column each), and the place of each.

    The words come as places among sorted numbers, the third one as -1 where there is none.
    """
    size = len(numbers)
    numbers = np.append(numbers, numbers.dtype.type(NONE))  # the last one is that of place -1
    if (size + 1) ** 3 < 1 << 63:
        # Not kept under a name, so that it goes as soon as it is sorted.
        keys, place = _distinct(_key(_key(first, size, second), size + 1, third, 1))
        pair, last = keys // (size + 1), keys % (size + 1) - 1
        return np.stack([numbers[pair // size], numbers[pair % size], numbers[last]]), place
    pairs, which = _distinct(_key(first, size, second))
    keys, place = _distinct(_key(which, size + 1, third, 1))
    pair, last = pairs[keys // (size + 1)], keys % (size + 1) - 1
    return np.stack([numbers[pair // size], numbers[pair % size], numbers[last]]), place


def _new_pairs(words: np.ndarray) -> np.ndarray:
    """Where n-grams in order (a column each) begin with another pair than the one before."""
    new = np.ones(words.shape[1], bool)
    new[1:] = (words[:2, 1:] != words[:2, :-1]).any(axis=0)
    return new


def _pack_grams(words: np.ndarray) -> bytes:
    """Distinct n-grams in order as gaps: first words, second ones after the same first, and so on."""
    gaps = np.diff(words.astype(np.int64), axis=1, prepend=0)
    first = gaps[0] != 0
    pair = first | (gaps[1] != 0)
    gaps[1, first], gaps[2, pair] = words[1, first], words[2, pair]
    return _pack(gaps.astype(np.uint32).ravel())


def _unpack_grams(data: bytes) -> np.ndarray:
    gaps = _unpack(data, "u4").reshape(3, -1).astype(np.int64)

    def added(gap: np.ndarray, begins: np.ndarray) -> np.ndarray:
        heads, total = np.flatnonzero(begins), np.cumsum(gap)
        return total - np.repeat((total - gap)[heads], np.diff(heads, append=len(gap)))

    # Words are numbered from 1, so the first n-gram begins a stretch in each row.
    first = gaps[0] != 0
    pair = first | (gaps[1] != 0)
    return np.stack([np.cumsum(gaps[0]), added(gaps[1], first), added(gaps[2], pair)])


def _dealt(blocks: DataFrame, order: int, rare_total: int, shards: int) -> DataFrame:
    """(shard, block, grams, times, totals): the distinct n-grams of each block, a row per shard.

    An n-gram is two words and the third, 0 at the end of a text; its times are those in
    training documents. Totals are the training counts of the row's distinct first words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, held, sizes, codes, numbers, seen in zip(*[c.to_pylist() for c in batch.columns]):
                sizes, train = np.array(sizes, np.int64), ~np.array(held, bool)
                own, counts = _unpack(numbers, "u4"), _unpack(seen, "i8")
                at, words, shard, place = _ngrams_of(numbers, codes, sizes, order, shards)
                inside = place[np.repeat(train, sizes)[at]]
                times = np.bincount(inside, minlength=words.shape[1]).astype(np.uint32)
                by = np.argsort(own)
                parts = _spans(shard)
                totals = []
                for a, b in parts:
                    first = np.unique(words[0, a:b])
                    total = counts[by[np.searchsorted(own, first, sorter=by)]]
                    totals.append(_pack(np.where(first == RARE, rare_total, total)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(shard[a]) for a, _ in parts], pa.int64()),
                        pa.array([block] * len(parts), pa.int64()),
                        pa.array([_pack_grams(words[:, a:b]) for a, b in parts], pa.binary()),
                        pa.array([_pack(times[a:b]) for a, b in parts], pa.binary()),
                        pa.array(totals, pa.binary()),
                    ],
                    names=["shard", "block", "grams", "times", "totals"],
                )

    held = F.transform("docs", lambda d: d["held_out"]).alias("held")
    return blocks.select("block", held, "sizes", "codes", "numbers", "seen").mapInArrow(
        run, "shard long, block long, grams binary, times binary, totals binary"
    )


def _spans(shard: np.ndarray) -> list[tuple[int, int]]:
    """Begins and ends of equal numbers that stand together."""
    bounds = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
    return [(a, b) for a, b in zip(bounds, bounds[1:]) if a < b]


def _build(
    pairs: np.ndarray, n_pairs: np.ndarray, totals: np.ndarray,
    owner: np.ndarray, third: np.ndarray, n: np.ndarray, discount: float,
) -> tuple[np.ndarray, Trie]:
    """The sorted numbers of a shard's words, and its trie over places among them.

    Pairs come in order with their counts and those of their first words, triples as the place
    of their pair, the third word and their count.
    """
    first, second = pairs >> 32, pairs & 0xFFFFFFFF
    local = np.unique(np.concatenate([first, second, third]))
    context = np.searchsorted(local, first)
    of_word = np.ones(len(local), np.int64)
    of_word[context] = totals
    levels = [
        Trie.level(context, np.searchsorted(local, second), n_pairs, of_word, discount),
        Trie.level(owner, np.searchsorted(local, third), n, n_pairs, discount),
    ]
    return local, Trie(len(local), np.zeros(1), levels)


def _answers(
    local: np.ndarray, trie: Trie | None, pairs: np.ndarray, owner: np.ndarray, third: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Share of the second word and weight of each pair, and share of the third word; each one more, 0 is none."""
    two, three = np.zeros((2, len(pairs)), np.uint32), np.zeros(len(third), np.uint32)
    if trie is None:
        return two, three

    def place(numbers: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(local, numbers), len(local) - 1)
        return np.where(local[at] == numbers, at, -1)

    # A search takes many arrays of its queries' length, so it gets some of them at a time.
    pair = np.empty(len(pairs), np.int64)
    for part in _cuts(len(pairs)):
        first, second = place(pairs[part] >> 32), place(pairs[part] & 0xFFFFFFFF)
        pair[part] = trie.find(2, np.where(second < 0, -1, first), second)
    hit = pair >= 0
    two[0, hit] = trie.levels[0]["share"][pair[hit]].astype(np.uint32) + 1
    two[1, hit] = trie.levels[1]["weight"][pair[hit]].astype(np.uint32) + 1
    for part in _cuts(len(third)):
        last = place(third[part])
        triple = trie.find(3, np.where(last < 0, -1, pair[owner[part]]), last)
        hit = triple >= 0
        three[part][hit] = trie.levels[1]["share"][triple[hit]].astype(np.uint32) + 1
    return two, three


def _cuts(count: int) -> Iterator[slice]:
    """All of so many places, in stretches that are searched at once."""
    return (slice(at, at + SEARCHED) for at in range(0, count, SEARCHED))


def _shard_model(
    table: pa.Table, least: int, discount: float
) -> tuple[np.ndarray | None, Trie | None, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """A shard's words and trie, none if no n-gram is kept, first words of its pairs, and answers to its rows."""
    starts, firsts, heads, parts, thirds = [0], [], [], [], []
    for data in table.column("grams"):
        # Only what is needed of the words is kept, not all of them as long numbers.
        words = _unpack_grams(data.as_py())
        firsts.append(np.unique(words[0]))
        heads.append(starts[-1] + np.flatnonzero(_new_pairs(words)))
        parts.append(words[0] << 32 | words[1])
        thirds.append(words[2].astype(np.uint32))
        starts.append(starts[-1] + words.shape[1])
    totals = [_unpack(x.as_py(), "i8") for x in table.column("totals")]
    firsts, at = np.unique(np.concatenate(firsts), return_index=True)
    total = np.concatenate(totals)[at]
    joined = np.concatenate(parts)
    del parts
    pairs, which = _distinct(joined)
    joined = which.astype(np.int64)
    joined <<= 32
    joined |= np.concatenate(thirds)
    del thirds
    keys, place = _distinct(joined)
    del joined
    owner, third = keys >> 32, keys & 0xFFFFFFFF
    times = np.concatenate([_unpack(x.as_py(), "u4") for x in table.column("times")])
    n = np.bincount(place, times, len(keys)).astype(np.int64)
    del times, keys
    n_pairs = np.bincount(owner, n, len(pairs)).astype(np.int64)
    two = n_pairs >= least
    local = trie = None
    if two.any():
        three = (n >= least) & (third != NONE)
        number = np.cumsum(two) - 1
        of_first = total[np.searchsorted(firsts, pairs[two] >> 32)]
        local, trie = _build(pairs[two], n_pairs[two], of_first, number[owner[three]], third[three], n[three], discount)
    of_pair, of_gram = _answers(local, trie, pairs, owner, third)
    found = []
    for head, begin, end in zip(heads, starts, starts[1:]):
        found.append((of_pair[:, which[head]], of_gram[place[begin:end]]))
    return local, trie, pairs[two] >> 32, found


def train(
    docs: DataFrame,
    order: int = ORDER,
    frequent_bytes: int | None = None,
    discount: float = DISCOUNT,
    parts: int = 7,
    part: int = 2,
    shard_tokens: int = SHARD_TOKENS,
    least: int = LEAST,
) -> Model:
    """Count words and n-grams of ``docs`` and build the tries from the training documents.

    Without ``frequent_bytes`` all words have numbers. N-grams that occur ``least`` times or
    more are kept; 1 keeps all of them.
    """
    if order not in (1, 2, 3):
        raise ValueError("the trie has one to three orders")
    if least < 1:
        raise ValueError("an n-gram occurs once at least")
    spark = docs.sparkSession
    with scratch(spark):
        texts = text_blocks(docs, parts, part)
        counts = block_words(texts)
        with handing_up():
            few = counts if frequent_bytes is None else frequent(counts, frequent_bytes)
            words = numbered_words(counts, few)
            blocks = numbered_blocks(texts, words)
    marked, rare = F.col("marked"), F.col("number") == RARE
    total, distinct, size, rare_total, rare_distinct = words.agg(
        F.coalesce(F.sum(marked), F.lit(0)),
        F.count_if(marked > 0),
        F.count_if(~rare) + 1,
        F.coalesce(F.sum(F.when(rare, marked)), F.lit(0)),
        F.count_if(rare & (marked > 0)),
    ).first()
    shards = max(1, -(-total // shard_tokens))
    weights = tries = found = None
    if order > 1:

        def build(table: pa.Table) -> pa.Table:
            local, trie, first, answers = _shard_model(table, least, discount)
            size = len(answers)
            row = {
                "shard": table.column("shard"),
                "block": table.column("block"),
                "two": pa.array([_pack(a.ravel()) for a, _ in answers], pa.binary()),
                "three": pa.array([_pack(b) for _, b in answers], pa.binary()),
            }
            # The shard's trie stands in its first row.
            held: tuple = (None,) * 4
            if trie is not None:
                number, at = np.unique(first, return_inverse=True)
                used = np.bincount(at, VALUES[trie.levels[0]["share"]], len(number))
                held = (local.astype(np.uint32).tobytes(), trie.to_bytes(), _pack(number.astype(np.uint32)), _pack(used))
            for name, value in zip(("words", "trie", "firsts", "used"), held):
                row[name] = pa.array([value] + [None] * (size - 1), pa.binary())
            return pa.table(row)

        built = _dealt(blocks, order, rare_total, shards).groupBy("shard").applyInArrow(
            build,
            "shard long, block long, two binary, three binary,"
            " words binary, trie binary, firsts binary, used binary",
        )
        written = write_out(built, "tries")
        tries = written.filter("trie IS NOT NULL").select("shard", "words", "trie")
        found = written.select("block", "shard", "two", "three")

        def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, used in zip(*[c.to_pylist() for c in batch.columns]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_unpack(first, "u4").astype(np.int64)), pa.array(_unpack(used, "f8"))],
                        names=["number", "used"],
                    )

        used = written.filter("firsts IS NOT NULL").select("firsts", "used")
        used = used.mapInArrow(shares, "number long, used double")
        used = used.groupBy("number").agg(F.sum("used").alias("used"))
        left = F.least(F.greatest(1.0 - F.col("used"), F.lit(0.0)), F.lit(1.0))
        weights = write_out(used.select("number", F.rint(left * 65535).cast("int").alias("weight")), "weights")
    return Model(
        docs, (parts, part), words, weights, tries, found, blocks, order, shards,
        total, distinct, size, rare_total, rare_distinct,
    )


def _ngrams_of(numbers: bytes, codes: bytes, sizes: np.ndarray, order: int, shards: int) -> tuple:
    """First places of a block's n-grams, the distinct ones in order of their shards, and which each is."""
    own, which = _distinct(_unpack(numbers, "u4"))
    at, first, second, third = _grams(which[_unpack(codes, "u4")], sizes, order)
    words, place = _unique(own, first, second, third)
    shard = _shard(words[0], words[1], shards)
    order_ = np.argsort(shard, kind="stable")
    rank = np.empty(len(order_), np.int32)
    rank[order_] = np.arange(len(order_), dtype=np.int32)
    return at, words[:, order_], shard[order_], rank[place]


def _weigh(
    value: np.ndarray, weight: np.ndarray, code: np.ndarray, found: tuple,
    of_pair: np.ndarray, of_gram: np.ndarray, order: int,
) -> None:
    """Turn the probabilities of a block's single words into those after the words before them.

    ``found`` is that of :func:`_ngrams_of`, answers are those of :func:`_answers`. Places are
    gone through in stretches, first for pairs, since longer n-grams build on them.
    """
    at, grams, _, place = found
    pair = np.cumsum(_new_pairs(grams), dtype=np.int32) - 1
    if len(of_gram) != grams.shape[1] or of_pair.shape[1] != (pair[-1] + 1 if len(pair) else 0):
        raise RuntimeError("n-grams of a block have no answer")
    for part in _cuts(len(at)):
        here, two = at[part], of_pair[0, pair[place[part]]]
        value[here + 1] *= weight[code[here]]
        hit = two > 0
        value[here[hit] + 1] += VALUES[two[hit] - 1]
    for part in _cuts(len(at) if order > 2 else 0):
        here, gram = at[part], place[part]
        which, three = pair[gram], of_gram[gram]
        inner = (of_pair[0, which] > 0) & (grams[2, gram] != NONE)
        value[here[inner] + 2] *= (of_pair[1, which[inner]] - 1.0) / 65535.0
        last = three > 0
        value[here[last] + 2] += VALUES[three[last] - 1]


def _looked_up(number: np.ndarray, value: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The value of each asked number, 1 where there is none."""
    if not len(number):
        return np.ones(len(asked))
    by = np.argsort(number)
    at = by[np.minimum(np.searchsorted(number, asked, sorter=by), len(number) - 1)]
    return np.where(number[at] == asked, value[at], 1.0)


def score(docs: DataFrame, model: Model, parts: int = 7, part: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row."""
    blocks, found = model.blocks, model.found
    if docs is not model.docs or (parts, part) != model.split:
        with scratch(docs.sparkSession):
            texts = text_blocks(docs, parts, part)
            with handing_up():
                blocks = numbered_blocks(texts, model.words)
        found = None
    order, shards, total, size = model.order, model.shards, model.total, model.size
    rare_total = model.rare_total
    per_token = float(np.log10(total + model.distinct + 1))
    per_rare = float(np.log10(rare_total + model.rare_distinct + 1))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, codes, numbers in zip(*[c.to_pylist() for c in batch.columns]):
                grams, shard = _ngrams_of(numbers, codes, np.array(sizes, np.int64), order, shards)[1:3]
                spans = _spans(shard)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * len(spans), pa.int64()),
                        pa.array([int(shard[a]) for a, _ in spans], pa.int64()),
                        pa.array([_pack_grams(grams[:, a:b]) for a, b in spans], pa.binary()),
                    ],
                    names=["block", "shard", "grams"],
                )

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        local = trie = None
        if right.num_rows:
            local = np.frombuffer(right.column("words")[0].as_py(), np.uint32)
            trie = Trie.from_buffer(right.column("trie")[0].as_py())
        two, three = [], []
        for data in left.column("grams").to_pylist():
            words = _unpack_grams(data)
            new = _new_pairs(words)
            pairs = (words[0] << 32 | words[1])[new]
            a, b = _answers(local, trie, pairs, np.cumsum(new) - 1, words[2])
            two.append(_pack(a.ravel()))
            three.append(_pack(b))
        return pa.table(
            {
                "block": left.column("block"), "shard": left.column("shard"),
                "two": pa.array(two, pa.binary()), "three": pa.array(three, pa.binary()),
            }
        )

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, numbers in zip(*[c.to_pylist() for c in batch.columns]):
                own = np.unique(_unpack(numbers, "u4")).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), block, np.int64)), pa.array(own)], names=["block", "number"]
                )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0].as_py() for c in ("sizes", "codes", "numbers", "seen")}
        sizes = np.array(row["sizes"], np.int64)
        code, own = _unpack(row["codes"], "u4"), _unpack(row["numbers"], "u4")
        seen = _unpack(row["seen"], "i8")
        rare = own == RARE
        value = ((np.where(rare, rare_total, seen) + 1.0) / (total + size))[code]
        starts = np.cumsum(sizes) - sizes
        if order > 1:
            answers = right.filter(pc.is_valid(right.column("two"))).sort_by("shard")
            parts_ = [_unpack(x, "u4").reshape(2, -1) for x in answers.column("two").to_pylist()]
            of_pair = np.concatenate([np.zeros((2, 0), np.uint32), *parts_], axis=1)
            parts_ = [_unpack(x, "u4") for x in answers.column("three").to_pylist()]
            of_gram = np.concatenate([np.zeros(0, np.uint32), *parts_])
            known = right.filter(pc.is_valid(right.column("weights"))).column("weights").combine_chunks().flatten()
            number, held = known.field("number").to_numpy(), known.field("weight").to_numpy()
            by = np.argsort(own)
            weight = np.ones(len(own))
            weight[by] = _looked_up(number, held / 65535.0, own[by])
            grams = _ngrams_of(row["numbers"], row["codes"], sizes, order, shards)
            _weigh(value, weight, code, grams, of_pair, of_gram, order)
            del grams, of_pair, of_gram
        logs = np.log10(seen + 1.0)[code]
        rare_ = rare[code]
        sums = lambda x: np.add.reduceat(x, starts)
        rows = left.column("docs").combine_chunks().flatten()
        return pa.table(
            {
                "doc_id": rows.field("doc_id"),
                "held_out": rows.field("held_out"),
                "n_tokens": pa.array(sizes),
                "n_known": pa.array(sums((seen > 0)[code].astype(np.int64))),
                "train_tokens": pa.array(np.full(len(sizes), total, np.int64)),
                "base_score": pa.array(sums(logs) - sizes * per_token),
                "score": pa.array(sums(np.log10(value) + np.where(rare_, logs - per_rare, 0.0))),
            }
        )

    none = F.lit(None)
    if order > 1:
        if found is None:
            asked = blocks.select("block", "sizes", "codes", "numbers").mapInArrow(
                ask, "block long, shard long, grams binary"
            )
            found = asked.groupBy("shard").cogroup(model.tries.groupBy("shard")).applyInArrow(
                look, "block long, shard long, two binary, three binary"
            )
        weights = (
            blocks.select("block", "numbers")
            .mapInArrow(words_of, "block long, number long")
            .join(model.weights, "number")
            .groupBy("block")
            .agg(F.collect_list(F.struct("number", "weight")).alias("weights"))
        )
        answers = found.select(
            "block", "shard", "two", "three", none.cast("array<struct<number:long,weight:int>>").alias("weights")
        ).unionAll(weights.select("block", none.cast("long"), none.cast("binary"), none.cast("binary"), "weights"))
    else:
        answers = blocks.select(
            "block", none.cast("long").alias("shard")
        ).limit(0)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            meet,
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
            " base_score double, score double",
        )
    )
