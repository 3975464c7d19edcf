"""SentencePiece encoding by a relational lattice, and decoding.

A text, with a blank before it, is cut where no piece has the two characters side by side;
no path through the lattice crosses such a place in one piece, so segments can be encoded
one by one, and each distinct one only once. Texts are handled in blocks; a block's distinct
segments are written once, as one packed row, and dealt to shards by a hash, where they are
counted. Each distinct segment explodes
into its substrings up to the longest piece, which are joined with the piece table; the
edges found are grouped by segment and a higher-order aggregate folds them, in order of
their ends, to the best path. That gives a lexicon of segments and their piece numbers.
A substring is bounded by the longest piece that begins with its first characters, so
that few are made which no piece can equal.

Texts are then put together. The most frequent segments, as many as a number of bytes
holds, are broadcast. A block asks each shard of the lexicon for its other segments there
in one row, the shard answers in one row, and the answers meet the block's texts, which
travel as segment numbers.

Scores are those of the model file, and of equal paths the one with the longest last
piece wins. All pieces take part, runs of blanks too. A character without a piece becomes
the pieces of its bytes. A literal U+2581 does too, so decoding always gives the text back.

Defined results: null and empty texts have no pieces and decode to the empty text;
segments longer than ``MAX_CHARS`` are folded whole first and cut between pieces of their
best path; repeated rows are encoded each; rows
are told apart by their place in the input files; a column kept beside the result may
have any name but those of the result; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import named
from ..sources.staging import handing_up, scratch, write_out
from .text import as_bytes, small_batches
from .vocabulary import frequent

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_CHARS = 128
#: Text of one block, about; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Text that is cut into segments at once.
SLICE_BYTES = 1 << 20
#: Segments of one shard, about; each block's distinct ones count.
SHARD_SEGMENTS = 1 << 19
#: Bytes of the segments that are broadcast; the join with the lexicon answers all others.
FREQUENT_BYTES = 16 << 20
#: Characters of different segments whose lattices a task builds, about, and the most such tasks.
LATTICE_CHARS, LATTICE_TASKS = 1 << 18, 1 << 16
#: Characters of a beginning that says how long the pieces with it are.
BEGINNING = 3


@dataclass(frozen=True)
class Pieces:
    """What encoding and decoding need of a model file; a blank stands for U+2581."""

    texts: tuple[bytes, ...]
    usable: tuple[tuple[str, int, float], ...]
    bytes_at: tuple[int, ...]
    unknown: float
    longest: int

    @classmethod
    def load(cls, path: str = MODEL) -> Pieces:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts, usable, bytes_at = [], [], [0] * 256
        for at in range(model.get_piece_size()):
            piece = model.id_to_piece(at)
            if model.is_byte(at):
                bytes_at[int(piece[1:-1], 16)] = at
                texts.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(at) or model.is_unknown(at):
                texts.append(b"")
            else:
                piece = piece.replace("▁", " ")
                texts.append(piece.encode())
                usable.append((piece, at, float(model.get_score(at))))
        if any(" " in piece.lstrip(" ") for piece, _, _ in usable):
            raise ValueError("pieces with a blank after another character are not supported")
        return cls(
            tuple(texts),
            tuple(usable),
            tuple(bytes_at),
            min(score for _, _, score in usable) - 10.0,
            max(len(piece) for piece, _, _ in usable),
        )

    @cached_property
    def reach(self) -> dict[str, int]:
        """Length of the longest piece by its first ``BEGINNING`` characters, if it has as many."""
        found: dict[str, int] = {}
        for piece, _, _ in self.usable:
            if len(piece) >= BEGINNING:
                found[piece[:BEGINNING]] = max(found.get(piece[:BEGINNING], 0), len(piece))
        return found

    @cached_property
    def scores(self) -> dict[str, float]:
        return {piece: score for piece, _, score in self.usable}

    def best_cuts(self, segment: str, most: int) -> list[int]:
        """Places within a segment where its best path goes from one piece to the next.

        They are as far from each other as ``most`` allows. What is optimal as a whole is so
        in its parts, so the parts' best paths, one after the other, are the segment's. Scores
        of the places that a piece can still reach back to are held, and a start per place.
        """
        scores = self.scores
        held, back = [0.0], array("i", [0])
        for end in range(1, len(segment) + 1):
            best, size = None, 0
            for n in range(min(self.longest, end), 0, -1):
                score = scores.get(segment[end - n : end], self.unknown if n == 1 else None)
                if score is not None and (best is None or held[-n] + score > best):
                    best, size = held[-n] + score, n
            held.append(best)
            back.append(size)
            if len(held) > 2 * self.longest:
                del held[: -self.longest]
        cuts, last, at = [], len(segment), len(segment)
        while at:
            before = at - back[at]
            if last - before > most and at < last:
                cuts.append(at)
                last = at
            at = before
        return cuts[::-1]

    def breaks(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function that says of all code points side by side whether no piece has the two so."""
        beside = {(ord(a), ord(b)) for piece, _, _ in self.usable for a, b in zip(piece, piece[1:])}
        # Characters by a number of their own, zero for all that stand in no longer piece.
        number = {c: i for i, c in enumerate(sorted({c for pair in beside for c in pair}), 1)}
        numbers = np.zeros(max(number, default=0) + 2, np.int32)
        numbers[list(number)] = list(number.values())
        together = np.zeros((len(number) + 1) ** 2, bool)
        together[[number[a] * (len(number) + 1) + number[b] for a, b in beside]] = True

        def apart(codes: np.ndarray) -> np.ndarray:
            known = numbers[np.minimum(codes, len(numbers) - 1)]
            return ~together[known[:-1] * (len(number) + 1) + known[1:]]

        return apart

    def cutter(self) -> Callable[[list[str]], tuple[list[str], np.ndarray]]:
        """A function that gives the segments of words, and how many each word has.

        A segment longer than ``MAX_CHARS`` is cut every so many characters.
        """
        breaks = self.breaks()

        def cut(words: list[str]) -> tuple[list[str], np.ndarray]:
            whole = " " + " ".join(words)
            apart = breaks(np.frombuffer(whole.encode("utf-32-le"), np.uint32))
            first = np.cumsum([0, *[len(w) + 1 for w in words[:-1]]])
            apart[first[1:] - 1] = True  # words need not have stood side by side
            starts = np.concatenate([[0], np.flatnonzero(apart) + 1])
            long = np.flatnonzero(np.diff(starts, append=len(whole)) > MAX_CHARS)
            if len(long):
                ends = np.append(starts[1:], len(whole))
                more = [np.arange(a, b, MAX_CHARS)[1:] for a, b in zip(starts[long], ends[long])]
                starts = np.sort(np.concatenate([starts, *more]))
            begins = np.searchsorted(starts, first)
            bounds = [*starts.tolist(), len(whole)]
            return (
                [whole[a:b] for a, b in zip(bounds, bounds[1:])],
                np.diff(begins, append=len(starts)),
            )

        return cut

    def segmenter(self) -> Callable[[list[bytes]], tuple[pa.Array, np.ndarray]]:
        """A function that gives the segments of texts with their first blank, and how many each has.

        A segment longer than ``MAX_CHARS`` is cut where its best path has two pieces side by side.
        """
        breaks = self.breaks()

        def cut(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
            data = b"".join(texts)
            if not data:
                return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
            raw = np.frombuffer(data, np.uint8)
            at = np.flatnonzero((raw & 0xC0) != 0x80)  # bytes where characters begin
            codes = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
            sizes = np.array([len(t) for t in texts], np.int64)
            first = np.cumsum(sizes) - sizes
            new = np.ones(len(at), bool)
            new[1:] = breaks(codes)
            new[np.searchsorted(at, first[sizes > 0])] = True
            starts = np.flatnonzero(new)
            long = np.flatnonzero(np.diff(starts, append=len(at)) > MAX_CHARS)
            if len(long):
                ends, more, cuts = np.append(starts[1:], len(at)), [], {}
                for a, b in zip(starts[long].tolist(), ends[long].tolist()):
                    segment = codes[a:b].tobytes().decode("utf-32-le")
                    if segment not in cuts:
                        cuts[segment] = np.array(self.best_cuts(segment, MAX_CHARS), np.int64)
                    more.append(cuts[segment] + a)
                starts = np.sort(np.concatenate([starts, *more]))
            offsets = np.append(at[starts], len(raw)).astype(np.int32)
            counts = np.diff(np.searchsorted(offsets[:-1], np.append(first, len(raw))))
            found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
            return found, counts

        return cut


def spread(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at some places with some sizes, one after the other."""
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    return flat[np.repeat(begin - (end - size), size) + np.arange(total)]


def _windows(text: bytes) -> list[bytes]:
    """A text with a blank before it, in parts of about ``SLICE_BYTES`` that no piece goes over."""
    text, cuts = b" " + text, [0]
    while len(text) - cuts[-1] > SLICE_BYTES:
        at = text.find(b" ", cuts[-1] + SLICE_BYTES)
        while at > 0 and text[at - 1 : at] == b" ":
            at = text.find(b" ", at + 1)
        if at < 0:
            break
        cuts.append(at)
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


def _segmented(column: pa.Array, cut: Callable) -> tuple[list[pa.Array], np.ndarray]:
    """The segments of a column of texts, one after the other, and how many each text has."""
    found, counts, parts, owners, held = [], np.zeros(len(column), np.int64), [], [], 0

    def add() -> None:
        each, n = cut(parts)
        found.append(each)
        np.add.at(counts, owners, n)

    for owner, text in enumerate(as_bytes(column)):
        for part in _windows(text) if text else ():
            if parts and held + len(part) > SLICE_BYTES:
                add()
                parts, owners, held = [], [], 0
            parts.append(part)
            owners.append(owner)
            held += len(part)
    if parts:
        add()
    return found, counts


def _distinct(words: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """Different words in the order they come, and which of them each word is."""
    if not words:
        return pa.array([], pa.string()), np.zeros(0, np.int32)
    coded = pa.concat_arrays(words).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def _packed(words: pa.Array) -> tuple[bytes, bytes]:
    """Sizes of words in bytes, and their bytes, both compressed."""
    words = pa.concat_arrays([words])  # from its first byte on
    sizes = pc.binary_length(words).to_numpy().astype(np.uint32)
    data = words.buffers()[2]
    letters = data.slice(0, int(sizes.sum())) if data else b""
    return zstandard.compress(_planes(sizes), 3), zstandard.compress(letters, 3)


def _unpacked(sizes: bytes, letters: bytes) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(_numbers(sizes), dtype=np.int64)]).astype(np.int32)
    data = pa.py_buffer(zstandard.decompress(letters))
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), data)


def _numbers(data: bytes) -> np.ndarray:
    return _from_planes(zstandard.decompress(data))


def block_segments(texts: DataFrame, pieces: Pieces, block_bytes: int) -> DataFrame:
    """(block, count, sizes, letters, times) of the distinct segments of each block of (row, text), written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = pieces.segmenter()
        for block, held in _blocks(batches, block_bytes):
            own, which = _distinct([x for part in held for x in _segmented(part.column(1), cut)[0]])
            sizes, letters = _packed(own)
            times = np.bincount(which, minlength=len(own)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.array([len(own)], pa.int64()),
                    pa.array([sizes], pa.binary()),
                    pa.array([letters], pa.binary()),
                    pa.array([zstandard.compress(_planes(times), 3)], pa.binary()),
                ],
                names=["block", "count", "sizes", "letters", "times"],
            )

    schema = "block long, count long, sizes binary, letters binary, times binary"
    return write_out(texts.mapInArrow(run, schema), "blocks")


def _dealt(blocks: DataFrame, shards: int, known: Callable[[], pa.Array] | None = None) -> DataFrame:
    """(shard, block, number, sizes, letters, times): a block's segments but the known ones, a row per shard.

    Segments are numbered from 0 in the order the block has them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, letters, times in zip(*[c.to_pylist() for c in batch.columns]):
                own, times = _unpacked(sizes, letters), _numbers(times)
                if known is not None:
                    asked = pc.index_in(own, known()).is_null().to_numpy(zero_copy_only=False)
                    own, times = own.filter(pa.array(asked)), times[asked]
                hashes = map(zlib.crc32, own.cast(pa.binary()).to_pylist())
                shard = np.fromiter(hashes, np.int64, len(own)) * shards >> 32
                order = np.argsort(shard, kind="stable")
                own, times, shard = own.take(pa.array(order)), times[order], shard[order]
                bounds = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(own)]
                spans = [(a, b) for a, b in zip(bounds, bounds[1:]) if a < b]
                words = [_packed(own.slice(a, b - a)) for a, b in spans]
                packed = lambda flat: [zstandard.compress(_planes(flat[a:b]), 3) for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(shard[a]) for a, _ in spans], pa.int64()),
                        pa.array([block] * len(spans), pa.int64()),
                        pa.array(packed(order.astype(np.uint32)), pa.binary()),
                        pa.array([sizes for sizes, _ in words], pa.binary()),
                        pa.array([letters for _, letters in words], pa.binary()),
                        pa.array(packed(times), pa.binary()),
                    ],
                    names=["shard", "block", "number", "sizes", "letters", "times"],
                )

    return blocks.select("block", "sizes", "letters", "times").mapInArrow(
        run, "shard long, block long, number binary, sizes binary, letters binary, times binary"
    )


def segments(blocks: DataFrame, shards: int) -> DataFrame:
    """(word, n) of all distinct segments of written blocks."""

    def count(table: pa.Table) -> pa.Table:
        rows = zip(table.column("sizes").to_pylist(), table.column("letters").to_pylist())
        own, which = _distinct([_unpacked(*row) for row in rows])
        times = np.concatenate([_numbers(x) for x in table.column("times").to_pylist()])
        return pa.table({"word": own, "n": np.bincount(which, times, len(own)).astype(np.int64)})

    dealt = _dealt(blocks, shards).select("shard", "sizes", "letters", "times")
    return dealt.groupBy("shard").applyInArrow(count, "word string, n long")


def answers(asked: DataFrame, words: DataFrame, shards: int) -> DataFrame:
    """(block, number, sizes, ids): pieces of the dealt segments of a block, a row per shard, written."""

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        packed = zip(left.column("sizes").to_pylist(), left.column("letters").to_pylist())
        own = [_unpacked(*row) for row in packed]  # none, if the shard's segments are all broadcast
        found = pc.index_in(pa.concat_arrays([pa.array([], pa.string()), *own]), right.column("word").combine_chunks())
        if found.null_count:
            raise RuntimeError("a segment has no pieces")
        at = found.to_numpy()
        ids = right.column("ids").combine_chunks()
        size = pc.list_value_length(ids).to_numpy().astype(np.int64)
        flat, begin = ids.flatten().to_numpy(), np.cumsum(size) - size
        bounds = np.cumsum([0, *map(len, own)])
        each = [at[a:b] for a, b in zip(bounds, bounds[1:])]
        pack = lambda flat: zstandard.compress(_planes(flat), 3)
        return pa.table(
            {
                "block": left.column("block"),
                "number": left.column("number"),
                "sizes": pa.array([pack(size[x].astype(np.uint32)) for x in each], pa.binary()),
                "ids": pa.array([pack(spread(flat, begin[x], size[x])) for x in each], pa.binary()),
            }
        )

    shard = F.shiftright(F.crc32(F.col("word").cast("binary")) * F.lit(shards).cast("long"), 32)
    asked = asked.select("shard", "block", "number", "sizes", "letters")
    answered = asked.groupBy("shard").cogroup(words.select(shard.alias("shard"), "word", "ids").groupBy("shard"))
    return write_out(
        answered.applyInArrow(look, "block long, number binary, sizes binary, ids binary"), "answers"
    )


def lexicon(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, n, ids) of distinct (word, n): the best path through each word's lattice.

    Words are written and dealt out by their characters, so a task's lattices take the same
    memory at any size of input, whatever number of shuffle partitions the session has.
    An id below zero stands for a character without a piece: it is one less than the
    character's code point, negated.
    """
    spark = words.sparkSession
    table = spark.createDataFrame(list(pieces.usable), "piece string, id int, score double")
    reach = spark.createDataFrame(list(pieces.reach.items()), "beginning string, reach int")
    length = F.char_length("word")
    words = write_out(words, "segments")
    chars = words.agg(F.coalesce(F.sum(length), F.lit(0))).first()[0]
    tasks = min(chars // LATTICE_CHARS + 1, LATTICE_TASKS)
    dealt = words.repartition(tasks, "word")
    starts = dealt.select("word", "n", F.explode(F.sequence(F.lit(0), length - 1)).alias("start"))
    bounded = starts.withColumn("beginning", F.expr(f"substring(word, start + 1, {BEGINNING})")).join(
        F.broadcast(reach), "beginning", "left"
    )
    most = F.least(F.coalesce("reach", F.lit(BEGINNING - 1)), length - F.col("start"))
    spans = bounded.select(
        "word", "n", "start", F.explode(F.sequence(F.lit(1), most)).alias("size")
    ).withColumn(
        "piece", F.expr("substring(word, start + 1, size)")
    )
    # The piece table is as long as the model's vocabulary, whatever the corpus.
    edges = (
        spans.join(F.broadcast(table), "piece", "left")
        .filter("id IS NOT NULL OR size = 1")
        .select(
            "word", "n",
            F.struct(
                (F.col("start") + F.col("size")).alias("end"),
                "start",
                F.coalesce("score", F.lit(pieces.unknown)).alias("score"),
                F.coalesce("id", -1 - F.ascii("piece")).alias("id"),
            ).alias("edge"),
        )
    )
    grouped = edges.groupBy("word", "n").agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    none = F.lit(-1)
    begin = F.array(F.struct(F.lit(0.0).alias("score"), none.alias("start"), none.alias("id")))

    def step(best, edge):
        """Best last edges of each place so far, with one more edge; edges come by end, longest first."""
        score = F.get(best, edge["start"])["score"] + edge["score"]
        more = F.struct(score.alias("score"), edge["start"].alias("start"), edge["id"].alias("id"))
        return (
            F.when(F.size(best) == edge["end"], F.concat(best, F.array(more)))
            .when(
                score > F.get(best, edge["end"])["score"],
                F.concat(F.slice(best, 1, edge["end"]), F.array(more)),
            )
            .otherwise(best)
        )

    def back(path, place):
        """One place further to the left; the path has an edge that ends there, or passes over it."""
        last = F.get("best", place)
        on = F.struct(last["start"].alias("at"), F.concat(F.array(last["id"]), path["ids"]).alias("ids"))
        return F.when(path["at"] == place, on).otherwise(path)

    length = F.char_length("word")
    end = F.struct(length.alias("at"), F.array().cast("array<int>").alias("ids"))
    path = F.aggregate(F.sequence(length, F.lit(1), F.lit(-1)), end, back, lambda path: path["ids"])
    folded = grouped.select("word", "n", F.aggregate("edges", begin, step).alias("best"))
    return folded.select("word", "n", path.alias("ids"))


def _blocks(
    batches: Iterator[pa.RecordBatch], most: int
) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Row numbers of first rows and the batches of blocks of about ``most`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            bytes_ = pc.sum(pc.binary_length(part.column(1))).as_py() or 0
            if held and size + bytes_ > most:
                yield held[0].column(0)[0].as_py(), held
                held, size = [], 0
            held.append(part)
            size += bytes_
    if held:
        yield held[0].column(0)[0].as_py(), held


def encode(
    docs: DataFrame,
    pieces: Pieces | None = None,
    keep: Sequence[str] = ("doc_id",),
    frequent_bytes: int = FREQUENT_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns ``keep`` and ``ids``, the piece numbers of ``text``, for each row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    pieces = pieces or Pieces.load()
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        named("text").cast("string").alias("text"),
        F.struct(*[named(c) for c in keep]).alias("kept"),
    )
    context = spark.sparkContext
    with scratch(spark):
        blocks = block_segments(numbered.select("row", "text"), pieces, block_bytes)
        count = blocks.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        shards = max(1, -(-count // SHARD_SEGMENTS))
        words = write_out(lexicon(segments(blocks, shards), pieces), "lexicon")
        # The commonest first: small numbers pack well.
        few = frequent(words, frequent_bytes).select("word", "n", "ids").toArrow()
        few = few.sort_by([("n", "descending"), ("word", "ascending")])
        at = few.column("ids").combine_chunks()
        # Two broadcasts, since no task needs both the words and their pieces.
        known = context.broadcast(few.column("word").combine_chunks())
        known_ids = context.broadcast((np.asarray(at.offsets, np.int32), np.asarray(at.values, np.int32)))
        with handing_up():
            found = answers(_dealt(blocks, shards, lambda: known.value), words, shards)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, packer = pieces.segmenter(), zstandard.ZstdCompressor(level=3)
        for block, held in _blocks(batches, block_bytes):
            parts = [_segmented(part.column(1), cut) for part in held]
            own, which = _distinct([x for each, _ in parts for x in each])
            place = pc.index_in(own, known.value)
            asked = place.is_null().to_numpy(zero_copy_only=False)
            code = place.fill_null(0).to_numpy().astype(np.uint32)
            code[asked] = len(known.value) + np.arange(asked.sum())
            at = 0
            for part, (_, counts) in zip(held, parts):
                codes = code[which[at : at + counts.sum()]]
                at += len(codes)
                kept = part.column(2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([asked.sum()], pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept),
                        pa.array([counts], pa.list_(pa.int32())),
                        pa.array([packer.compress(_planes(codes))], pa.binary()),
                    ],
                    names=["block", "asked", "kept", "counts", "codes"],
                )

    kept_type = numbered.schema["kept"].dataType
    sent = numbered.mapInArrow(
        send,
        T.StructType(
            [
                T.StructField("block", T.LongType()),
                T.StructField("asked", T.IntegerType()),
                T.StructField("kept", T.ArrayType(kept_type)),
                T.StructField("counts", T.ArrayType(T.IntegerType())),
                T.StructField("codes", T.BinaryType()),
            ]
        ),
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        number, own_sizes, own_ids = (
            np.concatenate([np.zeros(0, np.uint32), *map(_numbers, right.column(c).to_pylist())])
            for c in ("number", "sizes", "ids")
        )
        if len(number) != left.column("asked")[0].as_py():
            raise RuntimeError("a block changed between two reads of its rows")
        own = (np.concatenate([[0], np.cumsum(own_sizes, dtype=np.int64)]), own_ids.view(np.int32))
        (ends, flat), (own_ends, own_flat) = (_expanded(*x, pieces.bytes_at) for x in (known_ids.value, own))
        order = np.argsort(number)
        begin = np.concatenate([ends[:-1], own_ends[:-1][order] + len(flat)])
        sizes = np.concatenate([np.diff(ends), np.diff(own_ends)[order]])
        flat = np.concatenate([flat, own_flat]).astype(np.int32)
        ids, kept = [], []
        unpacker = zstandard.ZstdDecompressor()
        for codes, counts, rows in zip(
            left.column("codes").to_pylist(), left.column("counts").to_pylist(), _lists(left.column("kept"))
        ):
            code = _from_planes(unpacker.decompress(codes))
            bounds = np.concatenate([[0], np.cumsum(sizes[code])])[np.cumsum([0, *counts])]
            value = pa.array(spread(flat, begin[code], sizes[code]))
            ids.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), value))
            kept.append(rows)
        rows = pa.chunked_array(kept).combine_chunks()
        return pa.table({**{c: rows.field(i) for i, c in enumerate(keep)}, "ids": pa.chunked_array(ids)})

    fields = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return sent.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(meet, schema)


def _lists(column: pa.ChunkedArray) -> list[pa.Array]:
    return [chunk.slice(i, 1).flatten() for chunk in column.chunks for i in range(len(chunk))]


def _expanded(
    offsets: np.ndarray, values: np.ndarray, bytes_at: Sequence[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and piece numbers of lists, with characters that have no piece as bytes."""
    if not len(values) or values.min() >= 0:
        return offsets, values
    bad = np.flatnonzero(values < 0)
    parts = [[bytes_at[b] for b in chr(-1 - v).encode()] for v in values[bad].tolist()]
    more = np.zeros(len(values), np.int64)
    more[bad] = [len(p) - 1 for p in parts]
    out = np.repeat(values, more + 1)
    begin = np.cumsum(more + 1) - (more + 1)
    out[np.concatenate([b + np.arange(len(p)) for b, p in zip(begin[bad].tolist(), parts)])] = [
        i for p in parts for i in p
    ]
    return np.concatenate([[0], np.cumsum(more + 1)])[offsets], out


def _planes(codes: np.ndarray) -> bytes:
    """The bytes of numbers, lowest ones first, which packs better than number by number."""
    return codes.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def decode(encoded: DataFrame, pieces: Pieces | None = None) -> DataFrame:
    """The table with a column ``text`` decoded from ``ids``; null ids decode to the empty text.

    Byte pieces that are not UTF-8 together become replacement characters.
    """
    texts = (pieces or Pieces.load()).texts
    names = encoded.columns
    at = names.index("ids")

    flat = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes

    def joined(column: pa.ListArray) -> pa.Array:
        """Texts of the lists, each without the blank it begins with."""
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        ids = column.flatten().to_numpy()
        data = spread(flat, begin[ids], sizes[ids])
        ends = np.concatenate([[0], np.cumsum(sizes[ids])])[np.concatenate([[0], np.cumsum(lengths)])]
        starts, stops = np.minimum(ends[:-1] + 1, ends[1:]), ends[1:]
        try:
            whole = pa.array([data[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary())
            return whole.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array(
                [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts, stops)], pa.string()
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, joined(batch.column(at))], names=[*names, "text"]
                )

    fields = [T.StructField(f.name, f.dataType) for f in encoded.schema.fields]
    return encoded.mapInArrow(run, T.StructType([*fields, T.StructField("text", T.StringType())]))
