"""WARC archives: a writer, and a reader that goes on after damage.

The writer puts every record into a gzip member of its own, or leaves it plain, through
Spark's text writer with raw bytes as values, so archives land in whatever store Spark
writes to. Records with equal payloads are stored once; the others are revisits.

The reader takes each archive as one row. A member or record is checked (gzip's own
checksum, version line, length, closing lines, digests). After a failed check it searches
for the next gzip header or version line from which a record passes all checks, recovers
what follows, and logs the bytes passed over as a gap with their place and the reason.

Defined results: a null payload is an empty one; a null key or address is left out of the
record and read back as null; of equal payloads with several rows of the largest key, all
these rows are responses; rows without a key are revisits if another row of the payload
has one; a very long payload is one record, held whole with a copy; an empty table gives no
record; an empty archive gives neither records nor gaps.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import named

VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
#: An empty gzip member. Spark's writer puts a separator after every value; this one is
#: part of a valid gzip file and holds nothing.
NOTHING = bytes.fromhex("1f8b0800000000000003" "0300" "0000000000000000")
MAGIC = b"\x1f\x8b\x08"
CHUNK = 8192
FINAL = b"\r\n\r\n"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _clean(value: str) -> str:
    """A header value without control characters, which would end the line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(
    key: object, url: str | None, payload: bytes, digest: bytes, refers_to: object | None
) -> bytes:
    """One plain record: a response, or a revisit that names the row which holds the payload."""
    revisit = refers_to is not None
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    name = lambda k: f"<urn:uuid:{_uuid(k, digest)}>"
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(key)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: {_base32(digest)}",
        f"WARC-Block-Digest: {_base32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if key is not None:
        lines.append(f"X-Key: {_clean(str(key))}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {name(refers_to)}")
        lines.append(f"X-Refers-To-Key: {_clean(str(refers_to))}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + FINAL + block + FINAL


def _uuid(key: object, digest: bytes) -> str:
    h = hashlib.md5(str(key).encode() + digest).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 1000,
    compressed: bool = True,
    records_per_file: int = 10_000,
) -> None:
    """Write a record for every row of ``pages`` to archives below ``path``.

    Of equal payloads of at least ``min_bytes``, the row with the largest key is the
    response. Which payloads repeat comes from a partial aggregate of digests.
    """
    content = F.coalesce(named(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        named(key).alias("key"), named(url).cast("string").alias("url"), content.alias("payload")
    )
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    size = F.octet_length("payload")
    held = (
        rows.filter(size >= min_bytes)
        .groupBy("digest")
        .agg(F.max("key").alias("holder"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "holder")
    )
    placed = rows.join(held, "digest", "left").select(
        "key", "url", "payload", "digest",
        F.when(
            (size >= min_bytes) & ~F.col("key").eqNullSafe(F.col("holder")), F.col("holder")
        ).alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                made = [record(*row) for row in zip(*[c.to_pylist() for c in part.columns])]
                if compressed:
                    made = [member(x) for x in made]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.large_binary())], names=["value"])

    # A plain record ends with two empty lines, of which the separator is the last.
    separator = NOTHING.decode("latin-1") if compressed else "\r\n"
    made = placed.mapInArrow(run, "value binary")
    if not compressed:
        made = made.select(F.expr("substring(value, 1, length(value) - 2)").alias("value"))
    (
        made.select(F.col("value").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", separator)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


class Damaged(ValueError):
    """A member or record that fails a check."""


class Places:
    """Where patterns stand in an archive. What lies ahead of one search is not gone through again."""

    def __init__(self, data: bytes):
        self.data, self.known = data, {}

    def next(self, pattern: bytes, at: int) -> int:
        """The first place of a pattern from ``at`` on; the end if there is none."""
        place = self.known.get(pattern, -1)
        if place < at:
            found = self.data.find(pattern, at)
            place = self.known[pattern] = found if found >= 0 else len(self.data)
        return place

    def next_start(self, at: int) -> int:
        """The next place that could begin a member or a record."""
        return min(self.next(MAGIC, at), self.next(b"WARC/1.", at))


def _parse(data: bytes, at: int, places: Places) -> tuple[int, dict[str, str], bytes]:
    """(end, headers, payload) of the plain record at a place; raises if a check fails."""
    if data[at : at + 7] != b"WARC/1." or data[at + 8 : at + 10] != b"\r\n":
        raise Damaged("no version line")
    body = places.next(FINAL, at)
    if body == len(data):
        raise Damaged("headers do not end")
    headers: dict[str, str] = {}
    start = at + 8
    while start < body:  # line by line: a false start ends at its first line that is no header
        start += 2
        stop = data.find(b"\r\n", start, body)
        stop = body if stop < 0 else stop
        colon = data.find(b":", start, stop)
        if colon < 0:
            raise Damaged("broken header")
        name, value = data[start:colon], data[colon + 1 : stop]
        headers[name.decode("latin-1").strip().lower()] = value.strip().decode("utf-8", "replace")
        start = stop
    body += len(FINAL)
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise Damaged("no length")
    end = body + int(length)
    if data[end : end + len(FINAL)] != FINAL:
        raise Damaged("wrong length")
    block = data[body:end]
    kind = headers.get("warc-type", "")
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        payload = block.partition(FINAL)[2]
    checked = {"warc-block-digest": block}
    if kind != "revisit":
        checked["warc-payload-digest"] = payload
    for name, content in checked.items():
        told = headers.get(name, "")
        if told.startswith("sha1:") and told != _base32(hashlib.sha1(content).digest()):
            raise Damaged(f"wrong {name}")
    return end + len(FINAL), headers, payload


def _inflate(data: memoryview, at: int) -> tuple[int, bytes]:
    """(end, content) of the gzip member at a place; raises if it is cut or its checksum is wrong."""
    unpacker = zlib.decompressobj(31)
    parts = []
    try:
        while not unpacker.eof:
            if at >= len(data):
                raise Damaged("member is cut")
            chunk = data[at : at + CHUNK]
            parts.append(unpacker.decompress(chunk))
            at += len(chunk)
    except zlib.error as error:
        raise Damaged("broken member") from error
    return at - len(unpacker.unused_data), b"".join(parts)


Found = tuple[str, int, int, "dict[str, str] | str", bytes]


def salvage(data: bytes) -> Iterator[Found]:
    """('record', start, bytes, headers, payload) and ('gap', start, bytes, reason, b'') of an archive."""
    at, bad, reason, view, places = 0, -1, "", memoryview(data), Places(data)
    while at < len(data):
        try:
            if data[at : at + 3] == MAGIC:
                end, content = _inflate(view, at)
                inner = list(salvage(content)) if content else []
                if inner and not any(x[0] == "record" for x in inner):
                    raise Damaged(f"member without a record: {inner[0][3]}")
                found = [(kind, at, end - at, what, load) for kind, _, _, what, load in inner]
            else:
                end, headers, payload = _parse(data, at, places)
                found = [("record", at, end - at, headers, payload)]
        except Damaged as error:
            if bad < 0:
                bad, reason = at, str(error)
            at = places.next_start(at + 1)
            continue
        if bad >= 0:
            yield "gap", bad, at - bad, reason, b""
            bad = -1
        yield from found
        at = end
    if bad >= 0:
        yield "gap", bad, len(data) - bad, reason, b""


FIELDS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
    "refers_to_id": "warc-refers-to", "key": "x-key", "refers_to": "x-refers-to-key",
    "told_bytes": "x-payload-length", "told_digest": "warc-payload-digest",
}
SCHEMA = T.StructType(
    [T.StructField("archive", T.StringType()), T.StructField("kind", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("start", "bytes")]
    + [T.StructField("reason", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in FIELDS]
    + [T.StructField("payload", T.BinaryType())]
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives below a path; ``kind`` tells them apart.

    ``told_*`` is what a record's headers say of the whole payload; a revisit's own
    ``payload`` is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                archive = batch.column(0)[at].as_py()
                rows: list[dict] = []
                held = 0
                for kind, start, size, what, payload in salvage(batch.column(1)[at].as_py()):
                    row = {"archive": archive, "kind": kind, "start": start, "bytes": size}
                    if kind == "gap":
                        row["reason"] = what
                    else:
                        row |= {c: what.get(h) for c, h in FIELDS.items()} | {"payload": payload}
                    rows.append(row)
                    held += len(payload) + 500
                    if held > 4 << 20:
                        yield _rows(rows)
                        rows, held = [], 0
                yield _rows(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(run, SCHEMA)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {T.LongType(): pa.int64(), T.BinaryType(): pa.binary(), T.StringType(): pa.string()}
    columns = [pa.array([r.get(f.name) for r in rows], kinds[f.dataType]) for f in SCHEMA.fields]
    return pa.RecordBatch.from_arrays(columns, names=SCHEMA.names)


def digests(records: DataFrame) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) of the records read.

    What a response holds is measured on it; a revisit tells what its response holds.
    """
    whole = F.col("record_type") == "response"
    told = F.regexp_replace("told_digest", "^sha1:", "")
    return records.filter("kind = 'record'").select(
        "key",
        F.when(whole, F.octet_length("payload")).otherwise(F.col("told_bytes")).cast("long").alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(_base32_to_hex(told)).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def _base32_to_hex(text: F.Column) -> F.Column:
    """Each base32 letter is five bits; 32 letters are a SHA-1."""
    letters = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.lower(
            F.lpad(F.conv(_to_base32_digits(F.substr(text, i * 4 + 1, F.lit(4))), 32, 16), 5, "0")
        ),
    )
    return F.array_join(letters, "")


def _to_base32_digits(text: F.Column) -> F.Column:
    """RFC 4648 letters to the digits 0-9 and A-V that ``conv`` takes."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV")
