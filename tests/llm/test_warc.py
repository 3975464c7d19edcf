"""Archives: round trips, revisits, and what is recovered after damage."""

import hashlib
import os

import pytest

from sluice.llm import warc

from .helpers import table, with_clashes

SCHEMA = "page_id long, url string, html string"
BIG, OTHER = "<p>" + "é" * 600, "<b>" + "x" * 1200
ROWS = [
    (1, "http://a", BIG), (2, "http://b\nX: y", BIG), (9, None, BIG), (9, "twice", BIG), (3, "c", OTHER),
    (4, "d", None), (5, "e", ""), (6, "f", "small"), (7, "g", "small"), (None, "h", BIG), (None, "i", "small"),
    (8, "j", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40), (11, "k", "y" * 300_000), (12, "l", "n" * 999),
    (13, "m", "n" * 999), (14, "n", "m" * 1000), (15, "o", "m" * 1000),
]


def wanted(rows):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        holder = max(same, default=None)
        again = len(data) >= 1000 and holder is not None and key != holder
        out.append(
            (key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", holder if again else None)
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("compressed", [True, False])
def test_round_trip(spark, tmp_path, compressed):
    pages = with_clashes(table(spark, tmp_path, ROWS, SCHEMA))
    path = f"{tmp_path}/archives"
    warc.write_archives(pages, path, compressed=compressed, records_per_file=4)
    records = warc.read_archives(spark, path)
    assert records.filter("kind = 'gap'").count() == 0
    found = [
        (int(r.key) if r.key else None, r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None)
        for r in warc.digests(records).collect()
    ]
    assert sorted(found, key=str) == wanted(ROWS)
    held = {r.key: bytes(r.payload) for r in records.filter("record_type = 'response'").collect()}
    assert held["11"] == b"y" * 300_000 and held["3"] == OTHER.encode()


def test_empty_table(spark, tmp_path):
    path = f"{tmp_path}/archives"
    warc.write_archives(table(spark, tmp_path, [], SCHEMA, 1), path)
    assert warc.read_archives(spark, path).count() == 0


def records(count, compressed=True):
    out = []
    for i in range(count):
        load = f"payload {i} ".encode() * 50
        data = warc.record(i, f"http://x/{i}", load, hashlib.sha1(load).digest(), None)
        out.append(warc.member(data) if compressed else data)
    return out


def keys(found):
    return [x[3]["x-key"] for x in found if x[0] == "record"]


def check_places(data, found):
    """Records and gaps lie side by side and cover the archive, but for empty members."""
    at = 0
    for kind, start, size, *_ in found:
        assert start >= at
        assert all(b == 0 or kind for b in data[at:start])
        at = start + size
    assert at <= len(data)


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("where", ["head", "body", "tail"])
def test_a_changed_byte_costs_one_record(compressed, where):
    parts = records(7, compressed)
    place = {"head": 2, "body": len(parts[3]) // 2, "tail": len(parts[3]) - 6}[where]
    broken = bytearray(parts[3])
    broken[place] ^= 0x55
    parts[3] = bytes(broken)
    data = b"".join(parts)
    found = list(warc.salvage(data))
    assert keys(found) == ["0", "1", "2", "4", "5", "6"]
    (gap,) = [x for x in found if x[0] == "gap"]
    assert gap[1] == sum(map(len, parts[:3])) and gap[2] == len(parts[3])
    check_places(data, found)


@pytest.mark.parametrize("compressed", [True, False])
def test_cut_archives_and_rubbish(compressed):
    parts = records(4, compressed)
    whole = b"".join(parts)
    cut = list(warc.salvage(whole[: -len(parts[3]) // 2]))
    assert keys(cut) == ["0", "1", "2"] and cut[-1][0] == "gap"
    rubbish = bytes(range(256)) * 9 + warc.MAGIC * 5 + b"WARC/1.1 nothing" * 5
    mixed = rubbish + parts[0] + parts[1][10:] + rubbish + parts[2] + rubbish
    found = list(warc.salvage(mixed))
    assert keys(found) == ["0", "2"]
    assert sum(x[2] for x in found) == len(mixed)
    assert keys(list(warc.salvage(whole[100:]))) == ["1", "2", "3"]


def test_a_member_with_a_bad_record_inside():
    good, bad = records(1, False)[0], records(1, False)[0].replace(b"payload 0", b"payload X")
    data = warc.member(good) + warc.member(good + bad + good) + warc.member(bad) + warc.member(good)
    found = list(warc.salvage(data))
    assert [x[0] for x in found] == ["record", "record", "gap", "record", "gap", "record"]


def test_empty_and_foreign_archives():
    assert list(warc.salvage(b"")) == []
    assert list(warc.salvage(warc.NOTHING * 3)) == []
    assert [x[0] for x in warc.salvage(b"no archive at all")] == ["gap"]


def test_damage_in_files_is_logged(spark, tmp_path):
    path = tmp_path / "archives"
    os.makedirs(path)
    parts = records(5)
    (path / "a.warc.gz").write_bytes(b"".join([*parts[:2], b"\x00" * 77, *parts[2:]]))
    (path / "b.warc").write_bytes(b"".join(records(3, False)))
    found = warc.read_archives(spark, str(path))
    assert warc.digests(found).count() == 8
    (gap,) = found.filter("kind = 'gap'").collect()
    assert (gap.start, gap.bytes, gap.reason) == (sum(map(len, parts[:2])), 77, "no version line")


@pytest.mark.parametrize(
    "start", [b"\x1f\x8b\x08" + b"\x07" * 13, b"WARC/1.0 but no header ", b"WARC/1.0\r\nname: value\r\nno header "]
)
def test_false_starts_are_passed_once(start):
    """A search never goes again through bytes that an earlier one went through."""
    (record,) = records(1, compressed=False)
    seen = []

    class Counted(bytes):
        def find(self, pattern, at=0, *end):
            place = bytes.find(self, pattern, at, *end)
            seen.append((place if place >= 0 else (end or [len(self)])[0]) - at)
            return place

    data = start * 20_000 + record
    found = list(warc.salvage(Counted(data)))
    assert [x[:3] for x in found] == [("gap", 0, len(start) * 20_000), ("record", len(start) * 20_000, len(record))]
    assert sum(seen) < 8 * len(data)
