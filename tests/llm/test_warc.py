from __future__ import annotations

import base64
import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opinio.llm import warc
from opinio.llm.common import table
from opinio.llm.queries import op11_warc
from opinio.session import new_path


class Bytes:
    """A file in memory."""

    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


def read(data):
    return list(warc.salvage(warc.Window(Bytes(data), len(data))))


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def records(payloads, packed):
    plain = [
        warc.record_bytes(str(i), f"http://x/{i}", p, digest(p), len(p), None, i) for i, p in enumerate(payloads)
    ]
    return [warc.member_of(r) if packed else r for r in plain]


PAYLOADS = [b"", b"one", b"WARC/1.1\r\nnot a record\r\n\r\n", b"\x1f\x8b\x08 no member", b"x" * 3_000_000, b"end"]


@pytest.mark.parametrize("packed", [True, False])
def test_whole_files_are_read_whole(packed):
    parts = records(PAYLOADS, packed)
    found = read(b"".join(parts))
    assert [r.payload for r in found] == PAYLOADS
    assert [r.end - r.offset for r in found] == [len(p) for p in parts]
    assert read(b"") == []


@pytest.mark.parametrize("packed", [True, False])
def test_later_records_survive_damage_and_gaps_are_logged(packed):
    rng = random.Random(4)
    payloads = [rng.randbytes(rng.randrange(10, 2000)) for _ in range(40)]
    parts = records(payloads, packed)
    whole = b"".join(parts)
    starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    for _ in range(60):
        n = rng.randrange(len(parts))
        at = rng.randrange(starts[n], starts[n + 1])
        kind = rng.choice(["flip", "cut", "insert"])
        size = rng.randrange(1, 200)
        if kind == "flip":
            hurt = whole[:at] + bytes([whole[at] ^ 0x5A]) + whole[at + 1 :]
        elif kind == "cut":
            hurt = whole[:at] + whole[at + size :]
        else:
            hurt = whole[:at] + rng.randbytes(size) + whole[at:]
        last = n if kind != "cut" else max(i for i in range(len(parts)) if starts[i] < at + size)
        found = read(hurt)
        kept = [r.payload for r in found if isinstance(r, warc.Record)]
        # nothing is made up, and what the damage does not touch is there
        assert kept[:n] == payloads[:n]
        after = payloads[last + 1 :]
        assert not after or kept[-len(after) :] == after
        assert set(kept) <= set(payloads)
        # records and gaps cover the file
        edges = [(r.offset, r.end) for r in found]
        assert edges[0][0] == 0 and edges[-1][1] == len(hurt)
        assert all(a[1] == b[0] for a, b in zip(edges, edges[1:]))


def test_records_inside_a_damaged_payload_are_not_taken_for_records():
    inner = records([b"inner"], packed=False)[0]
    first, second = records([b"head" + inner, b"next"], packed=False)
    hurt = bytearray(first + second)
    hurt[first.index(b"head")] ^= 1
    gap, record = read(bytes(hurt))
    assert gap.reason == "warc-block-digest differs" and (gap.offset, gap.end) == (0, len(first))
    assert record.payload == b"next"


def test_mixed_archives_bad_headers_and_cut_ends():
    plain, packed = records([b"a"], False)[0], records([b"b"], True)[0]
    junk = b"WARC/1.0\r\nno colon\r\n\r\nWARC/1.0\r\nContent-Length: 99999999999\r\n\r\n"
    found = read(junk + plain + packed + plain[:-3])
    assert [type(r).__name__ for r in found] == ["Gap", "Record", "Record", "Gap"]
    assert found[0].end == len(junk) and found[3].reason == "record longer than the file"
    assert read(packed[:-1])[0].reason == "member without an end"


def brute(pages, least=0):
    """The response of each payload by page, computed in plain Python."""
    first = {}
    for n, (key, _, body) in enumerate(pages):
        rank = (key is None, key or 0, n)
        body = (body or "").encode()
        first[body] = min(first.get(body, (rank, n)), (rank, n))
    rows = []
    for n, (key, _, body) in enumerate(pages):
        body = (body or "").encode()
        response = len(body) < least or first[body][1] == n
        refers = None if response else pages[first[body][1]][0]
        rows.append((key, len(body), digest(body), "response" if response else "revisit", refers))
    return sorted(rows, key=str)


PAGES = [
    (3, "http://a/\r\nX: y", "same"), (1, None, "same"), (2, "%41 é", "same"), (1, "http://a", "same"),
    (None, None, None), (None, "u", ""), (9, "u", ""), (10, "u", "é" * 70_000), (11, "u", "WARC/1.1\r\n\r\n"),
]
PAGES += [(100 + i, f"http://hot/{i}", "hot") for i in range(300)]


def rows_of(frame):
    names = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(map(tuple, frame.select(*names).collect()), key=str)


@pytest.mark.parametrize("least", [0, 4])
def test_odd_pages_equal_brute_force(spark, least):
    frame = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id bigint, url string, html string, digest string")
    assert rows_of(warc.archive_round_trip(frame.repartition(7), least=least)) == brute(PAGES, least)
    assert warc.archive_round_trip(frame.limit(0)).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_damaged_archives_of_a_job(spark, monkeypatch, packed):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    frame = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    archive = warc.write_archives(frame.repartition(3), new_path(spark, "warc"), packed=packed)
    folder = Path("/" + archive.path.removeprefix("file:").lstrip("/"))
    files = {r.file: r for r in archive.files.collect()}
    assert sum(f.n_records for f in files.values()) == len(PAGES)
    (folder / "left-by-a-lost-task.warc").write_bytes(b"never listed")
    whole = warc.read_archives(archive).collect()
    assert all(r.reason is None for r in whole) and len(whole) == len(PAGES)
    assert {r.url for r in whole} == {p[1] for p in PAGES}
    bodies = sorted(bytes(r.payload) for r in whole if r.record_type == "response")
    assert bodies == sorted({(p[2] or "").encode() for p in PAGES})
    victim = max(whole, key=lambda r: (r.end - r.offset, r.file))
    path = folder / victim.file
    hurt = bytearray(path.read_bytes())
    hurt[(victim.offset + victim.end) // 2] ^= 0xFF
    path.write_bytes(bytes(hurt))
    again = warc.read_archives(archive).collect()
    gaps = [(r.file, r.offset, r.end) for r in again if r.reason]
    assert gaps == [(victim.file, victim.offset, victim.end)]
    assert len(again) == len(PAGES)


def test_query_over_the_table(spark, data):
    pages = [tuple(r) for r in table(spark, data, "pages").select("page_id", "url", "html").collect()]
    frame = op11_warc(spark, data).withColumn("key", F.col("page_id"))
    assert rows_of(frame) == brute(pages)
