import hashlib
import io
import zlib

import pytest

from squall.llm import warc
from tests.llm import data

BIG = "x" * 1500


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", "o") for i, u, h in rows],
                                 "page_id long, url string, html string, digest string, original string")


ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://a/3 é", BIG), (4, None, "small"), (5, "u", "small"),
        (6, "u", None), (7, "u", ""), (None, "u", "y" * 2000), (8, "u", "é" * 499), (9, "u", "é" * 500),
        (10, "u", "é" * 500), (11, "u", "\r\n\r\n" * 400), (12, "u", "z" * 1200), (12, "u", "z" * 1200),
        (None, "v", "y" * 2000), (13, "u", "q" * 3_000_000)]


def test_roundtrip(spark, tmp):
    pages = data.on_disk(_pages(spark, ROWS), f"{tmp}/pages")
    got = warc.archive_roundtrip(pages).collect()
    assert len(got) == len(ROWS)
    size = lambda h: len((h or "").encode())
    digest = lambda h: hashlib.sha1((h or "").encode()).hexdigest()
    assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest) for r in got) == \
        sorted((i or 0, size(h), digest(h)) for i, _, h in ROWS)
    kind = {}
    for r in got:
        kind.setdefault(r.page_id, []).append((r.record_type, r.refers_to))
    assert kind[1] == kind[2] == [("revisit", 3)] and kind[3] == [("response", None)]
    assert kind[4] == kind[5] == kind[6] == kind[7] == kind[8] == [("response", None)]
    assert kind[9] == [("revisit", 10)] and kind[10] == [("response", None)]
    assert sorted(kind[12]) == [("response", None), ("revisit", 12)]       # repeated rows: one response
    assert sorted(kind[None]) == [("response", None), ("revisit", None)]


def test_empty_table(spark, tmp):
    pages = data.on_disk(_pages(spark, ROWS).where("false"), f"{tmp}/none")
    assert warc.archive_roundtrip(pages).count() == 0


def test_files_roll_over_and_payloads_come_back(spark, tmp, monkeypatch):
    pages = data.on_disk(_pages(spark, ROWS), f"{tmp}/pages").coalesce(1)
    files = warc.write_archives(pages, f"file://{tmp}/warc")
    got = {r.page_id: bytes(r.payload) for r in warc.read_archives(files, payloads=True).collect() if r.record_type == "response"}
    assert got[3] == BIG.encode() and got[11] == b"\r\n\r\n" * 400 and len(got[13]) == 3_000_000


def _archive(n=3):
    rows = [{"page_id": i, "url": f"http://h/{i}", "html": f"text {i} " * 300, "place": i, "original": None} for i in range(n)]
    return [warc.record_bytes(r) for r in rows]


def test_every_record_is_a_member_of_its_own():
    for member in _archive():
        inflate = zlib.decompressobj(wbits=31)
        assert inflate.decompress(member).endswith(b"\r\n\r\n") and inflate.eof and not inflate.unused_data


class Drip(io.BytesIO):
    def read(self, n=-1):
        return super().read(min(n, 7))


def test_reading_in_tiny_pieces():
    assert [r["page_id"] for r in warc.read_records(Drip(b"".join(_archive())))] == [0, 1, 2]


def test_truncated_and_altered_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"".join(_archive())[:-20])))
    raw = zlib.decompress(_archive(1)[0], wbits=31)
    pack = zlib.compressobj(wbits=31)
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(pack.compress(raw.replace(b"text 0", b"test 0", 1)) + pack.flush())))
