"""Archives: round trips, record borders inside payloads, both ARC versions."""

import hashlib
import io

import pytest

from tillstream.llm import warc
from tillstream.llm.queries import QUERIES

LONG = "<p>" + "long enough to be stored once " * 5
PAGES = [(1, "http://a/x y\tz", "<p>één</p>"), (2, None, None), (3, "http://b", ""), (4, "http://c", LONG), (5, "http://d", LONG), (6, "http://é", LONG),
         (7, "u", "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 3), (8, "u", "http://x 0.0.0.0 20200101000000 text/html 3\nabc\n"),
         (9, "u", "\r\n\r\n\n\n"), (10, "u", "z" * 300_000), (11, "u", "same"), (12, "u", "same"), (13, "u", LONG), (13, "u", LONG), (None, "u", LONG),
         (14, "u", "y" * 99), (15, "u", "y" * 99), (16, "u", "y" * 100), (17, "u", "y" * 100)]


def test_round_trip(spark):
    pages = spark.createDataFrame([(i, u, h, "t") for i, u, h in PAGES], "page_id long, url string, html string, record_type string")
    found = warc.archived(pages).collect()
    want = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        same = [k for k, _, h in PAGES if (h or "") == (html or "") and k is not None]
        again = len(body) >= 100 and len(same) > 1 and i != min(same)
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_payloads_survive_the_conversion(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    warc.write_arc(pages, f"{tmp_path}/arc")
    warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    rows = warc.read_warc(spark, f"{tmp_path}/warc").collect()
    stored = {r.page_id: r for r in rows if r.record_type == "response"}
    assert bytes(stored[7].payload).decode() == PAGES[6][2]
    assert stored[1].url == "http://a/x%20y%09z" and stored[2].url == "-" and stored[1].date == "2020-01-01T00:00:00Z"
    assert len({r.record_id for r in rows}) == len(PAGES)
    assert all(r.payload is None and r.refers_to_id == stored[4].record_id for r in rows if r.page_id in (5, 6))


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    blocks = [b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\nbody\n", b"", b"bin\x00\xff\n\n", b"last"]
    data = warc.version_block(version, "20011231235959").encode() + b"\n"
    for k, block in enumerate(blocks):
        data += warc.arc_header(version, f"http://h/{k}", "1.2.3.4", "20011231235959", "text/html", len(block)).encode() + b"\n" + block + b"\n"
        if k == 1:
            data += b"damaged line\nmore of it\n"
    found = [*warc.arc_records(io.BytesIO(data))]
    assert [b for _, _, b in found] == blocks
    assert [f["URL"] for _, f, _ in found] == [f"http://h/{k}" for k in range(4)]
    assert all(f["Archive-date"] == "20011231235959" and f["IP-address"] == "1.2.3.4" for _, f, _ in found)
    assert all(data[o:].startswith(f["URL"].encode()) for o, f, _ in found)
    assert ("Result-code" in found[0][1]) == (version == 2)


def test_many_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS", 7)
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "repeat(concat('p', id % 10), 60) AS html").coalesce(2)
    found = warc.archived(pages).collect()
    assert {r.page_id: r.refers_to for r in found} == {i: (i % 10 if i >= 10 else None) for i in range(40)}


def test_empty(spark):
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query(spark, sf):
    assert QUERIES["op4_warc"](spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()
