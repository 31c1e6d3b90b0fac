import base64
import hashlib

import pytest

from snapmart.llm import warc

PAGES = [
    (3, "http://a.example/x?q=1#f", "<p>same</p>"),
    (1, "http://a.example/y", "<p>same</p>"),
    (2, None, None),
    (4, "no scheme\r\nWARC-Type: bad", ""),
    (5, "https://b.example", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (6, "https://é.example/ü", "é\U0001f600" * 5000),
    (None, "http://c.example/", "<p>same</p>"),
    (7, "http://d.example/", "only"),
    (7, "http://d.example/", "only"),  # repeated row
]


def slow(pages):
    firsts = {}
    for page_id, _, html in pages:
        html = html or ""
        if page_id is not None and (html not in firsts or page_id < firsts[html]):
            firsts[html] = page_id
    out, taken = [], set()
    for page_id, _, html in pages:
        data, first = (html or "").encode(), firsts.get(html or "")
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        response = page_id == first and digest not in taken
        taken.add(digest) if response else None
        out.append((page_id, len(data), digest, "response" if response else "revisit", None if response else first))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "pages.parquet")
    rows = [(*row, "x", "y", 1) for row in PAGES]
    spark.createDataFrame(rows, "page_id long, url string, html string, row_id string, payload string, key int").write.parquet(path)
    return spark.read.parquet(path)


def test_round_trip_against_brute_force(pages):
    got = warc.archived_pages(pages).collect()
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(rows, key=str) == slow(PAGES)


def test_small_payloads_are_not_revisited(pages):
    got = warc.archived_pages(pages, smallest_revisited=5).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == {3, None}


def test_payloads_come_back_whole(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(pages, path)
    records = warc.read_records(spark, path).cache()
    assert records.count() == 3 * len(PAGES)
    payloads = {bytes(r.payload).decode() for r in records.filter("type = 'response'").collect()}
    assert payloads == {row[2] or "" for row in PAGES}
    captures = warc.transactions(records).collect()
    assert len(captures) == len(PAGES)
    for r in captures:
        assert r.request.type == "request" and r.response.type in ("response", "revisit") and len(r.metadata) == 1


def test_transactions_follow_identifiers_of_any_side(spark):
    rows = [
        ("r1", "response", []), ("q1", "request", ["r1"]), ("m1", "metadata", ["q1"]),  # through the request
        ("r2", "revisit", ["q2"]), ("q2", "request", []), ("m2", "metadata", ["r2"]), ("m3", "metadata", ["r2"]),
        ("q9", "request", ["gone"]), ("i", "warcinfo", []),
    ]
    records = spark.createDataFrame(rows, "record_id string, type string, concurrent_to array<string>")
    got = {r.capture_id: r for r in warc.transactions(records).collect()}
    assert set(got) == {"r1", "r2", "q9", "i"}
    assert got["r1"].request.record_id == "q1" and [m.record_id for m in got["r1"].metadata] == ["m1"]
    assert got["r2"].request.record_id == "q2" and [m.record_id for m in got["r2"].metadata] == ["m2", "m3"]
    assert got["q9"].response is None and got["q9"].request.record_id == "q9"


def test_empty(spark, pages):
    assert warc.archived_pages(pages.limit(0)).count() == 0
