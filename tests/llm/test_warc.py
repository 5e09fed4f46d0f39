"""WARC archives: exact round trip, revisits, byte-range reads and the defined edge cases."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from worklens.llm import warc
from worklens.session import scratch_path

PAGES = "page_id long, url string, html string, archive string, digest int"
BIG = "<p>" + "naïve 漢字 " * 200


def rows():
    return [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, "http://b/ü\r\nX: y", BIG), (3, None, BIG + "x"),
            (4, "http://a/4", None), (5, "http://a/5", ""), (6, "http://a/6", "short"), (7, "http://a/7", "short"),
            (8, "http://c/", "y" * 999), (10, "http://c/", "y" * 999), (11, "u", "z" * 1000), (12, "u", "z" * 1000),
            (12, "u", "z" * 1000), (None, "n", BIG), (None, None, "only null " * 200), (None, "", "only null " * 200),
            (13, "crlf", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (14, "long", "w" * 3_000_000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in rows()], PAGES).repartition(3)


@pytest.fixture(scope="module")
def archived(spark, pages):
    folder = scratch_path(spark, "warc-test")
    return folder, warc.write_archives(pages, folder, archive_bytes=3000)


def order(rs):
    return sorted(map(tuple, rs), key=lambda r: tuple((x is not None, x) for x in r))


def test_contract(pages):
    df = warc.write_and_read(pages)
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    raw = [(p, (h or "").encode()) for p, _, h in rows()]
    want = []
    for p, body in raw:
        top = max((q for q, b in raw if b == body and q is not None), default=None)
        again = len(body) >= 1000 and top is not None and p != top
        want.append((p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response",
                     top if again else None))
    assert order(df.collect()) == order(want)


def test_records_round_trip(archived):
    folder, index = archived
    got = [(r.page_id, bytes(r.payload)) for r in warc.read_records(index, folder).collect()
           if r.record_type == "response"]
    kinds = {(r.page_id, r.digest): r.record_type for r in index.collect()}
    want = [(p, (h or "").encode()) for p, _, h in rows()
            if kinds[p, hashlib.sha1((h or "").encode()).hexdigest()] == "response"]
    assert order(got) == order(want)


def test_archives_are_plain_warc(archived):
    """Every archive unpacks as one gzip file of records, one after the other, as the index says."""
    folder, index = archived
    by_file = {}
    for r in index.orderBy("archive", "offset").collect():
        by_file.setdefault(r.archive, []).append(r)
    assert len(by_file) > 3  # small archives roll over
    for name, rs in by_file.items():
        path = f"{folder}/{name}".removeprefix("file://")
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:i]) for i in range(len(rs))]
        assert os.path.getsize(path) == sum(r.length for r in rs)
        data = gzip.open(path).read()
        for r in rs:
            head, _, data = data.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            n = int(fields["Content-Length"])
            assert fields["WARC-Type"] == r.record_type and fields["WARC-Payload-Digest"] == f"sha1:{r.digest}"
            assert ("WARC-Refers-To" in fields) == (r.record_type == "revisit")
            block, data = data[:n], data[n:]
            if r.record_type == "response":
                assert hashlib.sha1(block.partition(b"\r\n\r\n")[2]).hexdigest() == r.digest
            assert data.startswith(b"\r\n\r\n")
            data = data[4:]
        assert data == b""


def test_selection(archived):
    folder, index = archived
    chosen = index.where(F.col("url").startswith("http://a/"))
    got = warc.read_records(chosen, folder)
    assert sorted(r.page_id for r in got.collect()) == [1, 2, 4, 5, 6, 7]
    # a revisit whose response was not chosen has no payload to measure
    alone = warc.resolve(warc.read_records(index.where("page_id = 1"), folder)).collect()
    assert [(r.record_type, r.refers_to, r.payload_digest) for r in alone] == [("revisit", 9, None)]


def test_coalesced_ranges():
    ranges = [("a", 0, 10), ("a", 10, 5), ("a", 25, 5), ("a", 200, 10), ("b", 205, 10), ("b", 215, 80), ("b", 295, 30)]
    got = list(warc.coalesce_ranges(ranges, read_bytes=100, gap_bytes=20))
    assert [(f, s, e) for f, s, e, _ in got] == [("a", 0, 30), ("a", 200, 210), ("b", 205, 295), ("b", 295, 325)]
    assert [p for *_, ps in got for p in ps] == [(o, n) for _, o, n in ranges]
    assert list(warc.coalesce_ranges([])) == []
    huge = list(warc.coalesce_ranges([("a", 0, 500), ("a", 500, 1)], read_bytes=100))
    assert [(s, e) for _, s, e, _ in huge] == [(0, 500), (500, 501)]


def test_damage_is_an_error(archived):
    member = warc.make_record(1, "u", b"body", "d", None, False)
    assert warc.parse_record(member)[2] == b"body"
    with pytest.raises(Exception):
        warc.parse_record(member[:-9])


def test_nothing(spark, pages):
    assert warc.write_and_read(pages.where(F.lit(False))).collect() == []
