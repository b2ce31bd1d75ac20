"""WARC archives: exact round trip and look-ups."""

from __future__ import annotations

import gzip

import pytest

from courtlake.llm import warc
from courtlake.llm.queries import ORACLES, QUERIES
from courtlake.session import shared_dir
from harness.check import _rows, connect


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_whole_table(spark, scale):
    sf_dir = f"/root/testdata/{scale}"
    found = QUERIES["op1_warc_capture_index"](spark, sf_dir).toArrow()
    theirs = connect(sf_dir).sql(ORACLES["op1_warc_capture_index"]).to_arrow_table()
    assert found.num_rows == theirs.num_rows
    assert _rows(found, sorted(found.column_names)) == _rows(theirs, sorted(found.column_names))


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, key string")


ROWS = [
    (5, "http://a.example.com/x", "same"), (2, "https://b.example.com/", "same"), (2, "http://a.example.com/x", "same"),
    (9, None, None), (8, "not a url", ""), (7, "http://[broken/", "other"), (None, "http://a.example.com/x", "same"),
    (None, "http://c.example.org:8080/p q\n?x=1#f", "only without id"), (11, "http://A.example.com:80/x#part", "Ünï" * 20_000),
]


def test_round_trip(spark):
    path = shared_dir(spark, "test-warc")
    archive = warc.write_archive(spark, pages(spark, ROWS), path)
    found = warc.look_up(spark, archive, pages(spark, ROWS)).collect()
    first = {}
    for page_id, _, html in ROWS:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    expected = []
    for page_id, _, html in ROWS:
        html = html or ""
        other = first.get(html) if first.get(html) != page_id else None
        expected.append((page_id, len(html.encode()), warc.base32_sha1(html.encode()),
                         "response" if other is None else "revisit", other,
                         html.encode() if other is None else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
            None if r.payload is None else bytes(r.payload)) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    some = warc.look_up(spark, archive, spark.createDataFrame([("http://a.example.com/x",), ("http://z.org/",)], "url string"))
    assert sorted(r.page_id or 0 for r in some.collect()) == [0, 2, 5, 11]
    small = warc.write_archive(spark, pages(spark, ROWS), shared_dir(spark, "test-warc"), min_bytes=5)
    kinds = [r.record_type for r in warc.look_up(spark, small, pages(spark, ROWS)).collect()]
    assert kinds.count("revisit") == 0
    empty = warc.write_archive(spark, pages(spark, ROWS).limit(0), shared_dir(spark, "test-warc"))
    assert warc.look_up(spark, empty, pages(spark, ROWS)).count() == 0


def test_many_blocks_and_shards(spark):
    """Keys that fill several blocks and shards, one URL across many of them."""
    rows = [(i, f"http://h{i % 40}.example.com/" if i % 3 else "http://hot.example.com/", f"text {i}") for i in range(300)]
    archive = warc.write_archive(spark, pages(spark, rows), shared_dir(spark, "test-warc"),
                                 block_lines=7, shard_captures=60)
    assert len(archive.shards) > 3
    wanted = ["http://hot.example.com/", "http://h7.example.com/", "http://absent.example.com/"]
    found = warc.look_up(spark, archive, spark.createDataFrame([(u,) for u in wanted * 2], "url string"))
    assert sorted(r.page_id for r in found.collect()) == sorted(i for i, u, _ in rows if u in wanted)


def test_records_are_plain_warc():
    data = warc._gzip(warc.record(3, "http://x/", b"body", warc.base32_sha1(b"body"), None, "n"))
    fields, payload = warc.parsed(gzip.decompress(data))
    assert payload == b"body" and fields["WARC-Type"] == "response" and fields["WARC-Target-URI"] == "http://x/"
    assert warc.url_key("https://www.Example.com/a?b=1#c") == "com,example,www)/a?b=1"
