import base64
import hashlib
from collections import defaultdict

import pytest
from common import MIDDLE, table
from shotframe.llm import warc
from shotframe.llm.queries import op2_warc


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_pages_come_back(spark):
    pages = table("pages", MIDDLE)
    first = defaultdict(list)
    for r in pages:
        first[(r["html"] or "").encode()].append(r["page_id"])
    want = sorted((r["page_id"], len((r["html"] or "").encode()), sha((r["html"] or "").encode()),
                   "response" if r["page_id"] == min(first[(r["html"] or "").encode()]) else "revisit",
                   None if r["page_id"] == min(first[(r["html"] or "").encode()]) else min(first[(r["html"] or "").encode()]))
                  for r in pages)
    rows = op2_warc(spark, MIDDLE).collect()
    assert sorted(tuple(r)[:5] for r in rows) == want
    assert all(r.error is None for r in rows)


def test_edge_rows_and_segments(spark, tmp_path):
    big = "ä" * 70_001
    rows = [(1, "http://a/", big, 0), (2, None, big, 0), (3, "x\r\ny", None, 0), (4, "", "", 0), (5, "u", "WARC/1.1\r\n\r\n\r\n", 0),
            (6, "u", "once", 0), (6, "u", "once", 0), (None, "u", "nobody", 0), (None, "u", "once", 0)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, head int")
    path = str(tmp_path / "w")
    warc.write_warc(df, path, "page_id", "url", "html", segment_bytes=1000, records_per_file=7)
    out = warc.read_warc(spark, path).collect()
    got = sorted(((r.row_id, r.payload_bytes, r.record_type, r.refers_to) for r in out), key=repr)
    assert got == sorted([(1, 140_002, "response", None), (2, 140_002, "revisit", 1), (3, 0, "response", None),
                          (4, 0, "revisit", 3), (5, 14, "response", None), (6, 4, "response", None), (6, 4, "response", None),
                          (None, 6, "response", None), (None, 4, "revisit", 6)], key=repr)
    assert {r.payload.decode() for r in out if r.payload is not None} == {big, "", "WARC/1.1\r\n\r\n\r\n", "once", "nobody"}
    assert all(r.error is None for r in out)


def test_lost_segment_is_reported(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "x" * 5000)], "page_id bigint, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    warc.write_warc(df, path, "page_id", "url", "html", segment_bytes=1000, records_per_file=1)
    files = sorted((tmp_path / "w").glob("part-*"))
    assert len(files) > 4
    some = [f"file://{f}" for k, f in enumerate(files) if k != 2]
    out = warc.read_warc(spark, some).collect()
    assert [(r.payload, r.error) for r in out] == [(None, "a segment is missing")]


def test_chunked_framing():
    for n in (0, 1, 7, 8, 9, 100):
        body = bytes(range(n))
        assert warc.unchunked(warc.chunked(body, 8)) == body
    assert warc.unchunked(b"3;name=v\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc", b"zz\r\n", b"3\r\nabcX\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    warc.write_warc(df, str(tmp_path / "w"), "page_id", "url", "html")
    assert warc.read_warc(spark, str(tmp_path / "w")).collect() == []
