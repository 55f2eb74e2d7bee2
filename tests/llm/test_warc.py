"""Seekable bundles: round trips, the format read by a plain decoder, and revisits by definition."""

import base64
import hashlib
import io

import zstandard

from helixframe.llm import warc as X

PAGES = "/root/testdata/sf0.01/pages.parquet"


def expected(rows):
    first = {}
    for i, _, html in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(html or "", i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        f = first.get(html or "")
        refers = None if f is None or f == i else f
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def result(index):
    return sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index.collect()), key=str)


def test_pages_and_copies(spark):
    pages = spark.read.parquet(PAGES)
    pages = pages.unionByName(pages.filter("page_id < 60").selectExpr("page_id + 1000 as page_id", "url", "html"))
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    path = X.scratch(spark, "t")
    X.write_bundles(pages, path, frame_bytes=20_000, bundle_bytes=50_000)
    index = X.read_index(spark, path).cache()
    assert result(index) == expected(rows)
    assert index.select("bundle").distinct().count() > 4
    got = {r.id: bytes(r.payload).decode() for r in X.fetch(spark, path, index.filter("id % 7 = 0")).collect()}
    assert got == {i: h for i, _, h in rows if i % 7 == 0 and i < 1000}
    for r in X.bundles(spark, path).limit(3).collect():
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(r.content), read_across_frames=True).read()
        assert plain == b"".join(X.frame(r.content, e) for e in X.seek_table(r.content))


def test_odd_rows(spark):
    pages = spark.createDataFrame([(3, None, None, "z"), (2, "http://x/é\r\nA: b", "", "z"), (None, "u", "p", "z"), (5, "u", "p", "z"), (5, "u", "p", "z"), (None, "u", "q", "z"), (7, "u", "ß" * 300_000, None)], "page_id long, url string, html string, digest string")
    rows = [tuple(r)[:3] for r in pages.collect()]
    assert result(X.archived(pages)) == expected(rows)
    assert X.archived(pages.limit(0)).count() == 0
    assert {r.record_type for r in X.archived(pages, least_bytes=1).filter("payload_bytes = 0").collect()} == {"response"}
