"""WARC archives: SQL, round trip, pushed predicates, archives of other writers, broken ones."""

import base64
import gzip
import hashlib

import pytest

from tallyloom.llm import warc
from tallyloom.llm.common import scratch_path
from tools.check_queries import compare, duck

PAGES = "page_id long, url string, html string, record_type string, digest string"


def test_query_matches_sql(spark, sf_dir):
    from __spark_entry__ import oracle_sql, queries

    name = "op8_warc"
    assert compare(spark, duck(sf_dir), sf_dir, name, queries()[name], oracle_sql()[name]).startswith("ok")


@pytest.fixture(scope="module")
def pages(spark):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nWARC/1.1\r\n"
    rows = [
        (1, "http://a/1", "<p>é中</p>"), (2, "http://a/2", "<p>é中</p>"), (3, None, None),
        (4, "x\r\ny", ""), (5, "u", tricky), (6, "u", tricky), (6, "u", tricky),
        (None, "u", tricky), (7, "u", "z" * 3_000_000), (8, "u", "end\r\n\r\n"), (None, None, None),
    ]
    return spark.createDataFrame([(*r, "r", "d") for r in rows], PAGES).repartition(3)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, pages, compression):
    path = scratch_path(spark, "test-warc")
    warc.write_warc(pages, path, compression=compression)
    rows = warc.read_warc(spark, path).collect()
    assert len(rows) == pages.count()
    best = {}
    for r in pages.collect():
        html = r.html or ""
        best.setdefault(html, []).append(r.page_id)
    for html, ids in best.items():
        known = [i for i in ids if i is not None]
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        got = [r for r in rows if r.payload_digest == digest]
        assert sorted(map(str, (r.page_id for r in got))) == sorted(map(str, ids))
        for r in got:
            assert r.payload_bytes == len(html.encode())
            if r.record_type == "response":
                assert r.payload == html.encode() and r.refers_to is None and r.page_id == max(known)
            else:
                assert r.payload is None and r.refers_to == max(known) != r.page_id


def test_small_payloads_are_responses(spark, pages):
    path = scratch_path(spark, "test-warc")
    warc.write_warc(pages, path, revisit_bytes=20)
    rows = warc.read_warc(spark, path, payload=False).collect()
    assert all(r.record_type == "response" for r in rows if r.payload_bytes < 20)
    assert any(r.record_type == "revisit" for r in rows)
    assert all(r.payload is None for r in rows)


def test_pushed_predicates(spark, pages):
    path = scratch_path(spark, "test-warc")
    warc.write_warc(pages, path)
    every = warc.read_warc(spark, path)
    want = [r for r in every.collect() if r.record_type == "revisit" and (r.page_id or 0) >= 2]
    got = every.where("record_type = 'revisit' and page_id >= 2")
    assert sorted(got.select("page_id").collect()) == sorted((r.page_id,) for r in want)
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert "revisit" in plan
    assert every.where("decode(payload, 'UTF-8') like '%é%'").count() == 1
    assert every.where("record_type in ('request', 'metadata')").count() == 0


def test_no_pages(spark):
    path = scratch_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame([], PAGES), path)
    assert warc.read_warc(spark, path).count() == 0


def _record(kind, block, *headers, end=b"\r\n"):
    lines = [b"WARC/1.0", b"WARC-Type: " + kind, *headers, b"content-length: %d" % len(block)]
    return end.join([*lines, b"", b""]) + block + b"\r\n\r\n"


HTTP = b"Content-Type: application/http; msgtype=response"
LATIN = "h\u00e9 \u00df".encode("latin-1")


def _foreign():
    """Records as other writers make them, and (type, record id, payload) of each."""
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nhello\r\n1;x=y\r\n!\r\n0\r\n\r\n"
    ids = [b"<urn:uuid:0f1e-%d>" % i for i in range(8)]
    rid = [b"WARC-Record-ID: " + i for i in ids]
    made = [
        (b"warcinfo", b"software: other\r\n", (rid[0], b"Content-Type: application/warc-fields"), b"software: other\r\n"),
        (b"request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", (rid[1], b"Content-Type: application/http;msgtype=request"), b""),
        (b"response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + LATIN, (rid[2], HTTP, b"WARC-Target-URI: http://a/\xe9",
         b"WARC-Payload-Digest: md5:abc"), LATIN),
        (b"response", chunked, (rid[3], HTTP, b"WARC-Payload-Digest: sha1:XYZ"), b"hello!"),
        (b"response", b"HTTP/1.1 204 No Content\r\nTransfer-Encoding: chunked\r\n\r\nzz", (rid[4], HTTP), b"zz"),
        (b"resource", b"", (rid[5],), b""),
        (b"revisit", b"HTTP/1.1 200 OK\r\n\r\n", (rid[6], HTTP, b"WARC-Refers-To:\r\n " + ids[2]), None),
        (b"conversion", b"text\n\nWARC/1.0\r\n", (rid[7],), b"text\n\nWARC/1.0\r\n"),
    ]
    records = [_record(kind, block, *headers) for kind, block, headers, _ in made]
    return records, [(m[0].decode(), i.decode(), m[3]) for m, i in zip(made, ids, strict=True)]


@pytest.mark.parametrize("form", ["plain", "one member", "member per record"])
def test_archives_of_other_writers(spark, tmp_path, form):
    records, want = _foreign()
    whole = b"".join(records)
    data = {"plain": whole, "one member": gzip.compress(whole)}.get(form) or b"".join(map(gzip.compress, records))
    (tmp_path / ("a.warc" if form == "plain" else "a.warc.gz")).write_bytes(data)
    (tmp_path / "empty.warc").write_bytes(b"")
    (tmp_path / "unix.warc").write_bytes(_record(b"metadata", b"a: b", b"WARC-Record-ID: <x>", end=b"\n"))
    read = warc.read_warc(spark, str(tmp_path))
    rows = read.collect()
    got = sorted((r.record_type, r.record_id, None if r.payload is None else bytes(r.payload)) for r in rows)
    assert got == sorted([*want, ("metadata", "<x>", b"a: b")], key=lambda r: r[:2])
    assert all(r.page_id is None and r.refers_to is None for r in rows)
    named = {r.record_id: r for r in rows}
    assert named["<urn:uuid:0f1e-6>"].refers_to_id == "<urn:uuid:0f1e-2>"
    assert named["<urn:uuid:0f1e-2>"].payload_digest == "md5:abc"
    assert named["<urn:uuid:0f1e-2>"].payload_bytes is None
    assert named["<urn:uuid:0f1e-2>"].target_uri == "http://a/\ufffd"
    assert named["<urn:uuid:0f1e-3>"].payload_digest == "XYZ"
    assert named["<urn:uuid:0f1e-0>"].payload_bytes == len(want[0][2])
    assert read.where("record_id = '<urn:uuid:0f1e-3>' and record_type = 'response'").count() == 1
    assert warc.read_warc(spark, str(tmp_path), payload=False).where("payload is null").count() == len(rows)


@pytest.mark.parametrize("payload", [True, False])
@pytest.mark.parametrize("broken", ["block", "headers", "gzip", "junk", "length"])
def test_broken_archives_stop_the_job(spark, tmp_path, broken, payload):
    whole = _record(b"resource", bytes(range(256)) * 40, b"WARC-Record-ID: <x>")
    data = {
        "block": whole[:5000], "headers": whole[:30], "gzip": gzip.compress(whole)[:-200],
        "junk": whole + b"junk\r\n", "length": whole.replace(b"content-length", b"x-length"),
    }[broken]
    (tmp_path / ("a.warc.gz" if broken == "gzip" else "a.warc")).write_bytes(data)
    with pytest.raises(Exception, match="a.warc|[Tt]runcated|ended"):
        warc.read_warc(spark, str(tmp_path), payload).collect()
