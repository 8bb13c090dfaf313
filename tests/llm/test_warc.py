import base64
import gzip
import hashlib
import io
from collections import Counter, defaultdict

import pytest

from rillflow.llm.queries import op2_warc
from rillflow.llm.warc import member, members, page_archive, page_record, plain_members, read_pages, read_warc, record, write_pages

SCHEMA = "page_id long, url string, html string, digest string, first string, size long, n int, id string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def slow(rows, least):
    groups = defaultdict(list)
    for page, html in rows:
        groups[(html or "").encode()].append(page)
    want = Counter()
    for payload, pages in groups.items():
        known = [p for p in pages if p is not None]
        first = min(known) if known else None
        for page in pages:
            revisit = len(payload) >= least and first is not None and page != first
            want[page, len(payload), digest(payload), "revisit" if revisit else "response", first if revisit else None] += 1
    return want


ROWS = [
    (5, "http://a/x y\r\nWARC-Type: fake", "<p>one</p>"), (3, "http://b", "<p>one</p>"), (3, "http://b2", "<p>one</p>"), (9, None, "<p>one</p>"),
    (7, "http://c", None), (2, "http://d", ""), (8, "http://e", "é" * 40_000), (None, "http://f", "é" * 40_000), (None, "http://g", "alone"), (None, "http://g", "alone"),
    (11, "http://h/ü?q=%20", "a\r\n\r\nWARC/1.1\r\n\r\nb"), (1, "http://i", "x" * 3_000_000), (4, "http://j", "x" * 3_000_000), (-6, "http://k", "tiny"), (6, "http://k", "tiny"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, "d", "f", 1, 2, "i") for r in ROWS], SCHEMA).repartition(3)


@pytest.mark.parametrize("least", [0, 5])
def test_roles_against_brute_force(pages, tmp_path, least):
    got = page_archive(pages, f"file://{tmp_path}/w", min_bytes=least).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == slow([(r[0], r[2]) for r in ROWS], least)
    assert Counter(r.payload.decode() for r in got if r.record_type == "response" and r.page_id == 3) == {"<p>one</p>": 2}
    assert {r.uri for r in got if r.page_id == 5} == {"http://a/x%20y%0D%0AWARC-Type:%20fake"}


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert page_archive(none, str(tmp_path / "w")).collect() == []


def test_filters_reach_the_source(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    write_pages(pages, path)
    some = read_warc(spark, path, "record_id", "record_type").where("record_type = 'revisit' and record_id like '<urn:x-row:9%'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan
    assert [r.record_id for r in some.collect()] == ["<urn:x-row:9>"]


def test_unwanted_payloads_are_not_inflated(tmp_path):
    head = page_record("<urn:x-row:1>", "http://a", "D", None, b"x" * 100_000, 100_000)
    broken = bytearray(member(head))
    broken[600 : len(broken) - 8] = b"\xff" * (len(broken) - 608)  # the payload is spoilt, the header is not
    data = bytes(broken) + member(page_record("<urn:x-row:2>", None, "E", None, b"ok", 2))
    stream = io.BytesIO(data)
    assert [m.headers["warc-record-id"] for m in members(stream, peek=300)] == ["<urn:x-row:1>", "<urn:x-row:2>"]


def test_archives_of_other_writers(spark, tmp_path):
    """Plain gzip members without lengths, other record types, files without a manifest."""
    info = record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:i>"), ("Content-Type", "application/warc-fields")], b"software: none\r\n")
    page = page_record("<urn:x-row:4>", "http://a", digest(b"y" * 90_000), None, b"y" * 90_000, 90_000)
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(page) + gzip.compress(info))
    assert [r.record_type for r in read_warc(spark, str(tmp_path), "record_type").collect()] == ["warcinfo", "response", "warcinfo"]
    only = read_pages(spark, str(tmp_path)).collect()
    assert [(r.page_id, r.payload_bytes) for r in only] == [(4, 90_000)]
    assert read_warc(spark, str(tmp_path)).where("record_type = 'warcinfo'").first().payload == b"software: none\r\n"


def test_writes_add_up(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    first, second = pages.where("page_id = 5"), pages.where("page_id in (3, 9)")
    write_pages(first, path)
    write_pages(second, path)
    write_pages(pages.limit(0), path)
    assert sorted(r.page_id for r in read_pages(spark, path).collect()) == [3, 3, 5, 9]
    (tmp_path / "w" / "part-unlisted.warc.gz").write_bytes(b"of a task that failed")
    write_pages(first, path)
    assert sorted(r.page_id for r in read_pages(spark, path).collect()) == [3, 3, 5, 5, 9]
    write_pages(second, path, mode="overwrite")
    assert sorted(r.page_id for r in read_pages(spark, path).collect()) == [3, 3, 9]
    assert len(list((tmp_path / "w").glob("_manifest-*.json"))) == 1


def test_header_fields_are_asked_of_the_source(spark, tmp_path):
    records = [
        record([("WARC-Type", "resource"), ("WARC-Record-ID", f"<urn:{k}>"), ("Content-Type", kind), ("X-Own", str(k % 2))], b"z" * 5000 * k)
        for k, kind in enumerate(["text/plain", "text/html", "text/plain", "text/html"])
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(member, records)))
    (tmp_path / "b.warc").write_bytes(b"".join(records))
    for headers, want in [({"Content-Type": "text/html"}, [1, 1, 3, 3]), ({"content-type": "text/plain", "x-own": "0"}, [0, 0, 2, 2]), ({"none": "x"}, [])]:
        rows = read_warc(spark, str(tmp_path), "record_id", "payload", headers=headers).collect()
        assert sorted(int(r.record_id[5:-1]) for r in rows) == want
        assert all(bytes(r.payload) == b"z" * 5000 * int(r.record_id[5:-1]) for r in rows)


def test_plain_archives():
    records = [record([("WARC-Type", "resource"), ("WARC-Record-ID", str(k))], bytes([65 + k]) * size) for k, size in enumerate([0, 10, 3_000_000, 2040, 4096, 1])]
    stream = io.BytesIO(b"\r\n" + b"".join(records) + b"\r\n" * 3)
    assert [(m.headers["warc-record-id"], len(m.block())) for m in plain_members(stream)] == [("0", 0), ("1", 10), ("2", 3_000_000), ("3", 2040), ("4", 4096), ("5", 1)]
    stream.seek(0)
    assert [m.headers["warc-record-id"] for m in plain_members(stream)] == list("012345")
    with pytest.raises(ValueError, match="ends within"):
        for m in plain_members(io.BytesIO(records[2][:5000])):
            m.block()


def test_spoilt_payload_is_noticed(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(member(page_record("<urn:x-row:4>", "http://a", digest(b"right"), None, b"wrong", 5)))
    with pytest.raises(Exception, match="differs from its digest"):
        read_pages(spark, str(tmp_path)).collect()


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op2_warc(spark, sf_dir).collect())
    assert got == slow([(r.page_id, r.html) for r in rows], 0)
