import base64
import gzip
import hashlib

import pytest

from accrue.llm.warc import deduplicate_archives, read_archives, resolve_revisits, write_archives

TRAP = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n"
PAGES = [
    (5, "http://a", "<p>x</p>"), (3, "http://b", "<p>x</p>"), (9, "http://c", "<p>x</p>"),
    (1, "http://d", None), (2, None, ""), (4, "http://e\r\nX: 1", TRAP), (6, "http://f", TRAP), (7, "http://g", "é　\U0001f600" * 3000),
    (8, "http://h", "\n"), (None, "http://i", "<p>x</p>"), (None, "http://j", "alone"), (10, "http://k", "twice"), (10, "http://k", "twice"), (11, "http://l", "twice"),
]


def expected(pages, least):
    first = {}
    for page, _, html in pages:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in pages:
        raw = (html or "").encode()
        known = first.get(html or "")
        revisit = len(raw) >= least and known is not None and known != page
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", known if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 2, 100])
def test_archives_of_odd_pages(spark, tmp_path, least):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    write_archives(pages, f"{tmp_path}/a", file_bytes=3000)
    raw = read_archives(spark, f"{tmp_path}/a", with_payload=True).collect()
    assert sorted((r.page_id, r.payload.decode()) for r in raw if r.page_id) == sorted((p, h or "") for p, _, h in PAGES if p)
    deduplicate_archives(spark, f"{tmp_path}/a", f"{tmp_path}/b", least_bytes=least)
    kept = read_archives(spark, f"{tmp_path}/b")
    assert sorted(map(tuple, resolve_revisits(kept).collect()), key=repr) == expected(PAGES, least)
    rows = {r.record_id: r for r in kept.collect()}
    assert not {r.record_id for r in raw} & {*rows}  # fresh headers
    for r in rows.values():
        if r.type == "revisit":
            assert rows[r.refers_record].type == "response" and rows[r.refers_record].digest == r.digest
    text = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "b").glob("*.gz"))
    assert text.count(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n") == sum(r.type == "revisit" for r in kept.collect())


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    write_archives(pages, f"{tmp_path}/a")
    deduplicate_archives(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert resolve_revisits(read_archives(spark, f"{tmp_path}/b")).count() == 0


def test_damage_is_found(spark, tmp_path):
    write_archives(spark.createDataFrame([(1, "u", "payload")], "page_id long, url string, html string"), f"{tmp_path}/a")
    file = next((tmp_path / "a").glob("*.gz"))
    file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"payload\r", b"PAYLOAD\r")))
    (tmp_path / "a" / f".{file.name}.crc").unlink()
    with pytest.raises(Exception, match="is damaged"):
        read_archives(spark, f"{tmp_path}/a").collect()


def record(kind, block, **fields):
    head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.0\r\nwarc-type: {kind}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    page = b"HTTP/1.1 200 OK\r\ncontent-length: 99\r\n\r\n<p>page</p>"
    records = [
        record("warcinfo", b"software: x\r\n\r\nmore", WARC_Record_ID="<urn:uuid:0>"),
        record("request", b"GET / HTTP/1.1\r\n\r\n", WARC_Record_ID="<urn:uuid:1>"),
        record("response", page, WARC_Record_ID="<urn:uuid:2>", WARC_Target_URI="http://a", WARC_Payload_Digest="md5:x"),
        record("response", b"\r\n\r\nplain", WARC_Record_ID="<urn:uuid:3>", WARC_Target_URI="dns:a"),
        record("revisit", b"", WARC_Record_ID="<urn:uuid:4>", WARC_Refers_To="<urn:uuid:2>"),
    ]
    (tmp_path / "members.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    got = {r.record_id: r for r in read_archives(spark, str(tmp_path), with_payload=True).collect()}
    assert {k: (r.type, r.payload, r.payload_bytes) for k, r in got.items()} == {
        "urn:uuid:2": ("response", b"<p>page</p>", 11), "urn:uuid:3": ("response", b"\r\n\r\nplain", 9), "urn:uuid:4": ("revisit", b"", 0),
    }
    assert got["urn:uuid:2"].digest == base64.b32encode(hashlib.sha1(b"<p>page</p>").digest()).decode()
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(records[2][:-20]))
    with pytest.raises(Exception, match="another length"):
        read_archives(spark, str(tmp_path)).collect()
