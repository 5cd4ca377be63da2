"""Round trips, revisits and broken archives."""

from __future__ import annotations

import base64
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from feedkit.llm import warc
from feedkit.llm.queries import ORACLES, QUERIES

LONG = "<p>payload</p>" * 20


def records(*blocks):
    out = b""
    for i, block in enumerate(blocks):
        head = f"HTTP/1.1 200 OK\r\nContent-Length: {len(block)}\r\n\r\n".encode()
        digest = "sha256:" + hashlib.sha256(block).hexdigest()
        headers = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{i}>", "WARC-Payload-Digest": digest}
        out += warc.encode_record(headers, head + block)
    return out


def test_reader_takes_members_one_by_one():
    data = records(b"one", b"", b"x" * 700_000, b"\r\n\r\n\r\n")
    found = list(warc.read_records(io.BytesIO(data)))
    assert [warc.http_payload(r)[2] for r in found] == [b"one", b"", b"x" * 700_000, b"\r\n\r\n\r\n"]
    for r in found:
        zlib.decompressobj(31).decompress(data[r.offset :])


@pytest.mark.parametrize("cut", [5, 60, 200])
def test_a_cut_archive_is_an_error(cut):
    data = records(b"abc" * 100)
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(data[:cut])))


def test_a_changed_block_is_an_error():
    plain = zlib.decompress(records(b"abc"), 31)
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(zlib.compress(plain.replace(b"abc", b"abd"), wbits=31))))
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(zlib.compress(plain + b"x", wbits=31))))


def test_revisits(spark):
    rows = [(3, "u3", LONG), (1, "u1", LONG), (1, "again", LONG), (None, None, LONG), (5, "a\nb", "short"), (6, "", "short"), (7, "e", None), (8, "f", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    read = warc.read_warc(warc.write_warc(warc.mark_revisits(pages)), with_payload=True).collect()
    got = sorted(((r["id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in read), key=str)
    n = len(LONG)
    want = [(3, "revisit", 1, n), (1, "response", None, n), (1, "response", None, n), (None, "revisit", 1, n)]
    want += [(5, "response", None, 5), (6, "response", None, 5), (7, "response", None, 0), (8, "response", None, 0)]
    assert got == sorted(want, key=str)
    assert {r["payload_digest"] for r in read if r["payload_bytes"] == n} == {hashlib.sha256(LONG.encode()).hexdigest()}
    assert {r["id"]: r["payload"] for r in read}[5] == b"short"
    assert {r["url"] for r in read if r["id"] == 5} == {"a%0Ab"}
    assert warc.read_warc(warc.write_warc(warc.mark_revisits(pages.limit(0)))).count() == 0


def test_several_archives_per_task(spark, monkeypatch):
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit(LONG), "id").alias("html"))
    assert warc.read_warc(warc.write_warc(warc.mark_revisits(pages))).select("id").distinct().count() == 200


def test_query_against_sql(spark, duck, sf_dir):
    rows = QUERIES["op9_warc"](spark, sf_dir)
    got = rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == sorted(duck.execute(ORACLES["op9_warc"]).fetchall())


def plain_record(kind, block, *lines, version="WARC/1.0"):
    """A record as another writer may have put it."""
    head = [version, f"WARC-Type:{kind}", *lines, f"content-length:{len(block)}"]
    return zlib.compress("\r\n".join(head).encode("latin-1") + b"\r\n\r\n" + block + b"\r\n\r\n", wbits=31)


def http(payload, *lines):
    return "\r\n".join(["HTTP/1.0 200 OK", *lines]).encode() + b"\r\n\r\n" + payload


def base32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def foreign():
    """(record, expected record_id, type, size, digest checked) of records in the forms that writers use."""
    page, uri = b"<p>page</p>", "WARC-Target-URI: http://a.example/"
    block = http(page, "Content-Type: text/html")
    uuid_ = "urn:uuid:0aa15a5c-77a5-4f2c-9b0a-0c9d1f0a2b3c"
    digests = [f"sha1:{base32(page)}", f"SHA1:{base32(page).lower()}", f"sha1:{hashlib.sha1(page).hexdigest()}"]
    digests += [f"md5:{hashlib.md5(page).hexdigest()}", f"sha-256:{hashlib.sha256(page).hexdigest().upper()}"]
    out = [
        (plain_record("response", block, f"WARC-Record-ID: <{uuid_}>", uri, f"WARC-Payload-Digest: {d}"), uuid_, "response", 11, True)
        for d in digests
    ]
    own = f"WARC-Block-Digest: sha1:{base32(block)}"
    out += [
        (plain_record("response", block, "warc-record-id:<http://x.example/1>", own), "http://x.example/1", "response", 11, None),
        (plain_record("response", block, "WARC-Record-ID: <urn:page:x>", "WARC-Payload-Digest: blake3:ab"), "urn:page:x", "response", 11, False),
        (plain_record("response", b"a dns answer", "WARC-Record-ID: <dns:a>", "Content-Type: text/dns"), "dns:a", "response", 12, None),
        (plain_record("response", http(b"cut", "Content-Length: 900"), "WARC-Truncated: length"), None, "response", 3, None),
        (plain_record("revisit", http(b"", "Content-Length: 11"), "WARC-Refers-To:", f"\t<{uuid_}>", f"WARC-Payload-Digest: {digests[0]}"), None, "revisit", 11, None),
        (plain_record("revisit", b""), None, "revisit", None, None),
    ]
    skipped = plain_record("request", b"GET / HTTP/1.0\r\n\r\n") + plain_record("warcinfo", b"\xff", "X: \xff")
    return out, skipped


def test_archives_of_other_writers(spark, tmp_path):
    cases, skipped = foreign()
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.warc.gz").write_bytes(skipped + b"".join(c[0] for c in cases))
    (tmp_path / "deep" / "b.warc.gz").write_bytes(cases[0][0])
    (tmp_path / "deep" / "note.txt").write_bytes(b"no archive")
    manifest = warc.archives(spark, str(tmp_path))
    rows = warc.read_warc(manifest, with_payload=True).orderBy("path", "offset").collect()
    assert [r["path"].rsplit("/", 1)[1] for r in rows] == ["a.warc.gz"] * len(cases) + ["b.warc.gz"]
    got = [(r["record_id"], r["record_type"], r["payload_bytes"], r["digest_checked"]) for r in rows[:-1]]
    assert got == [c[1:] for c in cases]
    assert all(r["id"] is None and r["refers_to"] is None for r in rows)
    assert {r["payload_digest"] for r in rows[:7]} == {hashlib.sha256(b"<p>page</p>").hexdigest()}
    assert rows[9]["refers_to_id"] == cases[0][1] and rows[9]["stated_digest"].startswith("sha1:") and rows[9]["payload"] is None
    assert rows[0]["url"] == "http://a.example/" and rows[7]["payload"] == b"a dns answer"
    assert warc.read_warc(warc.archives(spark, str(tmp_path), "*.none")).count() == 0


@pytest.mark.parametrize(
    "line",
    ["WARC-Payload-Digest: sha1:" + "A" * 32, "WARC-Block-Digest: md5:" + "0" * 32, "WARC-Payload-Digest: sha1:???", "WARC-Payload-Digest: sha256:ab"],
)
def test_a_digest_that_does_not_fit_is_an_error(line):
    with pytest.raises(warc.WarcError):
        [warc.http_payload(r) for r in warc.read_records(io.BytesIO(plain_record("response", http(b"page"), line)))]


def test_a_record_without_length_is_an_error():
    data = zlib.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nx\r\n\r\n", wbits=31)
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(data)))
