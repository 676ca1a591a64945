"""WARC archives: exact round trips, and the records against a plain loop."""

import base64
import gzip
import hashlib
import io
import json
import random
import zlib
from pathlib import Path
from urllib.parse import urlparse

import duckdb
import pytest

from terrarank.llm import warc as R
from terrarank.llm.queries import ORACLES, archive_pages

SCHEMA = "page_id long, url string, html string, record_type string, archive int"


def frame(spark, rows):
    return spark.createDataFrame([(k, u, h, "clash", 3) for k, u, h in rows], SCHEMA)


def base32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def slow(rows, min_bytes=0):
    largest = {}
    for k, _, h in rows:
        if k is not None:
            largest[h or ""] = max(k, largest.get(h or "", k))
    out = []
    for k, _, h in rows:
        data = (h or "").encode()
        top = largest.get(h or "")
        first = k == top or top is None or len(data) < min_bytes
        out.append((k, len(data), base32(data), "response" if first else "revisit", None if first else top))
    return sorted(out, key=str)


def cases():
    rnd = random.Random(4)
    rows = [(i * 7 % 101, f"http://a.example/{i}", f"<p>{rnd.randrange(30)}</p>" * rnd.choice([1, 5])) for i in range(101)]
    rows += [(1000 + i, "http://hot.example/", "<html>the same page</html>") for i in range(250)]
    rows += [(2000, None, None), (2001, "", ""), (2002, "http://b/ä b\r\nX: y", "é日本\r\n\r\nWARC/1.1\r\n\r\n"), (2003, "u", "x" * 3_000_000),
             (2004, "u", "\r\n\r\n\0\r\n"), (None, "u", "no id"), (None, "u", "<html>the same page</html>"), (7, "again", rows[1][2]), (7, "again", rows[1][2])]
    return rows


def local(uri):
    return Path(urlparse(uri).path)


def whole_members(path):
    """(offset, inflated bytes) of every gzip member of a file."""
    data, at, out = local(path).read_bytes(), 0, []
    while at < len(data):
        z = zlib.decompressobj(31)
        out.append((at, z.decompress(data[at:])))
        at = len(data) - len(z.unused_data)
    return out


@pytest.mark.parametrize("archive_bytes", [1 << 30, 2000])
def test_records_equal_plain_loop(spark, tmp_path, archive_bytes):
    rows = cases()
    manifest = R.write_warc(frame(spark, rows).repartition(3), tmp_path.as_uri() + "/whole", archive_bytes=archive_bytes)
    indexed = R.normalise(manifest, tmp_path.as_uri() + "/members")
    got = R.read_warc(indexed, range_bytes=1000 if archive_bytes == 2000 else R.RANGE_BYTES).collect()
    number = lambda r: None if r in (None, "<urn:page:>") else int(r[len("<urn:page:"):-1])
    have = [(number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in got]
    assert sorted(have, key=str) == slow(rows)
    texts = {(k, h or "") for k, _, h in rows}
    assert all((number(r.record_id), r.payload.decode()) in texts for r in got if r.record_type == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    assert {r.target_uri for r in got if r.record_id == "<urn:page:2002>"} == {"http://b/%C3%A4%20b%0D%0AX:%20y"}


def test_files_are_gzip_streams_and_members(spark, tmp_path):
    rows = cases()
    manifest = R.write_warc(frame(spark, rows).coalesce(2), tmp_path.as_uri() + "/whole")
    whole = [r.archive for r in manifest.collect()]
    assert all(len(whole_members(p)) == 1 for p in whole)  # one stream a file
    for r in R.normalise(manifest, tmp_path.as_uri() + "/members").collect():
        members = whole_members(r.archive)
        entries = [json.loads(line) for line in local(r["index"]).read_text().splitlines()]
        assert [e["offset"] for e in entries] == [at for at, _ in members] and r.records == len(members)
        assert all(record.startswith(b"WARC/1.1\r\n") and record.count(e["id"].encode()) >= 1 for e, (_, record) in zip(entries, members))
    before = sorted(b for p in whole for b in gzip.open(local(p)).read().split(b"WARC/1.1\r\nWARC-Type")[1:])
    after = sorted(b for r in R.normalise(manifest, tmp_path.as_uri() + "/again").collect()
                   for b in gzip.open(local(r.archive)).read().split(b"WARC/1.1\r\nWARC-Type")[1:])
    assert before == after
    index = R.read_index(R.normalise(manifest, tmp_path.as_uri() + "/third"))
    assert index.count() == len(rows) and index.where("type = 'revisit'").count() == sum(r[3] == "revisit" for r in slow(rows))


def test_short_payloads_may_stay_responses(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    manifest = R.write_warc(frame(spark, rows), tmp_path.as_uri() + "/w", min_bytes=5)
    got = R.read_warc(R.normalise(manifest, tmp_path.as_uri() + "/m"), payloads=False).collect()
    assert sorted((r.record_id, r.record_type) for r in got) == [(f"<urn:page:{k}>", "revisit" if k == 3 else "response") for k in (1, 2, 3, 4)]


def test_other_writers_archives(spark, tmp_path):
    """A warcinfo record, folded fields, line feeds alone, and members already separate."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    page = R.page_record(5, "http://x/", b"<html>").replace(b"WARC-Date: ", b"WARC-Date:\r\n ")
    path = tmp_path / "other.warc.gz"
    path.write_bytes(gzip.compress(info) + gzip.compress(page + b"\r\n") + gzip.compress(R.page_record(6, None, b"")))
    archives = spark.createDataFrame([(path.as_uri(),)], "archive string")
    indexed = R.normalise(archives, tmp_path.as_uri() + "/m")
    assert indexed.first().records == 3
    assert sorted((r.record_id, r.payload) for r in R.read_warc(indexed).collect()) == [("<urn:page:5>", b"<html>"), ("<urn:page:6>", b"")]


def test_damage_is_an_error():
    record = R.page_record(1, "u", b"payload")
    cut = io.BytesIO(gzip.compress(record[:-12]))
    with pytest.raises(EOFError):
        R.normalise_stream(cut, io.BytesIO(), io.BytesIO())
    stream = io.BytesIO(gzip.compress(record)[:-20])
    with pytest.raises(EOFError):
        R.normalise_stream(stream, io.BytesIO(), io.BytesIO())
    head, fields = R.read_head(io.BytesIO(record))
    with pytest.raises(ValueError):
        R.parse_record(fields, record[len(head):-4].replace(b"payload", b"PAYLOAD"))


def test_query_equals_its_sql_and_the_loop(spark):
    rows = cases()
    got = archive_pages(frame(spark, rows).repartition(4))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    have = sorted((tuple(r) for r in got.collect()), key=str)
    assert have == slow(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert sorted(con.execute(ORACLES["op11_warc_archives"]).fetchall(), key=str) == have


def test_empty_table(spark):
    assert archive_pages(frame(spark, [])).collect() == []
