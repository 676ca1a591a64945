"""WARC archives: pages written as records, whole-file gzip streams normalised to a member a record, and read by offset.

``write_warc`` makes archives the way many crawlers leave them: one gzip
stream a file, from which no record can be read without inflating all before
it. ``normalise`` inflates each such stream once, a bounded piece at a time,
writes every record as a gzip member of its own, and beside the archive a
sidecar index: a JSON line a record with its offset, length and main fields.
``read_warc`` cuts the indexed archives into ranges of whole members and reads
the ranges independently, so one large archive is read by many tasks; payloads
are checked against their digests.

Of records with equal payloads the one with the largest id is a response and
the others are revisits that refer to it and hold no payload. Payloads are
grouped by hash (a pre-aggregated count and largest id), and groups of very
many rows are broadcast, so that no payload gathers its copies in one task.

Tasks write files under names of their own attempt, and a file counts only if
it is named in the manifest, a table that Spark commits; a lost task's files
are never read. Files go through pyarrow's file systems by the folder's URI.

Cases: a null or empty page has an empty payload, which is a payload like
others; a null address leaves its field out, characters that no address may
hold are percent-encoded; rows that share the largest id and the payload are
all responses (repeated rows stay repeated, under one record id); a null id is
smaller than all others, and where all ids of a payload are null every record
is a response; records of any length are copied piece by piece when
normalised; an empty table gives no records; other columns are not read. An
archive that breaks off, or a payload unlike its digest, raises an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string
from pyspark.taskcontext import TaskContext

from terrarank.llm.common import byte_batches, join_back, materialize, n_tasks, small_batches

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # of records whose time is not known
ID_PREFIX, ID_SUFFIX = "<urn:page:", ">"
ARCHIVE_BYTES = 1 << 30  # inflated, after which the next archive begins
RANGE_BYTES = 32 << 20  # of members that one read takes
STEP = 1 << 20  # bytes copied at once
GZIP = 31  # zlib's window bits for a gzip member
LEVEL = 6

MANIFEST = "archive string, records long"
INDEXED = "archive string, index string, records long"
RECORDS = ("record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, "
           "payload binary")


# ----------------------------------------------------------------- records
def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key) -> str:
    return f"{ID_PREFIX}{'' if key is None else key}{ID_SUFFIX}"


def http_head(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def page_record(key, url: str | None, payload: bytes, refers_to=None, date: str = DATE) -> bytes:
    """A response record, or with ``refers_to`` (an id) a revisit of that page's, which holds the HTTP head alone."""
    revisit = refers_to is not None
    block = http_head(len(payload)) + (b"" if revisit else payload)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(key)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=~")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def read_head(stream) -> tuple[bytes, dict[str, str]] | None:
    """The next record's head as it stands there and its fields by lower-case name; None at the end of the stream."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):  # what closes the record before
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins with {line[:40]!r}")
    head, fields, name = [line], {}, None
    while True:
        line = stream.readline()
        if not line:
            raise EOFError("the archive ends within the head of a record")
        head.append(line)
        if line in (b"\r\n", b"\n"):
            return b"".join(head), fields
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and name:  # a folded line
            fields[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()


def _pieces(stream, size: int) -> Iterator[bytes]:
    while size:
        piece = stream.read(min(size, STEP))
        if not piece:
            raise EOFError("the archive ends within a record")
        size -= len(piece)
        yield piece


def inflated(raw) -> io.BufferedReader:
    """The inflated bytes of a gzip file of one or many members."""
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), STEP)


def normalise_stream(raw, out, index) -> int:
    """Copy the records of a gzip file as members of their own, with a line of the index for each; how many."""
    stream, offset, records = inflated(raw), 0, 0
    while (found := read_head(stream)) is not None:
        head, fields = found
        member, length = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP), 0
        for piece in (head, *_pieces(stream, int(fields["content-length"])), b"\r\n\r\n"):
            length += out.write(member.compress(piece))
        length += out.write(member.flush())
        entry = {"offset": offset, "length": length, "type": fields.get("warc-type"), "id": fields.get("warc-record-id"),
                 "uri": fields.get("warc-target-uri"), "digest": fields.get("warc-payload-digest")}
        index.write(json.dumps(entry).encode() + b"\n")
        offset, records = offset + length, records + 1
    return records


# ----------------------------------------------------------------- files
def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(folder)
    return system, path


def _output(uri: str):
    system, path = _opened(uri)
    return system.open_output_stream(path, compression=None)


def _input(uri: str):
    system, path = _opened(uri)
    return system.open_input_file(path)


def _own_name(folder: str, kind: str, seq: int) -> str:
    context = TaskContext.get()
    return f"{folder}/{kind}-{context.partitionId():05d}-{context.taskAttemptId()}-{seq:04d}.warc.gz"


def _make_folder(folder: str) -> None:
    system, path = _opened(folder)
    system.create_dir(path, recursive=True)


def with_decisions(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """(id, url, payload, response): ``response`` is the id that a revisit refers to, null for responses."""
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    keys = ["key1", "key2"]
    keyed = rows.withColumn("key1", F.xxhash64("payload")).withColumn("key2", F.sha2("payload", 256))
    groups = keyed.groupBy(*keys).agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("times"),
                                      F.max(F.octet_length("payload")).alias("bytes"))
    groups = materialize(groups.where((F.col("times") > 1) & (F.col("bytes") >= min_bytes)).drop("bytes"), "warc-copies")
    n_copies = groups.agg(F.sum("times")).first()[0] or 0
    found = join_back(keyed, groups, keys, "times", n_copies, how="left")
    response = F.when(~F.col("id").eqNullSafe(F.col("largest")), F.col("largest"))
    return found.select("id", "url", "payload", response.alias("response"))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = 0, date: str = DATE, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record a page into archives of one gzip stream each; the written manifest (archive, records).

    Payloads of fewer than ``min_bytes`` bytes are always responses.
    """
    _make_folder(folder)
    arrow = to_arrow_schema(_parse_datatype_string(MANIFEST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held, records, out, member, name = 0, 0, 0, None, None, None

        def close() -> pa.RecordBatch:
            out.write(member.flush())
            out.close()
            return pa.RecordBatch.from_pylist([{"archive": name, "records": records}], schema=arrow)

        for batch in byte_batches(batches, "payload", 8 << 20):
            for key, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = _own_name(folder, "whole", seq)
                    out, member = _output(name), zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                    held, records, seq = 0, 0, seq + 1
                record = page_record(key, url, payload, refers_to, date)
                out.write(member.compress(record))
                held, records = held + len(record), records + 1
                if held >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    with small_batches(pages.sparkSession, 1000):
        return materialize(with_decisions(pages, id_col, url_col, html_col, min_bytes).mapInArrow(run, MANIFEST), "warc-manifest")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite the files of the column ``archive``, one gzip stream or many members each, as a member a record.

    The written manifest (archive, index, records) of the new files.
    """
    _make_folder(folder)
    arrow = to_arrow_schema(_parse_datatype_string(INDEXED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = 0
        for batch in batches:
            for source in batch.column(0).to_pylist():
                name = _own_name(folder, "members", seq)
                seq += 1
                with _input(source) as raw, _output(name) as out, _output(name + ".index.jsonl") as index:
                    records = normalise_stream(raw, out, index)
                row = {"archive": name, "index": name + ".index.jsonl", "records": records}
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    files = archives.select("archive").repartition(n_tasks(archives))
    return materialize(files.mapInArrow(run, INDEXED), "warc-members")


def read_index(indexed: DataFrame) -> DataFrame:
    """(archive, offset, length, type, id, uri, digest): the lines of the sidecar indexes."""
    fields = "archive string, offset long, length long, type string, id string, uri string, digest string"
    arrow = to_arrow_schema(_parse_datatype_string(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, index in zip(*(c.to_pylist() for c in batch.columns)):
                with _input(index) as raw:
                    rows = []
                    for line in io.BufferedReader(raw, STEP):
                        rows.append(json.loads(line) | {"archive": archive})
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return indexed.select("archive", "index").mapInArrow(run, fields)


def _ranges(indexed: DataFrame, range_bytes: int) -> DataFrame:
    """(archive, start, length): the archives in ranges of whole members, from their indexes."""
    schema = "archive string, start long, length long"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, index in zip(*(c.to_pylist() for c in batch.columns)):
                rows, start, end = [], 0, 0
                with _input(index) as raw:
                    for line in io.BufferedReader(raw, STEP):
                        end += json.loads(line)["length"]
                        if end - start >= range_bytes:
                            rows.append({"archive": archive, "start": start, "length": end - start})
                            start = end
                if end > start:
                    rows.append({"archive": archive, "start": start, "length": end - start})
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return indexed.select("archive", "index").mapInArrow(run, schema)


def parse_record(fields: dict[str, str], block: bytes) -> dict:
    """A page's record as a row; a revisit's payload length is that of its HTTP head."""
    end = block.find(b"\r\n\r\n")
    head, payload = block[:end], block[end + 4:]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    size = len(payload)
    if fields["warc-type"] == "revisit":
        named = [v for n, _, v in (line.partition(b":") for line in head.split(b"\r\n")) if n.strip().lower() == b"content-length"]
        size, payload = int(named[0]), None
    elif digest_of(payload) != digest:
        raise ValueError(f"the payload of {fields.get('warc-record-id')} is unlike its digest")
    return {"record_id": fields.get("warc-record-id"), "record_type": fields["warc-type"], "target_uri": fields.get("warc-target-uri"),
            "refers_to": fields.get("warc-refers-to"), "payload_bytes": size, "payload_digest": digest, "payload": payload}


def read_warc(indexed: DataFrame, payloads: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The response and revisit records of normalised archives, by way of their indexes; payloads are null for revisits."""
    schema: StructType = _parse_datatype_string(RECORDS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                with _input(archive) as raw:
                    raw.seek(start)
                    stream, rows, held = inflated(io.BytesIO(raw.read(length))), [], 0
                while (found := read_head(stream)) is not None:
                    block = b"".join(_pieces(stream, int(found[1]["content-length"])))
                    if found[1].get("warc-type") not in ("response", "revisit"):
                        continue
                    row = parse_record(found[1], block)
                    held += len(block)
                    rows.append(row if payloads else row | {"payload": None})
                    if held >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    ranges = _ranges(indexed, range_bytes).repartition(n_tasks(indexed))
    out = ranges.mapInArrow(run, schema)
    return out if payloads else out.drop("payload")
