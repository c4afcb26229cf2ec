"""WARC archives as a table of chunks.

A record is rows (record, chunk): chunk 0 holds the WARC header, the following ones slices of the
record block of at most CHUNK bytes. A payload is streamed: the digest of all slices so far is
carried from chunk to chunk and stored with each, so a reader sees a damaged or missing slice at
once, and neither side joins the slices of a record together.

Of records with equal payloads, the one with the largest page_id is a response, the others are
revisits that refer to it and hold the HTTP header only. Payloads under a least size are always
responses. Reading works through each stored file in order. Records that a file split cuts apart
are gathered in a second, small step.

Nulls: a null html is an empty payload, a null url an empty target; a null page_id sorts below all
others. Rows that repeat the largest page_id with the same payload are all responses; other
repeated rows are revisits each. Other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.llm.common import NO_ID, arrow_schema, id_of
from dropwatch.session import staged

CHUNK = 1 << 18
BATCH_BYTES = 4 << 20
HOLD = 4 << 20  # bytes of a record still open that a reader of a file split keeps
WRITTEN = "2024-01-01T00:00:00Z"  # a parameter of the archive, so that writing is repeatable
ARCHIVE = "record string, chunk int, last boolean, data binary, running string"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def decide(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, sha1 (hex) and size of each row's payload, response: the page it refers to or is."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(id_of("page_id").alias("pid"), F.sha1(html).alias("sha1"), F.octet_length(html).cast("long").alias("size"))
    leaders = rows.groupBy("sha1", "size").agg(F.max("pid").alias("response"))
    shared = leaders.where(F.col("size") >= least_bytes)
    return (
        rows.distinct()
        .join(shared, ["sha1", "size"], "left")
        .withColumn("response", F.coalesce("response", "pid"))
    )


END = b"\r\n\r\n"  # behind the block of every record


def _head(kind: str, record: str, url: str, sha1: str, http: int, length: int, page: int, refers: int) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{record}>",
        f"WARC-Date: {WRITTEN}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(bytes.fromhex(sha1))}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {http + (length if kind == 'response' else 0)}",
        f"X-Page-ID: {page}",
    ]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"X-Refers-To-Page-ID: {refers}",
        ]
    return "\r\n".join([*lines, "", ""]).encode()


def _chunks(record: str, kind: str, url: str, payload: memoryview, sha1: str, page: int, refers: int, chunk: int):
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = payload if kind == "response" else payload[:0]
    carried = hashlib.sha1()
    yield record, 0, False, _head(kind, record, url, sha1, len(http), len(payload), page, refers), None
    yield record, 1, False, http, carried.hexdigest()
    k = 1
    for k, at in enumerate(range(0, len(body), chunk), 2):
        part = body[at : at + chunk]
        carried.update(part)
        yield record, k, False, part, carried.hexdigest()
    yield record, k + 1, True, END, carried.hexdigest()


def write_archive(pages: DataFrame, least_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of all rows of pages (page_id, url, html), written to the shared folder."""
    decided = decide(pages, least_bytes).select("pid", F.col("sha1"), "response")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(id_of("page_id").alias("pid"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    rows = rows.withColumn("sha1", F.sha1("html")).join(decided, ["pid", "sha1"])
    kinds = arrow_schema(ARCHIVE)

    def write(batches):
        task, count, out, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=kinds)

        for batch in batches:
            for pid, sha1, url, html, response in zip(*batch.columns, strict=True):
                pid, refers = pid.as_py(), response.as_py()
                kind = "response" if pid == refers else "revisit"
                seed = hashlib.blake2b(f"{task}:{count}:{pid}".encode(), digest_size=16).hexdigest()
                record = f"{seed[:8]}-{seed[8:12]}-{seed[12:16]}-{seed[16:20]}-{seed[20:]}"
                count += 1
                body = memoryview(html.as_buffer())
                for row in _chunks(record, kind, url.as_py(), body, sha1.as_py(), pid, refers, chunk):
                    out.append(row)
                    size += len(row[3])
                    if size >= BATCH_BYTES:
                        yield flush()
                        size = 0
        if out:
            yield flush()

    written = rows.select("pid", "sha1", "url", "html", "response").mapInArrow(write, ARCHIVE)
    return staged(written, "warc-archive")


class RecordReader:
    """Takes the chunks of records in order; holds a header and a digest, never a payload."""

    def __init__(self):
        self.record = None

    def start(self, record: str, head: bytes) -> None:
        text = head.decode()
        if not text.startswith("WARC/1.1\r\n") or not text.endswith("\r\n\r\n"):
            raise ValueError(f"record {record}: no WARC header")
        self.fields = dict(line.split(": ", 1) for line in text.split("\r\n")[1:] if ": " in line)
        self.record, self.chunk, self.payload, self.block = record, 0, 0, 0
        self.digest = hashlib.sha1()

    def follows(self, record: str, chunk: int) -> bool:
        return self.record == record and chunk == self.chunk + 1

    def add(self, chunk: int, data: memoryview, running: str, last: bool) -> None:
        self.chunk = chunk
        if last and data != END:
            raise ValueError(f"record {self.record}: damaged, no end behind its block")
        self.block += 0 if last else len(data)
        if chunk == 1:
            self.http = bytes(data)
        elif not last:
            self.digest.update(data)
            self.payload += len(data)
        if self.digest.hexdigest() != running:
            raise ValueError(f"record {self.record}: damaged at chunk {chunk}")

    def end(self) -> tuple:
        """A row of RESULT from what was read."""
        f, kind, record = self.fields, self.fields["WARC-Type"], self.record
        self.record = None
        declared = f["WARC-Payload-Digest"].removeprefix("sha1:")
        if self.block != int(f["Content-Length"]):
            raise ValueError(f"record {record}: its block has a wrong length")
        lengths = [x for x in self.http.decode().split("\r\n") if x.startswith("Content-Length: ")]
        size = int(lengths[0].split(": ")[1])
        if kind == "response" and (size != self.payload or declared != base32_sha1(self.digest.digest())):
            raise ValueError(f"record {record}: its payload is not what its header says")
        page = int(f["X-Page-ID"])
        refers = int(f["X-Refers-To-Page-ID"]) if kind == "revisit" else None
        return None if page == NO_ID else page, size, declared, kind, None if refers == NO_ID else refers


def _reader(final: bool):
    """Whole records become result rows. In a file split (not final), the chunks of a record that
    began or goes on elsewhere, or that is larger than HOLD, are passed on; if final, every record
    is complete and its chunks are in order, and nothing is held at all."""

    def read(batches):
        kinds = arrow_schema(f"{ARCHIVE}, {RESULT}")
        reader, held, held_bytes, out = RecordReader(), [], 0, []

        def flush():
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=kinds)

        for batch in batches:
            for record, chunk, last, data, running in zip(*batch.columns, strict=True):
                record, chunk, last, running = record.as_py(), chunk.as_py(), last.as_py(), running.as_py()
                body = memoryview(data.as_buffer())
                known = chunk == 0 or reader.follows(record, chunk)
                if final and not known:
                    raise ValueError(f"chunks are missing before {chunk} of record {record}")
                row = (record, chunk, last, body, running, *[None] * 5)
                if chunk == 0:
                    out += held
                    held, held_bytes = [], 0
                    reader.start(record, bytes(body))
                elif known:
                    reader.add(chunk, body, running, last)
                if not known:
                    out.append(row)
                elif last:
                    out.append((*[None] * 5, *reader.end()))
                    held, held_bytes = [], 0
                elif not final:
                    held.append(row)
                    held_bytes += len(body)
                    if held_bytes > HOLD:
                        out += held
                        held, held_bytes, reader.record = [], 0, None
                if len(out) >= 2000:
                    yield flush()
            if out:
                yield flush()
        if final and reader.record is not None:
            raise ValueError(f"the end of record {reader.record} is missing")
        out += held
        if out:
            yield flush()

    return read


def read_archive(archive: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record."""
    schema = f"{ARCHIVE}, {RESULT}"
    read = staged(archive.mapInArrow(_reader(final=False), schema), "warc-read")
    names = [x.split()[0] for x in RESULT.split(", ")]
    cut = read.where(F.col("record").isNotNull()).select(*(x.split()[0] for x in ARCHIVE.split(", ")))
    whole = cut.repartition("record").sortWithinPartitions("record", "chunk")
    gathered = whole.mapInArrow(_reader(final=True), schema).select(*names)
    return read.where(F.col("record").isNull()).select(*names).unionByName(gathered)
