"""WARC archives with a shared Zstandard dictionary, written and read by tasks.

Layout of an archive: a skippable frame (type 0x184D2A5D) that holds the dictionary, then one
Zstandard frame per WARC record. The dictionary is trained on about ``SAMPLE`` records, chosen
by a hash of their id, each cut to ``SAMPLE_CHARS``: a bounded, documented sample.

Pages whose payloads are equal and have ``revisit_from`` bytes or more are stored once, at the
largest ``page_id``; the others become revisit records that hold the HTTP header only. Equality
is SHA-1 and length. A task rolls to a new archive at ``archive_bytes``. It writes under a name
of its own and renames at the end, so a lost or repeated attempt leaves no listed archive.

Null html is an empty payload, a null url becomes ``about:blank``. A page without id is written
without one; where no page of a group of copies has an id, all of them are responses. Rows that
repeat the largest id are responses each. Extra columns are ignored. An empty table writes nothing.

The folder is a URI that ``pyarrow.fs`` can open on every worker.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, shared_dir, slices, stored

SAMPLE = 2000
SAMPLE_CHARS = 8192
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 64 << 20
REVISIT_FROM = 1000
SKIPPABLE = 0x184D2A5D
RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def file_system(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def with_types(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Adds payload size, digest, record type and the page a revisit refers to."""
    pages = pick(pages, page_id="page_id", url="url", html="html").withColumn("html", F.coalesce("html", F.lit("")))
    pages = pages.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("payload_digest", F.sha1("html"))
    key = ["payload_digest", "payload_bytes"]
    groups = pages.where(F.col("payload_bytes") >= revisit_from).groupBy(*key).agg(F.max("page_id").alias("held"), F.count("*").alias("n")).where("n > 1 and held is not null")
    revisit = F.col("held").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("held"))
    return (
        pages.join(groups, key, "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("held")))
        .select("page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to")
    )


# --- records -----------------------------------------------------------------------
def record(page_id, url, payload, size, digest, kind, refers_to, date) -> bytes:
    """One WARC record. The HTTP header states the full payload's length in revisits too."""
    url = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in (url or "about:blank"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def header_of(stream: io.BufferedReader) -> dict[str, str] | None:
    """Header fields of the next record, lower-case names; None at the end."""
    line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {}
    while (line := stream.readline().rstrip(b"\r\n")) != b"":
        name, _, value = line.decode().partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def records_of(stream: io.BufferedReader) -> Iterator[tuple]:
    """Parses records; checks each response against its digest."""
    while (head := header_of(stream)) is not None:
        block = stream.read(int(head["content-length"]))
        stream.read(4)
        if head["warc-type"] not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        response = head["warc-type"] == "response"
        if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError("payload does not match its digest")
        number = lambda k: int(head[k]) if k in head else None
        yield number("page-id"), head["warc-target-uri"], size, digest, head["warc-type"], number("refers-to-page-id"), payload if response else None


# --- dictionary --------------------------------------------------------------------
def train(pages: DataFrame, date: str) -> bytes:
    """A dictionary from a bounded sample of the pages to archive; empty for an empty table."""
    import zstandard

    pages = pick(pages, page_id="page_id", url="url", html="html")
    steps = 1 << 20
    keep = min(steps, -(-SAMPLE * steps // max(pages.count(), 1)))
    sample = pages.where(F.pmod(F.xxhash64("page_id"), F.lit(steps)) < keep)
    rows = sample.select("page_id", "url", F.substring(F.coalesce("html", F.lit("")), 1, SAMPLE_CHARS).alias("html")).limit(2 * SAMPLE).collect()
    rows = sorted(rows, key=lambda r: (r.page_id is None, r.page_id, r.html))
    samples = [record(r.page_id, r.url, r.html.encode(), len(r.html), hashlib.sha1(r.html.encode()).hexdigest(), "response", None, date) for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few records to train on: their text itself serves
        return b"".join(samples)[:DICTIONARY_BYTES]


def write_archives(pages: DataFrame, folder: str, revisit_from: int = REVISIT_FROM, archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives and returns their list ``(path, records)``."""
    typed = with_types(pages, revisit_from)
    dictionary = train(pages, date)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        files, root = file_system(folder)
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        out, done, size, count = None, [], 0, 0

        def close():
            nonlocal out
            if out is not None:
                out[0].close()
                files.move(out[1] + ".open", out[1])
                done.append((out[1], count))
                out = None

        for batch in batches:
            for piece in slices(batch, text=2, limit=8 << 20):
                for page_id, url, html, n, digest, kind, refers_to in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    if out is None:
                        files.create_dir(root, recursive=True)
                        path = f"{root}/pages-{uuid.uuid4().hex}.warc.zst"
                        out, size, count = (files.open_output_stream(path + ".open", compression=None), path), 0, 0
                        out[0].write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
                        info = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
                        head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
                        out[0].write(packer.compress(head.encode() + info + b"\r\n\r\n"))
                    packed = packer.compress(record(page_id, url, html.encode(), n, digest, kind, refers_to, date))
                    out[0].write(packed)
                    size, count = size + len(packed), count + 1
                    if size >= archive_bytes:
                        close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([c for _, c in done], pa.int64())], names=["path", "records"])

    return stored(typed.mapInArrow(task, "path string, records long"))


def read_archives(archives: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """Records of listed archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        files, _ = file_system(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with files.open_input_stream(path, compression=None) as raw:
                    magic, length = struct.unpack("<II", raw.read(8))
                    if magic != SKIPPABLE:
                        raise ValueError("no dictionary frame")
                    dictionary = raw.read(length)
                    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
                    stream = io.BufferedReader(unpacker.stream_reader(raw, read_across_frames=True), 1 << 20)
                    rows, held = [], 0
                    for row in records_of(stream):
                        rows.append(row if payload else (*row[:-1], None))
                        held += row[2]
                        if held > 8 << 20:
                            yield rows_to_batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield rows_to_batch(rows)

    shape = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return archives.select("path").repartition("path").mapInArrow(task, shape)


def rows_to_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORD, strict=True)], schema=RECORD)


def round_trip(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Writes all pages to archives in the shared folder and reads their records back."""
    folder = shared_dir(pages.sparkSession)
    return read_archives(write_archives(pages, folder, revisit_from), folder, payload=False)
