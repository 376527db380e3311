"""WARC archives: written with one gzip member per record, read back by byte ranges.

Writing: a payload's SHA-1 is grouped on ids and digests alone, so the html moves once, to meet its
record type. Each task writes its records to files of its own and returns their names and sizes; the
stored list of files, not the folder, says what exists, so a task that ran twice leaves no doubles.

Reading: every file is cut into ranges. A task looks for the gzip magic inside its range, takes a
place for a member when it decodes to a WARC header and its check sum holds, and owns the records
that start inside the range, reading on past its end for the last one.

Defined results: null html is an empty payload; payloads of any length are whole; equal rows with
the largest page_id are all responses; a null page_id comes before all others; url may be null or
hold any character; an empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from .common import new_path, stored

#: Shorter payloads are never revisits.
LEAST_SHARED = 1000
FILE_BYTES = 256 << 20
RANGES_PER_TASK = 2
RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 16

_MAGIC = b"\x1f\x8b\x08"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
RECORD = "offset long, record_type string, headers map<string,string>, payload binary, payload_bytes long, payload_digest string, digest_ok boolean"


def record_types(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """(page_id, url, html, digest, refers_to): of equal long payloads the largest page_id is kept whole."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = pages.select("page_id", F.sha1(payload).alias("digest"), F.length(payload).alias("size")).filter(F.col("size") >= least)
    groups = narrow.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 and refers_to is not null")
    again = narrow.join(groups, ["digest", "size"]).filter("page_id is null or page_id < refers_to")
    again = again.select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "refers_to").distinct()
    kept = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"))
    joined = kept.join(again, kept["page_id"].eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    return joined.select("page_id", "url", "html", "digest", "refers_to")


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}')}>"


def encode_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    target = url if url else f"urn:page:{page_id}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in target),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(refers_to)}",
            f"Refers-To-Page-ID: {refers_to}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n"
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def _write(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out = name = None
        size, made = 0, []
        for batch in batches:
            for row in zip(*[batch.column(k) for k in range(batch.num_columns)]):
                page_id, url, html, digest, refers_to = (x.as_py() for x in row)
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, size = store.open_output_stream(f"{base}/{name}", compression=None), 0
                record = encode_record(page_id, url, (html or "").encode(), digest, refers_to)
                out.write(record)
                size += len(record)
                if size >= file_bytes:
                    out.close()
                    made.append((f"{folder}/{name}", size))
                    out = None
        if out is not None:
            out.close()
            made.append((f"{folder}/{name}", size))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in made], pa.string()), pa.array([s for _, s in made], pa.int64())], names=["path", "size"])

    return run


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the records below ``folder``; returns the stored list of files (path, size)."""
    return stored(record_types(pages).mapInArrow(_write(folder, file_bytes), "path string, size long"), "warc-files")


class _Bytes:
    """Bytes of a file by their place, read ahead in blocks."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size, self.at, self.block = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if not (self.at <= at and at + n <= self.at + len(self.block)):
            self.at = at
            self.block = self.file.read_at(min(max(n, 16 * READ_BYTES), self.size - at), at)
        return self.block[at - self.at : at - self.at + n]


def decode_member(source: _Bytes, at: int) -> tuple[bytes, int] | None:
    """The content and end of a gzip member at ``at`` that begins like a WARC record, or None."""
    decoder, parts, checked, place = zlib.decompressobj(31), [], False, at
    try:
        while not decoder.eof:
            data = source.get(place, READ_BYTES if checked else 512)
            if not data:
                return None
            parts.append(decoder.decompress(data))
            place += len(data)
            if not checked:
                head = b"".join(parts)[:5]
                if head != b"WARC/"[: len(head)]:
                    return None
                checked = len(head) == 5
    except zlib.error:
        return None
    return (b"".join(parts), place - len(decoder.unused_data)) if checked else None


def parse_record(content: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers and payload (the body of the HTTP message) of a record."""
    head, found, rest = content.partition(b"\r\n\r\n")
    if not found:
        return None
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    if not headers.get("Content-Length", "").isdigit() or int(headers["Content-Length"]) > len(rest):
        return None
    block = rest[: int(headers["Content-Length"])]
    if headers.get("Content-Type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return headers, block


def range_records(source: _Bytes, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """The records that start in [start, end), by their offsets."""
    at = start
    while at < end:
        data = source.get(at, READ_BYTES)
        found = data.find(_MAGIC)
        if found < 0:
            if len(data) < 3:
                return
            at += len(data) - 2
            continue
        at += found
        if at >= end:
            return
        member = decode_member(source, at)
        record = parse_record(member[0]) if member else None
        if record is None:
            at += 1
            continue
        yield at, *record
        at = member[1]


def _read(with_payload: bool):
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path, start, end, size in zip(*[batch.column(c).to_pylist() for c in ("path", "start", "end", "size")]):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as file:
                    for offset, headers, payload in range_records(_Bytes(file, size), start, end):
                        kind = headers.get("WARC-Type")
                        said = headers.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                        said = base64.b32decode(said).hex() if len(said) == 32 else None
                        whole = kind != "revisit"
                        digest = hashlib.sha1(payload).hexdigest() if whole else said
                        length = len(payload) if whole else int(headers.get("Payload-Length", 0))
                        rows.append({"path": path, "offset": offset, "record_type": kind, "headers": list(headers.items()), "payload": payload if with_payload and whole else None, "payload_bytes": length, "payload_digest": digest, "digest_ok": digest == said})
                        held += len(payload) if with_payload else 0
                        if held > 32 << 20 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(files: DataFrame, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the files (path, size), read by ranges of ``range_bytes``."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    cut = files.select("path", "size", F.explode(starts).alias("start"))
    cut = cut.withColumn("end", F.least(F.col("start") + range_bytes, F.col("size")))
    # ranges are dealt out evenly, however the list of files was stored, to a number of tasks that grows
    # with them: adaptive execution would join these few bytes into one
    tasks = max(1, -(-cut.count() // RANGES_PER_TASK))
    return cut.repartition(tasks, "path", "start").mapInArrow(_read(with_payload), f"path string, {RECORD}")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder and returns one row per record read back."""
    files = write_archives(pages, new_path(pages.sparkSession, "warc"))
    records = read_archives(files, with_payload=False)
    id_type = pages.schema["page_id"].dataType
    header = lambda name: F.col("headers")[name].cast(id_type)
    return records.select(
        header("Page-ID").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        header("Refers-To-Page-ID").alias("refers_to"),
    )
