"""WARC records in ZIP-packaged archives: written per partition, read by range without extraction.

An archive is a ZIP file of stored members: ``archive/data.warc.gz``, one gzip member per record, and
``indexes/index.cdxj``, a line per record with its place in the data member. The reader finds the central directory
from the end of the file (through the ZIP64 directory where there is one), then the members' data, then reads the
index and each record by its byte range. Files lie in the shared folder, reached by its address, so any executor
reads what another wrote; an attempt that is repeated writes another file, and only files of the stored manifest
count.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from martworks.session import scratch

from .common import bounded, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Shorter payloads are never replaced by a reference.
MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of one archive are read in pieces of about so many bytes of it, a task for each piece.
RANGE_BYTES = 4 << 20


def _file_system(address: str):
    return pa.fs.FileSystem.from_uri(address)


# Writing.

def record_bytes(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC record, uncompressed. A null id or address leaves its header out; an address that does not fit a
    header line is written in JSON."""
    head = [f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}",
            f"WARC-Record-ID: <urn:page:{page_id if page_id is not None else 'none:' + digest}>",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        plain = url == url.strip() and url.isprintable()
        head.append(f"WARC-Target-URI: {url}" if plain else f"WARC-Target-URI-JSON: {json.dumps(url)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archive(stream, records) -> int:
    """Write (page_id, url, payload, digest, kind, refers_to) records to a binary stream; their number."""
    lines = []
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED) as archive:
        with archive.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as data:
            at = 0
            for record in records:
                packed = gzip.compress(record_bytes(*record), 1, mtime=0)
                data.write(packed)
                lines.append(json.dumps({"offset": at, "length": len(packed), "digest": f"sha256:{record[3]}"}))
                at += len(packed)
        with archive.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            for line in lines:
                index.write(f"{line}\n".encode())
    return len(lines)


def with_references(pages: DataFrame) -> DataFrame:
    """Add ``payload_digest``, ``record_type`` and ``refers_to`` to rows of page_id, url and html.

    Of equal payloads of at least MIN_REVISIT bytes the rows of the least page_id are responses, the others revisit
    it (a null page_id, too, unless all of them are null). No page is shuffled while the repeated digests fit a
    broadcast of measured size.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"),
                        F.sha2(html, 256).alias("payload_digest"))
    large = rows.filter(F.octet_length("payload") >= MIN_REVISIT)
    first = (large.groupBy("payload_digest").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
             .filter("_n > 1 and _first is not null").drop("_n"))
    rows = rows.join(bounded(stored(first, "warc-repeated")), "payload_digest", "left")
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return (rows.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(again, F.col("_first"))).drop("_first"))


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write an archive per non-empty partition; the stored manifest: ``path``, ``records``, ``bytes``."""
    folder = folder or scratch(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                columns = [batch.column(c) for c in ("page_id", "url", "payload", "payload_digest", "record_type", "refers_to")]
                for i in range(batch.num_rows):
                    yield tuple(c[i].as_py() for c in columns)
        rows = records()
        head = next(rows, None)
        if head is None:
            return
        system, path = _file_system(folder)
        system.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        with system.open_output_stream(f"{path}/{name}") as stream:
            n = write_archive(stream, _chain(head, rows))
            size = stream.tell()
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [n], "bytes": [size]})

    return stored(with_references(pages).mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def _chain(head, rest):
    yield head
    yield from rest


# Reading.

def _read(file, at: int, length: int) -> bytes:
    file.seek(at)
    data = file.read(length)
    if len(data) != length:
        raise ValueError("the archive ends early")
    return data


def central_directory(file, size: int) -> dict[str, tuple[int, int]]:
    """Name to (place of the data, length) of the stored members of a ZIP file, ZIP64 or not."""
    tail_at = max(0, size - 65_557)
    tail = _read(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    entries, length, start = struct.unpack("<HLL", tail[end + 10:end + 20])
    if 0xFFFF == entries or 0xFFFFFFFF in (length, start):
        if end < 20 or tail[end - 20:end - 16] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        record = _read(file, struct.unpack("<Q", tail[end - 12:end - 4])[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, start = struct.unpack("<QQQ", record[32:56])
    directory, at, members = _read(file, start, length), 0, {}
    for _ in range(entries):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", directory[at + 8:at + 12])
        packed, full, n_name, n_extra, n_note = struct.unpack("<LLHHH", directory[at + 20:at + 34])
        header, = struct.unpack("<L", directory[at + 42:at + 46])
        name = directory[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, n = struct.unpack("<HH", extra[:4])
            if tag == 1:  # the long values, in this order, of the fields that do not hold theirs
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4:4 + n // 8 * 8]))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + n:]
        if method == 0:
            local = _read(file, header, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError(f"no member at the place of {name}")
            members[name] = (header + 30 + sum(struct.unpack("<HH", local[26:30])), packed)
        at += 46 + n_name + n_extra + n_note
    return members


def index_lines(file, place: int, length: int, step: int = 1 << 20) -> Iterator[dict]:
    """The entries of an index member, read piece by piece."""
    rest = b""
    for at in range(0, length, step):
        *lines, rest = (rest + _read(file, place + at, min(step, length - at))).split(b"\n")
        yield from map(json.loads, lines)
    if rest:
        yield json.loads(rest)


def parse_record(data: bytes) -> dict:
    """The columns of a record; the payload of a response is held against its digest."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    length = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    kind, refers_to = fields["WARC-Type"], fields.get("WARC-Refers-To")
    if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (length, digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not the one written")
    url = fields.get("WARC-Target-URI")
    if "WARC-Target-URI-JSON" in fields:
        url = json.loads(fields["WARC-Target-URI-JSON"])
    page_id = fields.get("WARC-Page-ID")
    return {"page_id": None if page_id is None else int(page_id), "url": url, "payload_bytes": length,
            "payload_digest": digest, "record_type": kind,
            "refers_to": int(refers_to[len("<urn:page:"):-1]) if refers_to else None,
            "payload": payload if kind == "response" else None}


def record_places(manifest: DataFrame) -> DataFrame:
    """``path``, ``place`` and ``length`` of every record of the archives, from their directories and indexes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = _file_system(path)
                with system.open_input_file(inner) as file:
                    members = central_directory(file, file.size())
                    start = members[DATA][0]
                    found = [(start + x["offset"], x["length"]) for x in index_lines(file, *members[INDEX])]
                yield pa.RecordBatch.from_pydict({"path": [path] * len(found), "place": [x[0] for x in found],
                                                  "length": [x[1] for x in found]})
    return manifest.select("path").mapInArrow(run, "path string, place long, length long")


def read_records(places: DataFrame, payloads: bool = False, tasks: int | None = None) -> DataFrame:
    """The records at these places; with their payloads if wanted (null for revisits). ``tasks``: how many read them, since
    places are too small to tell."""
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + ", payload binary" * payloads)
    names = [f.split()[0] for f in schema.split(", ")]
    arrow = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
             "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
    target = pa.schema([(n, arrow[n]) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            rows, held = [], 0
            for path, place, length in zip(*[batch.column(c).to_pylist() for c in ("path", "place", "length")]):
                if path != opened:
                    system, inner = _file_system(path)
                    opened, file = path, system.open_input_file(inner)
                row = parse_record(gzip.decompress(_read(file, place, length)))
                rows.append({n: row[n] for n in names})
                held += len(row["payload"] or b"") if payloads else 0
                if held > RANGE_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, target)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, target)

    piece = ("path", F.floor(F.col("place") / RANGE_BYTES))
    pieces = places.repartition(tasks, *piece) if tasks else places.repartition(*piece)
    pieces = pieces.sortWithinPartitions("path", "place")
    return pieces.mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives and read every record back from them.

    A null html is an empty payload; null ids and addresses come back as null; repeated rows are records of their
    own. An empty table writes no archive and gives no rows.
    """
    manifest = write_archives(pages)
    held = manifest.agg(F.sum("bytes")).first()[0] or 0
    return read_records(record_places(manifest), tasks=max(1, min(-(-held // RANGE_BYTES), 1 << 15)))


