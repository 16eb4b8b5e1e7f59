"""WARC archives: write whole-file gzip streams, normalise them, read them back.

``write_archives`` writes records into files that are one gzip stream each.
``normalise`` inflates such a stream once and rewrites every record as its own
gzip member, with a sidecar index of offsets, so that ``read_records`` can fetch
each record alone. Spark deals out the rows and the files; a task streams one
file at a time. Files go to the shared folder under names of their own for each
task attempt; only files that a finished task reported are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.session import materialize, scratch_path

#: Payloads below this size are never written as revisits.
LEAST_REVISIT = 1000
#: A file is closed once it holds so many payload bytes.
FILE_BYTES = 32 << 20
CHUNK = 1 << 20
LEVEL = 1
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "path string, records long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
_END = b"\r\n\r\n"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit without."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~.-_')}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


def parse_record(raw: bytes) -> tuple:
    """The row of one record; a response's digest is checked against its payload."""
    head, _, rest = raw.partition(_END)
    h = headers(head)
    http, _, payload = rest[: int(h["content-length"])].partition(_END)
    number = lambda name: int(m[1]) if (m := re.match(r"<urn:page:(-?\d+)>", h.get(name, ""))) else None
    digest, revisit = h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"] == "revisit"
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload digest differs in {h['warc-record-id']}")
    size = int(headers(http)["content-length"]) if revisit else len(payload)
    return number("warc-record-id"), h.get("warc-target-uri"), h["warc-type"], number("warc-refers-to"), size, digest, None if revisit else payload


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): of equal payloads of at least ``least`` bytes the largest page_id is the response.

    Only (digest, page_id) is grouped, with map-side maxima; the join back is a
    plain equi-join that Spark may split where one digest is frequent.
    """
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), text.cast("binary").alias("payload")).withColumn("digest", F.sha1("payload"))
    first = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select(F.col("digest").alias("of"), "response")
    )
    revisit = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return rows.join(first, rows.digest == first["of"], "left").select("page_id", "url", "payload", "digest", revisit.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html) as a record; returns the files (path, records).

    Null html is an empty payload; a null url leaves the header out; a null
    page_id is written as an empty id and is a revisit of the largest page_id
    where a payload repeats. Rows that repeat the response's page_id are
    responses as well. Extra columns are ignored; an empty table writes no file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    store, at = _store(path)
                    store.create_dir(at.rpartition("/")[0])
                    out, pack, held, n = store.open_output_stream(at, compression=None), zlib.compressobj(LEVEL, wbits=31), 0, 0
                out.write(pack.compress(record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])))
                held, n = held + len(row["payload"]), n + 1
                if held >= file_bytes:
                    out.write(pack.flush())
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})
        if out is not None:
            out.write(pack.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    return materialize(with_revisits(pages, least).mapInArrow(run, FILES), "warc-files")


def _records(source) -> Iterator[bytes]:
    """Whole records of a gzip file of one or more members, inflated once, front to back."""
    unpack, held, need = zlib.decompressobj(31), bytearray(), None
    data = b""
    while data or (data := source.read(CHUNK)):
        held += unpack.decompress(data, 4 * CHUNK)
        data = unpack.unconsumed_tail or unpack.unused_data
        if unpack.eof:
            unpack = zlib.decompressobj(31)
        while True:
            if need is None:
                end = held.find(_END)
                if end < 0:
                    break
                need = end + 4 + int(headers(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends inside a record")


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite whole-file gzip archives as one member per record with a sidecar index.

    ``files`` has (path, records). Returns (path, records) of the new archives;
    the index of ``x.warc.gz`` is ``x.warc.gz.idx``, a JSON line [offset,
    length] per record in file order. Each file is inflated once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                store, at = _store(name)
                store.create_dir(at.rpartition("/")[0])
                source_store, source_at = _store(path)
                offset = n = 0
                with source_store.open_input_stream(source_at, compression=None) as source, store.open_output_stream(at, compression=None) as out, store.open_output_stream(f"{at}.idx", compression=None) as index:
                    for record in _records(source):
                        pack = zlib.compressobj(LEVEL, wbits=31)
                        member = pack.compress(record) + pack.flush()
                        out.write(member)
                        index.write(json.dumps([offset, len(member)]).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                yield pa.RecordBatch.from_pydict({"path": [name], "records": [n]})

    return materialize(_one_file_a_task(files).mapInArrow(run, FILES), "warc-normal")


def _one_file_a_task(files: DataFrame) -> DataFrame:
    return files.select("path").repartition(max(1, files.count()))


def read_records(files: DataFrame, payloads: bool = True) -> DataFrame:
    """Rows of normalised archives, each record fetched by its indexed offset.

    Responses have the size and digest of the payload read; a revisit has those
    of the payload it stands for. ``payloads=False`` leaves the bytes out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, at = _store(path)
                with store.open_input_stream(f"{at}.idx", compression=None) as index:
                    places = [json.loads(x) for x in index.read().splitlines()]
                with store.open_input_file(at) as archive:
                    rows, held = [], 0
                    for offset, length in places:
                        archive.seek(offset)
                        row = parse_record(zlib.decompress(archive.read(length), 31))
                        rows.append(row if payloads else (*row[:6], None))
                        held += row[4] if payloads else 200
                        if held > 8 * CHUNK:
                            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema)

    return _one_file_a_task(files).mapInArrow(run, RECORDS)


def archive_round_trip(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Write ``pages`` to whole-file archives in the shared folder, normalise them and read them back."""
    folder = scratch_path(pages.sparkSession, f"warc-{uuid.uuid4().hex}")
    written = write_archives(pages, f"{folder}/whole")
    return read_records(normalise(written, f"{folder}/members"), payloads)
