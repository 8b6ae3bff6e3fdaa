"""WARC archives: written as one gzip stream each, normalised to a member per record, read back.

The normaliser inflates a whole-file stream once, front to back, and writes every record as a gzip
member of its own, with a sidecar index (one JSON line per record: offset, length, type) that makes
any record readable by itself. While it rewrites, it turns records whose payload another record has
into revisits. Which these are is decided on the digests alone, so no payload is ever shuffled: per
digest the first record (smallest page_id, then place) is the response, and each archive's revisits
go to the task that rewrites it.

Archives hold about ``ARCHIVE_BYTES`` of payload. File names are new in every task attempt, and only
the names that a finished task reports are used, so an attempt that was lost or doubled leaves an
unused file at most. Files go to the shared folder by its URI, through Arrow's file systems.

Cases: a null html is an empty payload; a null page_id sorts last and stays null; rows that repeat are
records of their own, all but the first revisits; any bytes of a url that a header can't hold are
percent-encoded; an empty table writes no archive and gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import urllib.parse
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigate.scratch import new_path

ARCHIVE_BYTES = 32 << 20
READ_BYTES = 1 << 20
GZIP = 31  # zlib's window bits for a gzip wrapper
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"  # pages carry no time of capture
# Fixed values of the WARC 1.1 standard.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

Headers = list[tuple[str, str]]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(archive: str, place: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive.rpartition('/')[2]}#{place}')}>"


def record(headers: Headers, block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers)]
    length = b"Content-Length: " + str(len(block)).encode()
    return b"\r\n".join([*lines, length, b"", block, b"", b""])


def response(archive: str, place: int, page_id: int | None, url: str | None, payload: bytes) -> bytes:
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id(archive, place)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", urllib.parse.quote(url or "about:blank", safe=":/?#[]@!$&'()*+,;=%~")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    return record(headers, http + payload)


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    return head + b"\r\n\r\n", payload


def revisit(headers: Headers, block: bytes, refers_to: str, page: int | None) -> bytes:
    """The record without its payload, pointing to the one that has it."""
    http, payload = http_parts(block)
    kept = [h for h in headers if h[0] not in ("WARC-Type", "Content-Length")]
    more = [
        ("WARC-Profile", PROFILE),
        ("WARC-Refers-To", refers_to),
        ("X-Refers-To-Page-ID", "" if page is None else str(page)),
        ("X-Payload-Length", str(len(payload))),
    ]
    return record([("WARC-Type", "revisit"), *kept, *more], http)


def inflated(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, in pieces of bounded size."""
    member = zlib.decompressobj(GZIP)
    for chunk in chunks:
        while chunk:
            if member.eof:
                member = zlib.decompressobj(GZIP)
            yield member.decompress(chunk, READ_BYTES)
            chunk = member.unused_data if member.eof else member.unconsumed_tail
    yield member.flush()


def records(pieces: Iterable[bytes]) -> Iterator[tuple[Headers, bytes]]:
    """Headers and block of every record of an inflated stream; holds one record at a time."""
    source, held = iter(pieces), bytearray()

    def more() -> bool:
        for piece in source:
            if piece:
                held.extend(piece)
                return True
        return False

    while True:
        while (stop := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("archive ends inside a record's headers")
                return
        lines = bytes(held[:stop]).decode().split("\r\n")
        headers = [tuple(line.split(": ", 1)) for line in lines[1:]]
        length = int(dict(headers)["Content-Length"])
        while len(held) < stop + 4 + length + 4:
            if not more():
                raise ValueError("archive ends inside a record")
        block = bytes(held[stop + 4 : stop + 4 + length])
        del held[: stop + 4 + length + 4]
        yield headers, block


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _chunks(path: str) -> Iterator[bytes]:
    system, name = _open(path)
    with system.open_input_stream(name, compression=None) as stream:
        while chunk := stream.read(READ_BYTES):
            yield chunk


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page as a record; ``archive, place, page_id, payload_bytes, payload_digest``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        out = pack = path = None
        held = 0

        def finished() -> pa.RecordBatch:
            out.write(pack.flush())
            out.close()
            columns = [list(c) for c in zip(*rows, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _MANIFEST, strict=True)],
                schema=_MANIFEST,
            )

        for batch in batches:
            for page_id, url, html in zip(
                *(batch.column(n) for n in ("page_id", "url", "html")), strict=True
            ):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    system, name = _open(path)
                    system.create_dir(name.rpartition("/")[0], recursive=True)
                    out, held = system.open_output_stream(name, compression=None), 0
                    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                payload = (html.as_py() or "").encode("utf-8", "replace")
                number = page_id.as_py()
                out.write(pack.compress(response(path, len(rows), number, url.as_py(), payload)))
                rows.append((path, len(rows), number, len(payload), digest(payload)))
                held += len(payload)
                if held >= archive_bytes:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(write, MANIFEST)


MANIFEST = (
    "archive string, place bigint, page_id bigint, payload_bytes bigint, payload_digest string"
)
_MANIFEST = pa.schema(
    [
        ("archive", pa.string()),
        ("place", pa.int64()),
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)


def revisits(manifest: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``archive`` and its records to turn into revisits, each with the response it refers to."""
    first = (
        manifest.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(
            F.min(F.struct(F.isnull("page_id").alias("last"), "page_id", "archive", "place")).alias(
                "first"
            )
        )
    )
    return (
        manifest.filter(F.col("payload_bytes") >= least_bytes)
        .join(first, "payload_digest")
        .filter((F.col("archive") != F.col("first.archive")) | (F.col("place") != F.col("first.place")))
        .groupBy("archive")
        .agg(
            F.collect_list(
                F.struct(
                    "place",
                    F.col("first.page_id").alias("page"),
                    F.col("first.archive").alias("of"),
                    F.col("first.place").alias("at"),
                )
            ).alias("revisits")
        )
    )


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each ``archive`` (with its ``revisits``); the new archives' names.

    A sidecar ``<archive>.cdxj`` next to each tells offset and length of every record's member.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, listed in zip(
                batch.column("archive").to_pylist(), batch.column("revisits").to_pylist(), strict=True
            ):
                again = {r["place"]: r for r in listed or ()}
                path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                system, name = _open(path)
                system.create_dir(name.rpartition("/")[0], recursive=True)
                offset = 0
                with (
                    system.open_output_stream(name, compression=None) as out,
                    system.open_output_stream(f"{name}.cdxj") as index,
                ):
                    for place, (headers, block) in enumerate(records(inflated(_chunks(source)))):
                        kind = "response"
                        plain = [h for h in headers if h[0] != "Content-Length"]
                        whole = record(plain, block)
                        if place in again:
                            r, kind = again[place], "revisit"
                            whole = revisit(plain, block, record_id(r["of"], r["at"]), r["page"])
                        pack = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                        member = pack.compress(whole) + pack.flush()
                        out.write(member)
                        line = {"offset": offset, "length": len(member), "type": kind}
                        index.write(json.dumps(line).encode() + b"\n")
                        offset += len(member)
                yield pa.RecordBatch.from_arrays([pa.array([path])], names=["archive"])

    return archives.select("archive", "revisits").mapInArrow(rewrite, "archive string")


def read_records(archives: DataFrame) -> DataFrame:
    """Every record of normalised archives, found by its sidecar and read by itself."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                system, name = _open(path)
                rows = []
                with (
                    system.open_input_file(name) as archive,
                    system.open_input_stream(f"{name}.cdxj") as index,
                ):
                    for line in index.read().splitlines():
                        entry = json.loads(line)
                        archive.seek(entry["offset"])
                        rows.append(_described(archive.read(entry["length"])))
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)

    return archives.select("archive").mapInArrow(read, RECORDS)


def _described(member: bytes) -> dict:
    ((headers, block),) = records([zlib.decompress(member, GZIP)])
    held = dict(headers)
    claimed = held["WARC-Payload-Digest"].removeprefix("sha1:")
    page, refers_to = held["X-Page-ID"], held.get("X-Refers-To-Page-ID", "")
    size = held.get("X-Payload-Length")
    if held["WARC-Type"] == "response":
        payload = http_parts(block)[1]
        size = len(payload)
        if digest(payload) != claimed:
            raise ValueError(f"payload of {held['WARC-Record-ID']} does not have its digest")
    return {
        "page_id": int(page) if page else None,
        "payload_bytes": int(size),
        "payload_digest": claimed,
        "record_type": held["WARC-Type"],
        "refers_to": int(refers_to) if refers_to else None,
        "record_id": held["WARC-Record-ID"],
        "refers_to_record": held.get("WARC-Refers-To"),
    }


RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint, record_id string, refers_to_record string"
)
_RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("record_id", pa.string()),
        ("refers_to_record", pa.string()),
    ]
)


def archive_pages(
    pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write, normalise and read back all pages; a row per record."""
    spark = pages.sparkSession

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = new_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    raw, tidy = new_path(spark, "warc-raw"), new_path(spark, "warc")
    manifest = written(write_archives(pages, raw, archive_bytes), "warc-manifest")
    archives = manifest.select("archive").distinct()
    number = max(1, archives.count())
    whole = archives.join(revisits(manifest, least_bytes), "archive", "left").repartition(number)
    tidied = written(normalise(whole, tidy), "warc-archives")
    return read_records(tidied.repartition(number))
