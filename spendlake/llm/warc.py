"""WARC archives with a Zstandard dictionary, written and read back by parallel tasks.

A dictionary is built from a bounded sample of the records. Every archive file starts with a
skippable frame that holds it; each record follows as a compressed frame of its own, so that one
record can be read without its neighbours and no reader needs anything but the file.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import bottom_rows, map_arrow, materialize, scratch_dir

# The skippable frame of a dictionary, and the least payload that may be revisited.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_BYTES = 100

#: Bounds of the dictionary and of the sample it is built from.
DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS = 500
SAMPLE_BYTES = 16 << 10
LEVEL = 3
#: A new file starts when one has reached this size.
FILE_BYTES = 256 << 20

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2026-01-01T00:00:00Z"


def payload(html: str = "html") -> Column:
    """The page's bytes; null is empty."""
    return F.coalesce(F.col(html), F.lit("")).cast("binary")


def roles(pages: DataFrame) -> DataFrame:
    """``page_id, digest, refers_to`` once per page and payload; no payload is moved.

    Of equal payloads of ``REVISIT_BYTES`` or more the least ``page_id`` is archived, others refer to
    it. Null ids refer to the least id there is.
    """
    content = payload()
    keyed = pages.select(
        "page_id", F.sha2(content, 256).alias("digest"), F.octet_length(content).cast("long").alias("size")
    ).groupBy("page_id", "digest").agg(F.max("size").alias("size"))
    keyed = materialize(keyed)
    first = keyed.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return keyed.join(first, "digest", "left").select("page_id", "digest", refers.alias("refers_to"))


def _header(lines: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in lines) + b"\r\n"


def record(page_id: int | None, url: str | None, digest: str, refers_to: int | None, body: bytes) -> bytes:
    """One response or revisit record; a revisit carries the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + body
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", "" if url is None else "".join(url.split())),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Payload-Length", str(len(body))),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to is not None:
        lines += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return _header([*lines, ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame) -> bytes:
    """Dictionary from the beginnings of a bounded sample of records; empty if they are too few."""
    chosen = bottom_rows(pages.select("page_id").filter("page_id is not null").distinct(), "page_id", SAMPLE_RECORDS)
    sample = pages.select("page_id", "url", F.substring(payload(), 1, SAMPLE_BYTES).alias("body"))
    # the ids of at most SAMPLE_RECORDS pages are sent out, their beginnings come back
    sample = sample.join(F.broadcast(chosen), "page_id").dropDuplicates(["page_id"]).orderBy("page_id")
    records = [
        record(r.page_id, r.url, hashlib.sha256(r.body).hexdigest(), None, bytes(r.body)) for r in sample.collect()
    ]
    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 8)
    if len(records) < 8 or size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:  # the samples have nothing in common
        return b""


def _file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a folder, of whatever kind the scratch folder is."""
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri else (pa.fs.LocalFileSystem(), uri)


def _write_batches(batches, folder: str, dictionary: bytes) -> Iterator[pa.RecordBatch]:
    """Archive a task's records in files of its own, and name them once they are whole.

    Columns page_id, url, digest, refers_to, body.
    """
    files, base = _file_system(folder)
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    codec = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
    out, written, name = None, 0, ""

    def close() -> str:
        out.close()
        return f"{name}.warc.zst"

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if out is None:
                name, written = uuid.uuid4().hex, 0
                out = files.open_output_stream(f"{base}/{name}.warc.zst", compression=None)
                out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
            frame = codec.compress(record(*row[:4], row[4] or b""))
            out.write(frame)
            written += len(frame)
            if written >= FILE_BYTES:
                yield pa.RecordBatch.from_pydict({"file": [close()]})
                out = None
    if out is not None:
        yield pa.RecordBatch.from_pydict({"file": [close()]})


def write_archives(pages: DataFrame, folder: str, dictionary: bytes | None = None) -> DataFrame:
    """Archive all of ``pages`` (``page_id, url, html``) below ``folder``; returns the table of files.

    Files of attempts that failed or ran twice are not in the returned table, which is what readers
    go by.
    """
    dictionary = train_dictionary(pages) if dictionary is None else dictionary
    role = roles(pages)
    content = pages.select("page_id", "url", payload().alias("body")).withColumn("digest", F.sha2("body", 256))
    both = content.page_id.eqNullSafe(role.page_id) & (content.digest == role.digest)
    rows = content.join(role.hint("shuffle_hash"), both).select(
        content.page_id, "url", content.digest, "refers_to", "body"
    )
    files, base = _file_system(folder)
    files.create_dir(base, recursive=True)
    return materialize(rows.transform(map_arrow, partial(_write_batches, folder=folder, dictionary=dictionary), "file string"))


def read_frames(stream: io.RawIOBase) -> Iterator[bytes]:
    """Decompressed records of one archive, one at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame")
    dictionary = stream.read(size)
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    codec, rest = zstandard.ZstdDecompressor(dict_data=shared), b""
    while True:
        one, parts = codec.decompressobj(), []
        while not one.eof:
            rest = rest or stream.read(1 << 20)
            if not rest:
                if parts:
                    raise ValueError("archive ends inside a record")
                return
            parts.append(one.decompress(rest))
            rest = one.unused_data if one.eof else b""
        yield b"".join(parts)


def parse(data: bytes) -> dict:
    """Headers and payload of a record, its block checked against the stated length."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    if data[len(head) + 4 + len(block) :] != b"\r\n\r\n":
        raise ValueError("record does not end where it says")
    body = block.partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response":
        if hashlib.sha256(body).hexdigest() != fields["WARC-Payload-Digest"].removeprefix("sha256:"):
            raise ValueError("payload does not match its digest")
    return fields | {"payload": body}


_READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _read_batches(batches, folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    files, base = _file_system(folder)
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )
    for batch in batches:
        for name in batch.column(0).to_pylist():
            rows, size = [], 0
            with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                for data in read_frames(stream):
                    r = parse(data)
                    rows.append(
                        {
                            "page_id": _page(r["WARC-Record-ID"]), "url": r["WARC-Target-URI"],
                            "payload_bytes": int(r["WARC-Payload-Length"]),
                            "payload_digest": r["WARC-Payload-Digest"].removeprefix("sha256:"),
                            "record_type": r["WARC-Type"], "refers_to": _page(r.get("WARC-Refers-To")),
                            "payload": r["payload"] if payloads and r["WARC-Type"] == "response" else None,
                        }
                    )
                    size += len(data) if payloads else 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(files: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives in ``files``, every response checked against its digest.

    One file is one task's work at a time, streamed record by record.
    """
    spread = files.repartition(max(files.sparkSession.sparkContext.defaultParallelism, 1), "file")
    return spread.mapInArrow(partial(_read_batches, folder=folder, payloads=payloads), _READ)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` and read the archives back, payloads left out: a row per page.

    Null html is an empty payload; null ids and urls come back null and empty. Rows that repeat an
    archived page are responses as well. An empty table writes no file and gives no rows.
    """
    folder = folder or scratch_dir(pages.sparkSession)
    return read_archives(write_archives(pages, folder), folder, payloads=False).drop("payload")

