"""WARC archives compressed record by record with a Zstandard dictionary of their own.

``write_archives`` writes ``.warc.zst`` files: a skippable frame with the dictionary,
then one Zstandard frame per record. Each task writes the archives of its rows; an
archive's dictionary is trained on the records that it begins with. ``read_archives``
reads the records back, each frame by itself.

Nulls: a null payload is empty; a null url gives a record without target; a null id is
kept as null. Repeated rows are archived as often as they occur. An empty table gives no
archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sahaf.session import scratch_dir, staged

#: Fixed values of the formats: skippable frame of a dictionary, record version, profile of a repeated payload.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An archive is closed after so many bytes of compressed records.
ARCHIVE_BYTES = 256 << 20
#: A dictionary is trained on the records of an archive up to so many bytes.
TRAINING_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, first: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit has no block and names the record that holds its payload."""
    own = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}/{sha1}")
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": f"<urn:uuid:{own}>"}
    head["WARC-Date"] = "1970-01-01T00:00:00Z"
    if url is not None:
        head["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    if page_id is not None:
        head["WARC-X-Page-Id"] = str(page_id)
    head["WARC-Payload-Digest"] = f"sha1:{sha1}"
    block = b""
    if revisit:
        head["WARC-Profile"] = SAME_PAYLOAD
        head["WARC-Refers-To"] = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{first}/{sha1}')}>"
        head["WARC-X-Refers-To-Page-Id"] = str(first)
        head["WARC-X-Payload-Length"] = str(len(payload))
    else:
        head["Content-Type"] = "application/http; msgtype=response"
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        block = http.encode() + payload
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary of the samples; where they are too few to train on, their bytes themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=1024, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: Iterator[bytes], out) -> tuple[int, int, bool]:
    """Write one archive: records and bytes written, and whether records may be left."""
    first: list[bytes] = []
    size = 0
    for x in records:
        first.append(x)
        size += len(x)
        if size >= TRAINING_BYTES:
            break
    trained = train(first)
    body = trained.as_bytes()
    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
    trained.precompute_compress(level=3)
    pack = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True, write_checksum=True)
    count, written = 0, 8 + len(body)
    for x in first:
        written += out.write(pack.compress(x))
        count += 1
    first.clear()
    while written < ARCHIVE_BYTES:
        x = next(records, None)
        if x is None:
            return count, written, False
        written += out.write(pack.compress(x))
        count += 1
    return count, written, True


def write_archives(pages: DataFrame, path: str) -> DataFrame:
    """Archive the rows (page_id long, url string, payload binary, sha1 hexadecimal, first long,
    revisit boolean) under ``path``; returns the manifest (archive, records, bytes).

    A task that runs twice writes files of other names; the manifest, committed by Spark,
    lists those of the attempt that counts.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for page_id, url, payload, sha1, first, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield record(page_id, url, payload, base32(bytes.fromhex(sha1)), first, revisit)

        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        left = records()
        while (head := next(left, None)) is not None:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                count, size, _ = archive(_chain(head, left), out)
            yield pa.RecordBatch.from_pydict({"archive": [f"{path}/{name}"], "records": [count], "bytes": [size]})

    columns = pages.select("page_id", "url", "payload", "sha1", "first", "revisit")
    return staged(columns.mapInArrow(write, "archive string, records long, bytes long"), "warc-manifest")


def _chain(head: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield head
    yield from rest


def parse(data: bytes) -> dict:
    """Fields and block of one record."""
    head, _, block = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    return fields | {"block": block[: int(fields["Content-Length"])]}


def records_of(stream) -> Iterator[dict]:
    """Records of an archive, one frame at a time, by the dictionary in front of them."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive has no dictionary frame")
    body = stream.read(size)
    kind = zstandard.DICT_TYPE_AUTO
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body, dict_type=kind))
    rest = b""
    while rest or (rest := stream.read(1 << 20)):
        frame, record_parts = unpack.decompressobj(), []
        while True:
            record_parts.append(frame.decompress(rest))
            rest = frame.unused_data
            if frame.eof:
                break
            if not (rest := stream.read(1 << 20)):
                raise ValueError("the archive ends within a record")
        yield parse(b"".join(record_parts))


def read_archives(manifest: DataFrame) -> DataFrame:
    """Records of the archives: (page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to).

    ``payload`` is null for a revisit; its length and digest are those of the payload that
    it repeats. A response whose payload does not have the digest in its header is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_stream(name, compression=None) as stream:
                    rows: list[tuple] = []
                    held = 0
                    for r in records_of(stream):
                        rows.append(_row(r))
                        held += len(r["block"])
                        if held > 8 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    spread = manifest.select("archive").repartition(max(1, manifest.count()), "archive")
    return spread.mapInArrow(read, SCHEMA)


SCHEMA = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string,"
    " record_type string, refers_to long"
)
_TYPES = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def _row(r: dict) -> tuple:
    sha1 = r["WARC-Payload-Digest"].removeprefix("sha1:")
    own = int(r["WARC-X-Page-Id"]) if "WARC-X-Page-Id" in r else None
    if r["WARC-Type"] == "revisit":
        return own, r.get("WARC-Target-URI"), None, int(r["WARC-X-Payload-Length"]), sha1, "revisit", int(r["WARC-X-Refers-To-Page-Id"])
    payload = r["block"].partition(b"\r\n\r\n")[2]
    if base32(hashlib.sha1(payload).digest()) != sha1:
        raise ValueError(f"the payload of record {r['WARC-Record-ID']} is damaged")
    return own, r.get("WARC-Target-URI"), payload, len(payload), sha1, "response", None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TYPES, strict=True)], schema=_TYPES)


def with_revisits(pages: DataFrame, html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Adds payload, sha1, first and revisit: of equal payloads the smallest id is kept, others refer to it.

    Payloads of fewer than ``min_bytes`` bytes are never merged. Rows of the smallest id
    itself and rows whose group has no id are responses. Only digests that occur twice
    are joined back; they are staged, so Spark knows their size and moves the pages only
    where they are too many to be sent to every task.
    """
    pages = pages.select("page_id", "url", F.encode(F.coalesce(html, F.lit("")), "UTF-8").alias("payload"))
    pages = pages.withColumn("sha1", F.sha1("payload"))
    groups = pages.where(F.length("payload") >= min_bytes).groupBy("sha1")
    copies = groups.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    copies = staged(copies.select("sha1", "first"), "warc-copies")
    joined = pages.join(copies, "sha1", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("revisit", revisit)


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write every page (page_id, url, html) to archives and read them back."""
    path = path or f"{scratch_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(with_revisits(pages, min_bytes=min_bytes), path))
