"""WARC archives as seekable Zstandard bundles.

A bundle is one file: independent Zstandard frames that hold whole WARC/1.1 records, a
skippable frame with the record index (record identifier -> frame, offset inside the
decompressed frame, length) and a skippable frame with the seek table (compressed and
decompressed size of every frame), whose last bytes are the seekable-format magic number.
Any Zstandard reader sees a plain stream of records; a reader that knows the footer jumps
to one frame and decompresses nothing else.

Records with equal payloads are written once: the one with the smallest id is a response,
the others are revisits that name it. Only (id, digest) pairs are shuffled and counted to
find them, and a hot payload arrives pre-aggregated; the list of revisits then meets the
pages by page and digest.

Bounds: a task holds one frame and the compressed bytes of one bundle. Frames are closed at
``frame_bytes`` of records, bundles at ``bundle_bytes`` compressed; a single longer record
has a frame (and if need be a bundle) of its own.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickstar.llm.common import read_files, stored, write_files

# Fixed values of the Zstandard seekable format (little-endian).
SKIPPABLE_SEEK = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A5D
SEEKABLE_MAGIC = b"\xb1\xea\x92\x8f"
# Fixed value of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
                 "payload_digest string, payload binary, bundle string, frame long, frame_offset long, length long")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def classify(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to) per row; ``refers_to`` is null for responses.

    Payloads of fewer than ``min_bytes`` bytes are never revisits. Rows with a null id are
    ordered after all others; rows that repeat the smallest id are all responses; if all
    ids of a payload are null, all are responses. A null payload is the empty payload.
    Other columns, whatever their names, are not read."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    keys = rows.filter(F.octet_length("payload") >= min_bytes).select("page_id", "digest")
    first = (keys.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1 and first is not null").select("digest", "first"))
    # the revisits alone, written, so that few of them meet the pages without a shuffle of
    # payloads, and many by the page, never by a payload that many pages share
    revisits = stored(keys.join(first, "digest").filter("not page_id <=> first")
                      .select(F.col("page_id").alias("rid"), F.col("digest").alias("rdigest"), F.col("first").alias("refers_to")).distinct(), "revisits")
    return (rows.join(revisits, F.col("page_id").eqNullSafe(F.col("rid")) & (F.col("digest") == F.col("rdigest")), "left")
            .select("page_id", "url", "payload", "refers_to"))


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m.group()):02X}", url))
    head += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class _Bundle:
    """Frames, record index and seek table of one file."""

    def __init__(self, frame_bytes: int, level: int):
        self.frame_bytes, self.packer = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.parts: list[bytes] = []
        self.seek: list[tuple[int, int]] = []
        self.index: list[tuple[int | None, int, int, int]] = []
        self.size, self.open, self.fill = 0, [], 0

    def add(self, page_id: int | None, record: bytes) -> None:
        if self.fill and self.fill + len(record) > self.frame_bytes:
            self.close_frame()
        self.index.append((page_id, len(self.seek), self.fill, len(record)))
        self.open.append(record)
        self.fill += len(record)

    def _put(self, frame: bytes, plain: int) -> None:
        self.parts.append(frame)
        self.seek.append((len(frame), plain))
        self.size += len(frame)

    def close_frame(self) -> None:
        if self.open:
            self._put(self.packer.compress(b"".join(self.open)), self.fill)
            self.open, self.fill = [], 0

    def finish(self) -> bytes:
        """The file without its last four bytes, the magic number that the writer adds."""
        self.close_frame()
        self._put(_skippable(SKIPPABLE_INDEX, self.packer.compress(json.dumps(self.index).encode())), 0)
        table = b"".join(struct.pack("<II", c, p) for c, p in self.seek) + struct.pack("<IB", len(self.seek), 0)
        return b"".join(self.parts) + _skippable(SKIPPABLE_SEEK, table + SEEKABLE_MAGIC)[:-4]


def write_bundles(pages: DataFrame, path: str, min_bytes: int = 0, frame_bytes: int = 256 << 10,
                  bundle_bytes: int = 8 << 20, level: int = 3, date: str = "1970-01-01T00:00:00Z", **cols) -> None:
    """Write one WARC record per row of ``pages`` to bundles below ``path``.

    An empty table gives no bundle. ``**cols``: see :func:`classify`."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = _Bundle(frame_bytes, level)
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(4))):
                page_id, url, payload, refers_to = (x.as_py() for x in row)
                bundle.add(page_id, _record(page_id, url, payload, refers_to, date))
                if bundle.size >= bundle_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.finish()], pa.binary())], ["content"])
                    bundle = _Bundle(frame_bytes, level)
        if bundle.index:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.finish()], pa.binary())], ["content"])

    write_files(classify(pages, min_bytes, **cols).mapInArrow(pack, "content binary"), "content", path, SEEKABLE_MAGIC)


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of the frames, from the footer alone."""
    n, _, magic = struct.unpack("<IB4s", content[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    start, out, at = len(content) - 9 - 8 * n, [], 0
    for i in range(n):
        c, p = struct.unpack_from("<II", content, start + 8 * i)
        out.append((at, c, p))
        at += c
    return out


def record_index(content: bytes) -> list[tuple[int | None, int, int, int]]:
    """(record identifier, frame, offset in the decompressed frame, length)."""
    at, size, _ = seek_table(content)[-1]
    return [tuple(x) for x in json.loads(zstandard.ZstdDecompressor().decompress(content[at + 8:at + size]))]


def _frame(content: bytes, seek: list[tuple[int, int, int]], k: int) -> bytes:
    at, size, plain = seek[k]
    return zstandard.ZstdDecompressor().decompress(content[at:at + size], max_output_size=plain)


def parse(record: bytes) -> dict:
    """Fields of one WARC record; a response's length and digest are taken from its payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = h["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda x: None if x == "<urn:page:>" else int(x[10:-1])
    out = {"page_id": number(h["WARC-Record-ID"]), "record_type": h["WARC-Type"], "payload_digest": said,
           "url": re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), h["WARC-Target-URI"]) if "WARC-Target-URI" in h else None}
    if h["WARC-Type"] == "revisit":
        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
        return out | {"refers_to": number(h["WARC-Refers-To"]), "payload": None, "payload_bytes": length}
    if base32_sha1(payload) != said:
        raise ValueError(f"record {out['page_id']}: the payload does not have its digest")
    return out | {"refers_to": None, "payload": payload, "payload_bytes": len(payload)}


def _read(path: str, content: bytes, wanted: set | None, payloads: bool) -> Iterator[dict]:
    seek, have, plain = seek_table(content), -1, b""
    for page_id, frame, offset, length in record_index(content):
        if wanted is not None and page_id not in wanted:
            continue
        if frame != have:
            have, plain = frame, _frame(content, seek, frame)
        row = parse(plain[offset:offset + length])
        yield row | {"bundle": path, "frame": frame, "frame_offset": offset, "length": length,
                     "payload": row["payload"] if payloads else None}


def read_bundles(spark: SparkSession, path: str, payloads: bool = True, wanted: set[int] | None = None) -> DataFrame:
    """The records of all bundles below ``path``, with the place of each. ``wanted``: only
    these ids; frames without one of them are not decompressed. Payloads of revisits are null."""
    names = [f.split(" ")[0] for f in RECORD_SCHEMA.split(", ")]
    schema = spark.createDataFrame([], RECORD_SCHEMA).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for row in _read(name.as_py(), content.as_py(), wanted, payloads):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], arrow.field(c).type) for c in names], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], arrow.field(c).type) for c in names], names)

    return read_files(spark, path).mapInArrow(unpack, RECORD_SCHEMA)
