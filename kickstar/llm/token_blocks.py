"""Token-id files in patched frame-of-reference blocks.

File layout (little-endian):

* magic ``TKPF``, part (u32), first token of the file within its part (u64), documents (u32),
  blocks (u32), block length (u32);
* document table: has-id bytes, ids (i64), token counts (u64);
* block index: start of each block in the block area (u64), so any block is read alone;
* blocks: minimum (u32), width (u8), exceptions (u16); exception places (u16) and values
  (u32); the other values minus the minimum, packed at ``width`` bits. The width is the
  number of bits that ``percentile`` of the block's values need; larger values are the
  exceptions (their packed bits are 0);
* ``FPKT``.

Documents are sorted by id in range partitions (ties by text hash, so one id that many rows
share does not fill one partition); each task writes its files in order, closing one at
``file_tokens`` ids. Readers get the global start of a document from the token totals of the
parts before its own, one row per part.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kickstar.llm.common import read_files, stored, write_files

MAGIC, ENDING = b"TKPF", b"FPKT"
HEAD = "<4sIQIII"
BLOCK = "<IBH"
#: The pre-tokenizer of byte-level BPE files that keep the usual pattern.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters that regular expression libraries disagree on as white space.
_DOUBTFUL = re.compile("[\x1c-\x1f\x85\u180e\u200b]")
#: A blank that does not begin a piece: white space stands before it, and white space or nothing after it.
_INNER_BLANK = re.compile(r" (?<=\s )(?!\S)")


def byte_characters() -> dict[int, str]:
    """Byte-level BPE writes every byte as a visible character: printable bytes as
    themselves, the others in order as the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Kept(dict):
    """Results of ``make`` by key, in two generations: when ``keep`` keys are held they become the
    old ones, and an old key that is asked for again is held anew, so frequent keys stay. A key is
    held from its second time on (a table of one byte per hash value remembers the first), as
    most keys of a text come once. Long keys are not held."""
    SLOTS = 1 << 22

    def __init__(self, make, keep: int):
        self.make, self.keep, self.old, self.seen = make, keep, {}, bytearray(self.SLOTS)

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > 64:
                return value
            slot = hash(key) % self.SLOTS
            if not self.seen[slot]:
                self.seen[slot] = 1
                return value
        if len(self) >= self.keep:
            self.old, self.seen = dict(self), bytearray(self.SLOTS)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Ids of texts by the tokenizers library, its model asked once for each distinct piece.

    Byte-level BPE never merges across the pieces of its pre-tokenizer, so a text's ids are
    its pieces' ids in a row; and a blank begins a piece unless white space stands on both
    sides of it (the end of the text counts as such), so in texts without blanks of that kind
    pieces are looked up for what stands between two blanks. If the file has another pre-tokenizer or a
    normaliser, or a text has special tokens or doubtful white space, texts are encoded
    whole. At most twice ``keep`` results of either kind are remembered."""

    def __init__(self, path: str, keep: int = 300_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # Spark runs a task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        said = repr(self.tokenizer.pre_tokenizer)
        self.by_piece = self.tokenizer.normalizer is None and said.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in said
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        model, table = self.tokenizer.model, byte_characters()

        def ids_of(piece: str) -> bytes:
            plain = piece.isascii() and piece.isprintable()
            written = piece.replace(" ", table[0x20]) if plain else piece.encode().decode("latin-1").translate(table)
            return array("I", [t.id for t in model.tokenize(written)]).tobytes()

        def after_blank(run: str) -> bytes:
            if run.isalpha():
                return ids_of(" " + run)
            if run[:-1].isalpha():          # a word and one more character: two pieces
                return self.after_blank[run[:-1]] + self.pieces[run[-1]]
            return self._pieces(" " + run)

        self.pieces = _Kept(ids_of, keep)
        self.after_blank = _Kept(after_blank, keep)

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))

    def _bytes(self, text: str) -> bytes:
        if not self.by_piece or _DOUBTFUL.search(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()
        if "  " in text or _INNER_BLANK.search(text):
            return self._pieces(text)
        first, *rest = text.split(" ")
        return self._pieces(first) + b"".join(map(self.after_blank.__getitem__, rest))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self._bytes(t), np.uint32) for t in texts]


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, with what it remembers of earlier tasks. Spark sends
    this module with every task, so the encoder hangs on a module that the worker imports."""
    import tokenizers
    kept = tokenizers.__dict__.setdefault("_kickstar_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _bits(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int8)      # exact up to 53 bits; 0 needs none


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 32-bit values as rows of bytes, ``width`` bits each, the highest first: eight
    values fill ``width`` bytes, and each byte is put together from the values that reach into it."""
    rows, n = values.shape
    padded = np.zeros((rows, -(-n // 8) * 8), np.uint32)
    padded[:, :n] = values
    eight = np.ascontiguousarray(padded.reshape(-1, 8).T)
    out = np.zeros((width, eight.shape[1]), np.uint8)
    for j in range(width):
        for k in range(8 * j // width, (8 * j + 7) // width + 1):
            shift = (k + 1) * width - 8 * (j + 1)
            out[j] |= (eight[k] >> shift if shift >= 0 else eight[k] << -shift).astype(np.uint8)
    return np.ascontiguousarray(out.T).reshape(rows, -1)[:, :(n * width + 7) // 8]


def _unpack(raw: np.ndarray, width: int, n: int) -> np.ndarray:
    rows = len(raw)
    padded = np.zeros((rows, -(-n // 8) * width), np.uint8)
    padded[:, :raw.shape[1]] = raw
    parts = np.ascontiguousarray(padded.reshape(-1, width).T)
    out = np.zeros((8, parts.shape[1]), np.uint32)
    for k in range(8):
        for j in range(k * width // 8, (k * width + width - 1) // 8 + 1):
            shift = (k + 1) * width - 8 * (j + 1)
            byte = parts[j].astype(np.uint32)           # bits above the value's own 32 fall out
            out[k] |= byte << np.uint32(shift) if shift >= 0 else byte >> np.uint32(-shift)
    out &= np.uint32((1 << width) - 1)
    return np.ascontiguousarray(out.T).reshape(rows, -1)[:, :n]


def encode_blocks(ids: np.ndarray, length: int = 512, percentile: float = 0.9) -> tuple[bytes, np.ndarray]:
    """(block area, start of each block); the last block may be shorter."""
    out: list[bytes] = []
    for at in range(0, len(ids), length * 2048):
        part = ids[at:at + length * 2048]
        full = len(part) // length
        groups = [part[:full * length].reshape(full, length)] + ([part[full * length:].reshape(1, -1)] if len(part) % length else [])
        for rows in groups:
            if not len(rows):
                continue
            low = rows.min(axis=1)
            rest = rows - low[:, None]
            need = _bits(rest)
            nth = min(rows.shape[1] - 1, int(np.ceil(percentile * rows.shape[1])) - 1)
            width = np.partition(need, nth, axis=1)[:, nth]
            odd = need > width[:, None]
            packed: list[bytes] = [b""] * len(rows)
            for w in np.unique(width):
                pick = np.flatnonzero(width == w)
                if w:
                    raw = _pack(np.where(odd[pick], 0, rest[pick]), int(w))
                    for k, i in enumerate(pick):
                        packed[i] = raw[k].tobytes()
            for i in range(len(rows)):
                places = np.flatnonzero(odd[i])
                out.append(struct.pack(BLOCK, int(low[i]), int(width[i]), len(places)) + places.astype("<u2").tobytes()
                           + rest[i][places].astype("<u4").tobytes() + packed[i])
    starts = np.cumsum([0, *map(len, out)])[:-1].astype("<u8")
    return b"".join(out), starts


def _block_head(area: bytes, at: int) -> tuple[int, int, int]:
    return struct.unpack_from(BLOCK, area, at)


def decode_blocks(area: bytes, starts: np.ndarray, total: int, length: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks first .. last (exclusive) of ``total`` ids."""
    last = len(starts) if last is None else last
    out = np.zeros((max(0, last - first), length), np.uint32)
    by_width: dict[tuple[int, int], list[tuple[int, int]]] = {}
    patches = []
    for b in range(first, last):
        at = int(starts[b])
        low, width, n_odd = _block_head(area, at)
        n = min(length, total - b * length)
        body = at + struct.calcsize(BLOCK)
        if n_odd:
            patches.append((b - first, low, np.frombuffer(area, "<u2", n_odd, body), np.frombuffer(area, "<u4", n_odd, body + 2 * n_odd)))
        out[b - first, :n] = low
        if width:
            by_width.setdefault((width, n), []).append((b - first, body + 6 * n_odd))
    for (width, n), blocks in by_width.items():
        size = (width * n + 7) // 8
        for i in range(0, len(blocks), 2048):
            part = blocks[i:i + 2048]
            raw = np.stack([np.frombuffer(area, np.uint8, size, at) for _, at in part])
            rows = [k for k, _ in part]
            out[rows, :n] += _unpack(raw, width, n)
    for k, low, places, values in patches:
        out[k, places] = low + values
    return out.reshape(-1)[:total - first * length]


def encode_file(part: int, before: int, doc_ids: list[int | None], ids: list[np.ndarray], length: int = 512, percentile: float = 0.9) -> bytes:
    """The file without its ending, which the writer adds."""
    area, starts = encode_blocks(np.concatenate(ids) if ids else np.empty(0, np.uint32), length, percentile)
    return b"".join([struct.pack(HEAD, MAGIC, part, before, len(doc_ids), len(starts), length),
                     np.array([d is not None for d in doc_ids], np.uint8).tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     np.array([len(x) for x in ids], "<u8").tobytes(), starts.tobytes(), area])


def decode_file(content: bytes) -> tuple[int, int, list[int | None], np.ndarray, np.ndarray]:
    """(part, first token within the part, document ids, token counts, all ids)."""
    magic, part, before, n, n_blocks, length = struct.unpack_from(HEAD, content)
    if magic != MAGIC or content[-4:] != ENDING:
        raise ValueError("not a token file")
    at = struct.calcsize(HEAD)
    there = np.frombuffer(content, np.uint8, n, at)
    docs = np.frombuffer(content, "<i8", n, at + n)
    counts = np.frombuffer(content, "<u8", n, at + 9 * n).astype(np.int64)
    starts = np.frombuffer(content, "<u8", n_blocks, at + 17 * n)
    area = content[at + 17 * n + 8 * n_blocks:-4]
    ids = decode_blocks(area, starts, int(counts.sum()), length)
    return part, before, [int(d) if t else None for d, t in zip(docs, there)], counts, ids


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, file_tokens: int = 1 << 21, length: int = 512,
                 percentile: float = 0.9, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text (null: empty), each followed by ``end_id``, in ascending
    id order (null ids first, equal ids by text hash) to files below ``path``.

    ``tokenizer`` is the path of a tokenizers file that every executor can read. An empty table
    writes no file; other columns are not read, whatever their names."""
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text")).repartitionByRange(n, "doc_id", "th").sortWithinPartitions("doc_id", "th")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder, part, before = worker_encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        ids: list[np.ndarray] = []
        held = 0

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([encode_file(part, before, doc_ids, ids, length, percentile)], pa.binary())], ["content"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                for d, x in zip(some.column(0).to_pylist(), encoder(some.column(1).to_pylist())):
                    doc_ids.append(d)
                    ids.append(np.append(x, np.uint32(end_id)))
                    held += len(x) + 1
                    if held >= file_tokens:
                        yield file()
                        before += held
                        doc_ids, ids, held = [], [], 0
        if doc_ids:
            yield file()

    write_files(rows.select("doc_id", "text").mapInArrow(run, "content binary"), "content", path, ENDING)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(part, at, doc_id, n_tokens, ids_crc32, ids) of every document; ``at`` is the document's
    first token within its part. ``ids`` (array<int>) only ``with_ids``."""
    schema = "part int, at long, doc_id long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                part, before, docs, counts, ids = decode_file(content.as_py())
                ends = np.cumsum(counts)
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[e - c:e].tobytes()) for e, c in zip(ends, counts)]
                cols = [pa.array([part] * len(docs), pa.int32()), pa.array(before + ends - counts, pa.int64()), pa.array(docs, pa.int64()),
                        pa.array(counts, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, ["part", "at", "doc_id", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    return read_files(spark, path).mapInArrow(run, schema)


def with_starts(tokens: DataFrame) -> DataFrame:
    """``start``, the ids of all documents before each, from the totals of the parts."""
    tokens = stored(tokens, "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)       # one row per part
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    return tokens.join(offsets, "part").withColumn("start", F.col("offset") + F.col("at")).drop("part", "at", "offset")
