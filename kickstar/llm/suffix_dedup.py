"""Removal of repeated byte strings through a distributed sparse suffix array.

All texts are UTF-8 bytes in the order of (id, place). A byte goes if a string of ``length``
bytes that also starts earlier covers it. Strings are judged on the input, never on what is
left, and none crosses two documents.

1. *Suffixes that take part.* In each string of ``length`` bytes the leftmost smallest of its
   hashed ``lead``-byte tokens is its anchor: a choice by the content alone, so equal strings
   have equal anchors at the same distance. Only suffixes that begin at an anchor are sorted
   (about one in ``(length - lead) / 2``); no repeated string is lost by that.
2. *Exact surroundings.* The bytes from ``length - lead`` before an anchor to ``length`` after
   it hold every string that the anchor can stand for. Anchors with equal token and equal
   surroundings are one class; all but its first are covered as far as these reach. A batch of
   texts first settles its own repetitions, so a passage in a third of all texts sends one row
   a batch. Anchors whose token stands in one class only need no more work.
3. *Suffix order.* The first anchors of the classes of a token with several classes are
   compared byte by byte: their suffixes are range-partitioned by sampled splitters on their
   leading bytes, and every bucket sorts its suffixes by multikey quicksort with characters of
   eight bytes. Common prefixes of neighbours number the strings after the anchor, the same
   for the reversed bytes before it; a string is a pair of both numbers.
4. *Across boundaries.* A bucket is a range of the suffix order, so only strings whose bytes
   from the anchor on begin the bucket's first or last suffix can stand in another bucket too
   (or, where a bucket cuts a large token group in pieces, in another piece). These are
   compared once more by their 128-bit hashes, after each piece has settled its own repetitions.
5. The covered spans are gathered per document and cut out.

Texts are shuffled once, into a table in the shared folder that is bucketed by id; the spans
then meet them without another shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickstar.llm.common import bucketed, stored, without
from kickstar.llm.rolling import Prefixes, mixed

RESULT = ("kept", "n_bytes", "n_removed", "n_spans", "spans")
PIECE = 1 << 21                 # bytes hashed at a time
PLACE = np.uint64(2 * PIECE - 1)    # the low bits that hold a place within a piece


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id0, tie, lead, body, rest): the rows of ``docs``, bucketed by id. (id0, tie) orders the
    documents by (id, null first, text hash) and is the same for rows with equal id and text,
    of which one leads."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    others = [F.col(f"`{c}`") for c in without(docs, RESULT, (id_col,)).columns if c != text_col]
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-2**63)).alias("id0"),
                       F.col(f"`{id_col}`").isNotNull().alias("known"), F.xxhash64(body).alias("th"), body.alias("body"),
                       F.struct(*others).alias("rest")).repartition(n, "id0")
    of_id = Window.partitionBy("id0").orderBy("known", "th")
    ranked = rows.withColumn("tie", F.dense_rank().over(of_id) - 1).withColumn("lead", F.coalesce(
        (F.lag("th").over(of_id) != F.col("th")) | (F.lag("known").over(of_id) != F.col("known")), F.lit(True)))
    return bucketed(ranked.select("id0", "tie", "lead", "body", "rest"), "id0", n, "suffix-texts")


def _windows_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, by doubling."""
    s = 1
    while 2 * s <= w:
        x, s = np.minimum(x[:-s], x[s:]), 2 * s
    return np.minimum(x[:-(w - s)], x[w - s:]) if s < w else x


def piece_anchors(buffer: bytes, starts: np.ndarray, ends: np.ndarray, length: int, lead: int, poly: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``buffer``, token hashes) of the anchors of all strings inside [start, end)."""
    long = ends - starts >= length
    if not long.any():
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    prefixes = poly.of(np.frombuffer(buffer, np.uint8).astype(np.uint64) + np.uint64(1))
    hashes = poly.parts(prefixes, slice(0, len(buffer) - lead + 1), slice(lead, None))
    least = _windows_min((hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64), length - lead + 1)
    inside = np.zeros(len(least) + 1, np.int32)
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    chosen = np.zeros(len(hashes), bool)
    chosen[(least[np.cumsum(inside[:-1]) > 0] & PLACE).astype(np.int64)] = True
    at = np.flatnonzero(chosen)
    return at, hashes[at]


def anchors(texts: list[bytes], length: int, lead: int, poly: Prefixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, place, token hash) of all anchors, in order; long texts are read in
    overlapping pieces."""
    docs, places, tokens = [], [], []

    def take(parts: list[tuple[int, int, bytes]]) -> None:
        sizes = np.array([len(p[2]) for p in parts], np.int64)
        ends = np.cumsum(sizes)
        at, h = piece_anchors(b"".join(p[2] for p in parts), ends - sizes, ends, length, lead, poly)
        of = np.searchsorted(ends, at, side="right")
        docs.append(np.array([p[0] for p in parts], np.int64)[of])
        places.append(at - (ends - sizes)[of] + np.array([p[1] for p in parts], np.int64)[of])
        tokens.append(h)

    parts, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[at:at + PIECE + length - 1]
            if size + len(part) > PIECE and parts:
                take(parts)
                parts, size = [], 0
            parts.append((i, at, part))
            size += len(part)
    if parts:
        take(parts)
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    d, p, h = np.concatenate(docs), np.concatenate(places), np.concatenate(tokens)
    order = np.lexsort((p, d))
    d, p, h = d[order], p[order], h[order]
    new = np.ones(len(d), bool)             # two pieces of a text may share an anchor
    new[1:] = (d[1:] != d[:-1]) | (p[1:] != p[:-1])
    return d[new], p[new], h[new]


def _batches(batches: Iterator[pa.RecordBatch], column: str, size: int = 4 * PIECE) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of about ``size`` bytes."""
    held, n = [], 0
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)
        upto, at = np.cumsum(lengths), 0
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + max(1, size - n), side="right")))
            held.append(batch.slice(at, end - at))
            n += int(upto[end - 1] - before)
            at = end
            if n >= size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _anchor_rows(texts: DataFrame, length: int, lead: int) -> DataFrame:
    """(seen, h, ctx, id0, tie, at) of all anchors: token, surroundings, place. ``seen`` are
    later members of their class in the same batch; their ``h`` only spreads them."""
    reach = length - lead

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Prefixes()
        for batch in _batches(batches, "body"):
            bodies = batch.column("body").to_pylist()
            d, p, h = anchors(bodies, length, lead, poly)
            digest = xxhash.xxh3_64_intdigest
            ctx = np.fromiter((digest(bodies[i][max(0, at - reach):at + length], min(reach, at)) for i, at in zip(d.tolist(), p.tolist())), np.uint64, len(d))
            ids = batch.column("id0").to_numpy()[d]
            ties = batch.column("tie").to_numpy()[d]
            order = np.lexsort((p, ties, ids, ctx, h))
            seen = np.zeros(len(d), bool)
            seen[1:] = (h[order][1:] == h[order][:-1]) & (ctx[order][1:] == ctx[order][:-1])
            h, ctx, ids, ties, p = (x[order] for x in (h, ctx, ids, ties, p))
            h = np.where(seen, mixed(ids.view(np.uint64) + mixed(p.astype(np.uint64))), h)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(h.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(ids),
                                              pa.array(ties), pa.array(p)], ["seen", "h", "ctx", "id0", "tie", "at"])
    return texts.filter("lead").select("id0", "tie", "body").mapInArrow(run, "seen boolean, h long, ctx long, id0 long, tie int, at long")


def _classes(rows: DataFrame, n: int) -> DataFrame:
    """(id0, tie, at, sure): ``sure`` anchors are later members of a class, the others first
    members of a class whose token stands in other classes too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None        # row of the open token's first class, not told yet
        token = kind = None     # of the last row
        for batch in batches:
            if not batch.num_rows:
                continue
            seen, h, ctx, ids, ties, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            new_h = np.ones(len(h), bool)
            new_h[1:] = (h[1:] != h[:-1]) | (seen[1:] != seen[:-1])
            new_h[0] = token != (bool(seen[0]), int(h[0]))
            new_c = new_h.copy()
            new_c[1:] |= ctx[1:] != ctx[:-1]
            new_c[0] |= kind != int(ctx[0])
            later = (seen | ~new_c)
            second = new_c & ~new_h & ~seen             # a class after the token's first
            # the first class is told when a second one shows up
            group = np.cumsum(new_h)                    # 0: the token that was open before
            several = np.zeros(group[-1] + 1, bool)
            several[group[second]] = True
            tell = second | (new_h & ~seen & several[group])
            if first is not None and several[0]:
                yield pa.RecordBatch.from_pylist([first])
                first = None
            if group[-1] > 0:                           # another token has begun: what becomes of it is open
                first = None
                head = int(np.flatnonzero(new_h)[-1])
                if not several[group[-1]] and not seen[head]:
                    first = {"id0": int(ids[head]), "tie": int(ties[head]), "at": int(at[head]), "sure": False}
            token, kind = (bool(seen[-1]), int(h[-1])), int(ctx[-1])
            out = later | tell
            yield pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(ties[out]), pa.array(at[out]), pa.array(later[out])],
                                             ["id0", "tie", "at", "sure"])
    return (rows.repartition(n, "h").sortWithinPartitions("seen", "h", "ctx", "id0", "tie", "at")
            .mapInArrow(_typed(run), "id0 long, tie int, at long, sure boolean"))


_JUDGED = pa.schema([("id0", pa.int64()), ("tie", pa.int32()), ("at", pa.int64()), ("sure", pa.bool_())])


def _typed(run):
    schema = _JUDGED

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.cast(schema) if batch.num_rows else pa.RecordBatch.from_pylist([], schema)
    return cast


def _surroundings(texts: DataFrame, judged: DataFrame, length: int, lead: int) -> DataFrame:
    """(suffix, before, id0, tie, at) of the anchors to compare: the bytes from the anchor on,
    and those before it, reversed."""
    reach = length - lead

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            suffix, before, ids, ties, places = [], [], [], [], []
            for id0, tie, body, wanted in zip(*(batch.column(i) for i in range(4))):
                tie, body = tie.as_py(), body.as_py()
                for x in wanted.as_py():
                    if x["tie"] == tie:
                        at = x["at"]
                        suffix.append(body[at:at + length])
                        before.append(body[max(0, at - reach):at][::-1])
                        ids.append(id0.as_py())
                        ties.append(tie)
                        places.append(at)
            yield pa.RecordBatch.from_arrays([pa.array(suffix, pa.binary()), pa.array(before, pa.binary()), pa.array(ids, pa.int64()),
                                              pa.array(ties, pa.int32()), pa.array(places, pa.int64())], ["suffix", "before", "id0", "tie", "at"])
    wanted = judged.filter("not sure").groupBy("id0").agg(F.collect_list(F.struct("tie", "at")).alias("wanted"))
    return (texts.filter("lead").select("id0", "tie", "body").join(wanted.hint("shuffle_hash"), "id0")
            .select("id0", "tie", "body", "wanted").mapInArrow(run, "suffix binary, before binary, id0 long, tie int, at long"))


def _characters(strings: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings as rows of big-endian eight-byte characters, padded with zeros, and their lengths."""
    width = -(-size // 8) * 8
    data = b"".join(s.ljust(width, b"\0") for s in strings)
    return np.frombuffer(data, ">u8").reshape(len(strings), width // 8), np.array([len(s) for s in strings], np.int64)


def multikey_order(chars: np.ndarray) -> np.ndarray:
    """Order of the rows by multikey quicksort: the rows of every open group (equal so far) are
    partitioned by their next character, all groups of a depth at once; groups of one row are
    done, so later characters are only looked at where rows still tie."""
    order = np.argsort(chars[:, 0], kind="stable")
    group = np.zeros(len(order), np.int64)
    for depth in range(chars.shape[1]):
        key = chars[order, depth]
        new = np.ones(len(order), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        open_ = np.flatnonzero(np.bincount(group)[group] > 1)
        if depth + 1 == chars.shape[1] or not len(open_):
            break
        part = order[open_]
        order[open_] = part[np.lexsort((chars[part, depth + 1], group[open_]))]
    return order


def common_prefixes(chars: np.ndarray, order: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bytes that each row in ``order`` shares with the one before it (0 for the first)."""
    out = np.zeros(len(order), np.int64)
    for i in range(1, len(order), 4096):
        a, b = order[i - 1:i + 4095], order[i:i + 4096]
        a = a[:len(b)]
        x, y = (np.ascontiguousarray(chars[r]).view(np.uint8) for r in (a, b))
        differ = x != y
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
        out[i:i + len(b)] = np.minimum(first, np.minimum(lengths[a], lengths[b]))
    return out


def compare(suffixes: list[bytes], before: list[bytes], rank: np.ndarray, length: int, lead: int) -> tuple[np.ndarray, ...]:
    """Strings of ``length`` bytes that hold the anchors, by their distance 0 .. length - lead to it.

    Returns for every anchor the smallest and largest distance of a string that an anchor of a
    smaller rank has too (-1: none), (anchor, distance) of the strings that are the first of
    their kind here, and the bytes that every suffix shares with the first and the last one."""
    reach, n = length - lead, len(suffixes)
    right, right_len = _characters(suffixes, length)
    left, left_len = _characters(before, reach)
    orders = [multikey_order(x) for x in (right, left)]
    common = [common_prefixes(x, o, ls) for x, o, ls in zip((right, left), orders, (right_len, left_len))]
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    firsts = []
    for far in range(reach + 1):
        there = np.flatnonzero((left_len >= far) & (right_len >= length - far))
        if not len(there):
            continue
        number = []
        for order, lcp, size in zip(orders, common, (length - far, far)):
            of = np.empty(n, np.int64)
            of[order] = np.cumsum(lcp < size)
            number.append(of[there])
        key = number[0] * (n + 1) + number[1]
        by = np.lexsort((rank[there], key))
        again = np.zeros(len(by), bool)
        again[1:] = key[by][1:] == key[by][:-1]
        repeat = there[by[again]]
        high[repeat] = far
        low[repeat] = np.where(low[repeat] < 0, far, low[repeat])
        first = there[by[~again]]
        firsts.append(np.stack([first, np.full(len(first), far)]))
    first = np.concatenate(firsts, axis=1) if firsts else np.empty((2, 0), np.int64)
    head, tail = np.empty(n, np.int64), np.empty(n, np.int64)
    if n:
        order, lcp = orders[0], common[0].copy()
        lcp[0] = right_len[order[0]]
        head[order] = np.minimum.accumulate(lcp)
        lcp = np.append(common[0][1:], right_len[order[-1]])
        tail[order] = np.minimum.accumulate(lcp[::-1])[::-1]
    return low, high, first[0], first[1], head, tail


def _bucket_sort(rows: DataFrame, n: int, length: int, lead: int, chunk: int) -> DataFrame:
    """(id0, tie, lo, hi, a, b): covered spans, and with hashes (a, b) strings that must be
    compared with those of other buckets or pieces."""
    names = ["id0", "tie", "lo", "hi", "a", "b"]

    def settle(held: list[tuple], torn: np.ndarray, is_first: bool, is_last: bool) -> pa.RecordBatch:
        suffixes, before, ids, ties, at = zip(*held)
        ids, ties, at = np.array(ids, np.int64), np.array(ties, np.int64), np.array(at, np.int64)
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((at, ties, ids))] = np.arange(len(ids))
        low, high, first, far, head, tail = compare(list(suffixes), list(before), rank, length, lead)
        hit = np.flatnonzero(high >= 0)
        keep = torn[first] | (is_first & (head[first] >= length - far)) | (is_last & (tail[first] >= length - far))
        first, far = first[keep], far[keep]
        hashes = [xxhash.xxh3_128_digest(before[i][:o][::-1] + suffixes[i][:length - o]) for i, o in zip(first.tolist(), far.tolist())]
        words = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2) if hashes else np.empty((0, 2), np.int64)
        rows_of = np.concatenate([hit, first])
        lo = np.concatenate([at[hit] - high[hit], at[first] - far])
        hi = np.concatenate([at[hit] - low[hit] + length, at[first] - far + length])
        none = pa.nulls(len(hit), pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.array(ids[rows_of]), pa.array(ties[rows_of].astype(np.int32)), pa.array(lo), pa.array(hi),
            pa.concat_arrays([none, pa.array(np.ascontiguousarray(words[:, 0]))]), pa.concat_arrays([none, pa.array(np.ascontiguousarray(words[:, 1]))])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, token, start = [], None, 0        # rows; token of the last, and where it begins
        torn = set()                            # tokens of held rows that are cut in pieces
        is_first = True

        def cut(at: int, is_last: bool = False) -> pa.RecordBatch:
            nonlocal held, start, is_first
            part, held, start = held[:at], held[at:], max(0, start - at)
            out = settle(part, np.array([r[0][:lead] in torn for r in part], bool), is_first, is_last)
            is_first = False
            return out

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                own = row[0][:lead]
                if own != token:
                    if len(held) >= chunk:
                        yield cut(len(held))
                        torn.clear()
                    token, start = own, len(held)
                elif len(held) >= 2 * chunk:
                    if start:
                        yield cut(start)
                        torn.clear()
                    else:
                        torn.add(own)
                        yield cut(len(held))
                held.append(row)
        if held:
            yield cut(len(held), True)

    return (rows.repartitionByRange(n, "suffix", "before").sortWithinPartitions(F.substring("suffix", 1, lead))
            .mapInArrow(run, "id0 long, tie int, lo long, hi long, a long, b long"))


def repeated_spans(texts: DataFrame, length: int, lead: int, n: int, chunk: int = 20_000) -> DataFrame:
    """(id0, tie, lo, hi): spans whose union are the bytes that repeated strings cover; ``hi`` may
    lie behind the text's end, and spans of fewer than ``length`` bytes inside the text do not count."""
    judged = stored(_classes(_anchor_rows(texts, length, lead), n), "suffix-classes")
    strings = stored(_bucket_sort(_surroundings(texts, judged, length, lead), n, length, lead, chunk), "suffix-order")
    # two anchors of a text may have sent the same string of the same place
    nth = F.dense_rank().over(Window.partitionBy("a", "b").orderBy("id0", "tie", "lo"))
    across = strings.filter("a is not null").withColumn("nth", nth).filter("nth > 1")
    reach = length - lead
    sure = judged.filter("sure").select("id0", "tie", F.greatest(F.col("at") - reach, F.lit(0)).alias("lo"), (F.col("at") + length).alias("hi"))
    spans = ["id0", "tie", "lo", "hi"]
    return sure.unionAll(strings.filter("a is null").select(spans)).unionAll(across.select(spans))


def _merged(spans: list[dict], tie: int, size: int, length: int) -> list[tuple[int, int]]:
    """The maximal runs of the spans of one text, inside it."""
    out: list[list[int]] = []
    for lo, hi in sorted((x["lo"], min(x["hi"], size)) for x in spans if x["tie"] == tie):
        if hi - lo < length:
            continue
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def remove_repeats(docs: DataFrame, length: int = 100, lead: int | None = None, id_col: str = "doc_id", text_col: str = "text",
                   chunk: int = 20_000) -> DataFrame:
    """Every row of ``docs`` without ``text_col``, with ``kept`` (binary: the bytes that stay),
    ``n_bytes``, ``n_removed``, ``n_spans`` and ``spans`` (array of (lo, hi), the removed runs).

    Earlier means: smaller id (null first; ids are cast to long), among equal ids the smaller
    hash of the text, then the smaller place. Rows with equal id and equal text are one document
    and get the same result; rows without an id are ordered together in one task, so they should
    be few. A null text is empty; texts shorter than ``length`` bytes and empty tables lose
    nothing. Very long texts are hashed in pieces. Columns of ``docs`` with names of results are
    replaced; all other columns stay, whatever their names. ``lead`` is the length of the sorted
    tokens (default: three tenths of ``length``)."""
    lead = lead or max(1, length * 3 // 10)
    if not 1 <= lead <= length:
        raise ValueError("lead must be between 1 and length")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = _texts(docs, id_col, text_col)
    spans = repeated_spans(texts, length, lead, n, chunk).groupBy("id0").agg(F.collect_list(F.struct("tie", "lo", "hi")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed, runs = [], [], [], []
            for tie, body, found in zip(*(batch.column(i) for i in range(3))):
                body = body.as_py()
                cut = _merged(found.as_py() or [], tie.as_py(), len(body), length)
                ends = [0, *(x for run in cut for x in run), len(body)]
                kept.append(b"".join(body[a:b] for a, b in zip(ends[::2], ends[1::2])))
                sizes.append(len(body))
                removed.append(len(body) - len(kept[-1]))
                runs.append([{"lo": lo, "hi": hi} for lo, hi in cut])
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array([len(r) for r in runs], pa.int64()), pa.array(runs, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))],
                ["rest", *RESULT])

    schema = T.StructType([texts.schema["rest"], *T._parse_datatype_string(
        "kept binary, n_bytes long, n_removed long, n_spans long, spans array<struct<lo:long,hi:long>>")])
    out = texts.join(spans.hint("shuffle_hash"), "id0", "left").select("tie", "body", "spans", "rest").mapInArrow(run, schema)
    return out.select("rest.*", *RESULT)
