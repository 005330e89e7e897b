"""Collocations: phrases of two to four words, scored by their parts, per language.

Words stand in pieces of a text (cut at punctuation and line ends); a phrase never crosses a
piece. Counts are exact and cover all texts.

1. *Fingerprints.* In a task, numpy prefix polynomials (Rabin-Karp) hash every word of a block
   of texts, and a second prefix polynomial over these hashes every run of words. A third one,
   with another base, gives each run a 16-bit check of its text.
2. *Counting.* A task sums its fingerprints; each has a count, an occurrence pointer (the
   smallest document id) and the sum of the checks of all its occurrences. Sorted blocks of them
   are dealt out by ranges of the fingerprint and summed there; frequent ones are kept. Words
   and pairs are counted first, then runs of three, then of four: a run is only frequent if
   the shorter runs in it are, so each pass leaves out runs with a part that is not in a filter of
   the frequent ones. The filter has a fixed size, one bit for the top bits of a fingerprint; a
   crowded filter lets more candidates through, never fewer.
3. *Verification.* The frequent fingerprints meet the texts of their pointers, which spell them
   out. The sum of checks must be the count times the phrase's own check: then all occurrences
   were this phrase. Fingerprints of several phrases are counted once more by their texts.
4. *Scores.* A candidate meets the counts of its parts by joins; a longer candidate marks the
   ones inside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kickstar.llm.common import stored
from kickstar.llm.rolling import Prefixes, mixed

# Characters that end a piece, the other separators, letters that are lower-cased.
BREAKS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_BYTES = bytes(0x0A if c in BREAKS else 0x20 if c in BLANKS else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
LONGEST = 4
BLOCK = 2 << 20             # bytes hashed at a time
KEPT = 2_000_000            # fingerprints that a task holds before it sums or sends them
FILTER_BITS = 26            # the filter has 2**26 bits, 8 MB
CHECK_BITS = 16
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _parts(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes that end at a break (whole, if it has none)."""
    at = 0
    while len(text) - at > size:
        end = text.rfind(b"\n", at, at + size) + 1 or text.find(b"\n", at + size) + 1
        if not end:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[str], list[int]]]:
    """(parts of texts, their languages, their ids) for about ``BLOCK`` bytes of texts."""
    parts, langs, ids, size = [], [], [], 0
    for batch in batches:
        for lang, body, id0 in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for part in _parts(body.translate(_BYTES), BLOCK):
                if parts and size + len(part) > BLOCK:
                    yield parts, langs, ids
                    parts, langs, ids, size = [], [], [], 0
                parts.append(part)
                langs.append(lang)
                ids.append(id0)
                size += len(part) + 1
    if parts:
        yield parts, langs, ids


class Runs:
    """Words of a block, with fingerprints and checks of its runs of words."""

    def __init__(self, parts: list[bytes], langs: list[str], polys: tuple[Prefixes, ...]):
        self.block = b"\n".join(parts)
        chars = np.frombuffer(self.block, np.uint8)
        blank = np.concatenate([[True], (chars == 0x20) | (chars == 0x0A), [True]])
        self.start = np.flatnonzero(~blank[1:-1] & blank[:-2])
        self.end = np.flatnonzero(~blank[1:-1] & blank[2:]) + 1
        begins = np.cumsum([0] + [len(x) + 1 for x in parts[:-1]])
        self.text = np.searchsorted(begins, self.start, side="right") - 1
        self.piece = np.cumsum(chars == 0x0A)[self.start] if len(self.start) else np.empty(0, np.int64)
        values = chars.astype(np.uint64) + np.uint64(1)
        words = [p.parts(p.of(values), self.start, self.end) for p in polys[:2]]
        self._polys = polys[2:]
        self._prefixes = [p.of(w) for p, w in zip(self._polys, words)]
        self._lang = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], np.uint64)[self.text]

    def _hashes(self, which: int, n: int) -> np.ndarray:
        last = max(0, len(self.text) - n + 1)
        return self._polys[which].parts(self._prefixes[which], slice(0, last), slice(n, n + last))

    def fingerprints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, whether it is one) of the run of ``n`` words at each word that has
        ``n - 1`` words after it."""
        h = self._hashes(0, n)
        return mixed((h ^ self._lang[:len(h)]) + np.uint64(n)), self.piece[:len(h)] == self.piece[n - 1:n - 1 + len(h)]

    def checks(self, n: int, at: np.ndarray) -> np.ndarray:
        return self._hashes(1, n)[at] >> np.uint64(64 - CHECK_BITS)

    def phrase(self, at: int, n: int) -> bytes:
        return b" ".join(self.block[self.start[at]:self.end[at + n - 1]].split())


def _polys() -> tuple[Prefixes, ...]:
    return tuple(map(Prefixes, BASES))


def _docs(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, body, id0)."""
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), body.alias("body"),
                       F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).alias("id0"))


Table = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]       # fingerprints, counts, least document, sum of checks
NONE: Table = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))


def _summed(tables: list[Table]) -> Table:
    """One row per fingerprint, in order; one column at a time, to hold little at once."""
    fp = np.concatenate([t[0] for t in tables])
    if not len(fp):
        return NONE
    order = np.argsort(fp)
    fp = fp[order]
    new = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
    fp = fp[new]
    return fp, *(how.reduceat(np.concatenate([t[k] for t in tables])[order], new) for k, how in ((1, np.add), (2, np.minimum), (3, np.add)))


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers as eight rows of bytes: the high ones are zeros, which compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _passes(bits: np.ndarray, fp: np.ndarray) -> np.ndarray:
    slot = fp >> np.uint64(64 - FILTER_BITS)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _candidates(runs: Runs, n: int, part: int, bits: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, whether to count them) of the runs of ``n`` words whose runs of ``part``
    words all pass the filter."""
    fp, ok = runs.fingerprints(n)
    if bits is not None:
        short, there = runs.fingerprints(part)
        there &= _passes(bits, short)
        for j in range(n - part + 1):
            ok &= there[j:j + len(ok)]
    return fp, ok


def _count_blocks(docs: DataFrame, sizes: tuple[int, ...], part: int, bits: bytes | None, chunks: int) -> DataFrame:
    """(chunk, lang, words, fp, n, doc, check): packed columns of each task's fingerprints in a
    range; with a language in ``lang`` the number of its words."""
    schema = pa.schema([("chunk", pa.int32()), ("lang", pa.string()), ("words", pa.int64()), *((c, pa.binary()) for c in ("fp", "n", "doc", "check"))])

    def told(table: Table) -> Iterator[pa.RecordBatch]:
        fp = table[0]
        chunk = ((fp >> np.uint64(40)) * np.uint64(chunks) >> np.uint64(24)).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, [len(fp)]]).tolist() if len(fp) else [0]
        for a, b in zip(cuts, cuts[1:]):
            gaps = fp[a:b].copy()
            gaps[1:] -= fp[a:b - 1]
            columns = [_packed(gaps), *(_packed(x[a:b]) for x in table[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((int(chunk[a]), None, None, *columns), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if bits is None else np.frombuffer(bits, np.uint8)
        polys, words, held = _polys(), {}, [NONE]
        for parts, langs, ids in _blocks(batches):
            runs = Runs(parts, langs, polys)
            for lang, k in zip(langs, np.bincount(runs.text, minlength=len(langs)).tolist()):
                words[lang] = words.get(lang, 0) + k
            doc, found = np.array(ids, np.int64), []
            for n in sizes:
                fp, ok = _candidates(runs, n, part, table)
                at = np.flatnonzero(ok)
                found.append((fp[at], np.ones(len(at), np.int64), doc[runs.text[at]], runs.checks(n, at).astype(np.int64)))
            del runs
            held.append(_summed(found))
            if sum(len(t[0]) for t in held) > KEPT:
                held = [_summed(held)]
                if len(held[0][0]) > 2 * KEPT // 3:
                    yield from told(held[0])
                    held = [NONE]
        yield from told(_summed(held))
        for lang, k in words.items():
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((-1, lang, k, None, None, None, None), schema)], schema=schema)
    return docs.mapInArrow(run, "chunk int, lang string, words long, fp binary, n binary, doc binary, check binary")


def _frequent(docs: DataFrame, sizes: tuple[int, ...], part: int, bits: bytes | None, min_count: int) -> DataFrame:
    """(lang, fp, n, doc, check) of the frequent fingerprints, stored; rows with a language have
    the number of its words in ``n``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["lang", "fp", "n", "doc", "check"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, held = None, []

        def close() -> pa.RecordBatch:
            fp, n, doc, check = _summed(held)
            keep = n >= min_count
            return pa.RecordBatch.from_arrays([pa.nulls(int(keep.sum()), pa.string()), pa.array(fp[keep].view(np.int64)),
                                               *(pa.array(x[keep]) for x in (n, doc, check))], names)

        for batch in batches:
            for i, chunk in enumerate(batch.column(0).to_pylist()):
                if chunk < 0:
                    yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, 1), pa.nulls(1, pa.int64()), batch.column(2).slice(i, 1),
                                                      pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], names)
                    continue
                if chunk != open_:
                    if held:
                        yield close()
                    open_, held = chunk, []
                fp, n, doc, check = (batch.column(k)[i].as_py() for k in range(3, 7))
                held.append((np.cumsum(_unpacked(fp, np.uint64)), *(_unpacked(x, np.int64) for x in (n, doc, check))))
                if sum(len(t[0]) for t in held) > KEPT:
                    held = [_summed(held)]
        if held:
            yield close()
    blocks = _count_blocks(docs, sizes, part, bits, 4 * parts).repartition(parts, "chunk").sortWithinPartitions("chunk")
    return stored(blocks.mapInArrow(run, "lang string, fp long, n long, doc long, check long"), f"runs-{sizes[-1]}")


def _filter(frequent: DataFrame) -> bytes:
    """One bit for the top bits of each fingerprint: a string of fixed size, whatever the data."""
    slot = F.shiftrightunsigned("fp", 64 - FILTER_BITS) + 1
    parts = (frequent.filter("fp is not null").groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect())
    out, size = bytearray(2 ** FILTER_BITS // 8), 32768 // 8
    for r in parts:
        out[(r.bucket - 1) * size:r.bucket * size] = r.bits
    return bytes(out)


SPELLED = "lang string, fp long, size int, phrase string, own long"


def _spelled(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, fp, size, phrase, own): the phrases of the fingerprints in their documents, ``own`` the
    phrase's check."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polys = _polys()
        wanted: list[np.ndarray] = []

        def noted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 50):
                    part = batch.slice(at, 50)
                    wanted.append(part.column(3).flatten().to_numpy().view(np.uint64))
                    yield part

        for parts, langs, _ in _blocks(noted(batches)):
            runs, keys = Runs(parts, langs, polys), np.unique(np.concatenate(wanted))
            del wanted[:-1]             # the last rows' texts may go on in the next block
            out: list[tuple] = []
            for n in range(1, LONGEST + 1):
                fp, ok = runs.fingerprints(n)
                near = np.minimum(np.searchsorted(keys, fp), len(keys) - 1)
                at = np.flatnonzero(ok & (keys[near] == fp))
                check = runs.checks(n, at)
                # a fingerprint's runs with equal checks are spelled once
                first = np.unique(fp[at] ^ mixed(check), return_index=True)[1]
                out += [(langs[runs.text[i]], int(fp[i].view(np.int64)), n, runs.phrase(i, n).decode(), int(c)) for i, c in zip(at[first].tolist(), check[first].tolist())]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64()))],
                                                 ["lang", "fp", "size", "phrase", "own"])
    places = frequent.groupBy("doc").agg(F.collect_list("fp").alias("fps"))
    return (docs.join(places.hint("shuffle_hash"), docs.id0 == places.doc).select("lang", "body", "id0", "fps")
            .mapInArrow(run, SPELLED).distinct())


def _by_text(docs: DataFrame, fps: DataFrame) -> DataFrame:
    """(lang, phrase, size, f) of all phrases with one of the fingerprints, counted by their texts."""
    bits = _filter(fps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, polys, counts = np.frombuffer(bits, np.uint8), _polys(), {}

        def told() -> pa.RecordBatch:
            keys = list(counts)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((*zip(*keys), list(counts.values())), (
                pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64()))], ["lang", "fp", "size", "phrase", "f"])

        for parts, langs, _ in _blocks(batches):
            runs = Runs(parts, langs, polys)
            for n in range(1, LONGEST + 1):
                fp, ok = runs.fingerprints(n)
                for i in np.flatnonzero(ok & _passes(table, fp)).tolist():
                    key = (langs[runs.text[i]], int(fp[i].view(np.int64)), n, runs.phrase(i, n).decode())
                    counts[key] = counts.get(key, 0) + 1
            if len(counts) > 500_000:
                yield told()
                counts.clear()
        if counts:
            yield told()
    rows = docs.mapInArrow(run, "lang string, fp long, size int, phrase string, f long")
    return rows.join(fps.select("fp"), "fp", "left_semi").groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))


def phrase_counts(docs: DataFrame, min_count: int = 30, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n, f) of all phrases of one to four words that occur ``min_count`` times,
    and (lang, words), the number of words per language; both stored."""
    rows = _docs(docs, id_col, text_col, lang_col)
    short = _frequent(rows, (1, 2), 1, None, min_count)
    three = _frequent(rows, (3,), 2, _filter(short), min_count).filter("fp is not null")
    four = _frequent(rows, (4,), 3, _filter(three), min_count).filter("fp is not null")
    frequent = short.filter("fp is not null").unionAll(three).unionAll(four).drop("lang")
    found = (_spelled(rows, frequent).groupBy("fp").agg(F.count(F.lit(1)).alias("phrases"), F.max(F.struct("lang", "phrase", "size", "own")).alias("p"))
             .filter("phrases = 1"))
    whole = stored(frequent.join(found, "fp", "left").withColumn("right", F.coalesce(F.col("check") == F.col("n") * F.col("p.own"), F.lit(False)))
                   .select("fp", "n", "p.lang", "p.phrase", "p.size", "right"), "verified")
    phrases = whole.filter("right").select("lang", "phrase", "size", F.col("n").alias("f"))
    doubtful = whole.filter("not right").select("fp")
    if doubtful.first() is not None:            # fingerprints that several phrases share
        phrases = phrases.unionByName(_by_text(rows, doubtful).filter(F.col("f") >= min_count))
    words = short.filter("lang is not null").groupBy("lang").agg(F.sum("n").alias("words"))
    return stored(phrases.withColumnRenamed("size", "n"), "phrases"), words


def collocations(docs: DataFrame, top: int = 2000, min_count: int = 30, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the two parts at its worst cut (lowest
    score, then shortest first part), ``n`` the language's words, ``score`` the floor of
    2000000 a / (l + r) in exact arithmetic. Phrases inside a longer candidate that occurs at
    least four fifths as often are left out. Order: score, count (both descending), phrase (its
    bytes); every row of ``docs`` counts, repeated ones too. A null language is ``und``, a null
    text is empty; languages without a candidate and empty tables give no rows. Other columns
    play no part. Long texts are hashed in parts that end at a break; a text without any break
    is one part."""
    phrases, words = phrase_counts(docs, min_count, id_col, text_col, lang_col)
    candidates = phrases.filter("n > 1").select("lang", "phrase", "n", F.col("f").alias("a")).withColumn("w", F.split("phrase", " "))
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, n - 1)"))).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("head"), F.expr("array_join(slice(w, k + 1, n - k), ' ')").alias("tail"))
    head = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tail = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    scored = (cuts.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]).withColumn("score", score)
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inside = (candidates.filter("n > 2").withColumn("m", F.explode(F.expr("sequence(2, n - 1)"))).withColumn("i", F.explode(F.expr("sequence(1, n - m + 1)")))
              .groupBy("lang", F.expr("array_join(slice(w, i, m), ' ')").alias("phrase")).agg(F.max("a").alias("longer")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = (scored.join(inside, ["lang", "phrase"], "left")
            .filter("longer is null or cast(100 as decimal(3,0)) * cast(longer as decimal(19,0)) < cast(80 as decimal(2,0)) * cast(a as decimal(19,0))")
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top))
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
