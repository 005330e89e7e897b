"""Quoted CSV with line ends inside fields, read by many tasks per file, with row numbers.

Spark's own reader needs a whole file per task for such files. Here the text source splits
files into byte ranges as it likes, and each range hands on what the next ones need:

1. One pass counts, per range, the quotes and the lines that could begin a record: those that
   follow an even number of quotes, and those that follow an odd number, as it is not known yet
   whether the range begins inside a field.
2. A running parity over the ranges of a file says which of both counts holds, a running sum of
   them where the numbering of each range begins. These are one row per range, so a broadcast
   of them is bounded by the input's bytes over the split size (about 40 bytes for 128 MB).
3. A second pass puts the lines of each record together and numbers them. Records that a range
   cuts are sent on in pieces, at most two per range, and joined; nothing else is shuffled.

A record is then parsed by ``from_csv``. Blank lines between records are no records. Lines end
at a newline; a carriage return before the end of a record is no part of it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickstar.frames import materialize

# Functions that run in tasks travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A control character that never occurs in the files: quoted empty fields stay empty text.
NO_NULL_TOKEN = "\u0000"
PARSE = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "nullValue": NO_NULL_TOKEN, "emptyValue": "", "maxCharsPerColumn": "-1"}


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, fid, block): physical lines in the order of the file, within each range."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("fid"), F.col("_metadata.file_block_start").alias("block"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """(fid, block, first line, end) of the stretches of a batch that lie in one range."""
    fid, block = batch.column("fid").to_numpy(), batch.column("block").to_numpy()
    cuts = np.flatnonzero((fid[1:] != fid[:-1]) | (block[1:] != block[:-1])) + 1
    edges = [0, *cuts.tolist(), len(fid)]
    for a, b in zip(edges, edges[1:]):
        if a < b:
            yield int(fid[a]), int(block[a]), a, b


def _quotes(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(quotes, whether it is blank) of each line."""
    quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.binary_length(lines).to_numpy(zero_copy_only=False)
    blank = (size == 0) | pc.equal(lines, "\r").to_numpy(zero_copy_only=False)
    return quotes, blank


def _range_counts(lines: DataFrame) -> DataFrame:
    """(fid, block, quotes, even, odd) per range."""
    names = ["fid", "block", "quotes", "even", "odd"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, [0, 0, 0]

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (*key, *state)], names)

        for batch in batches:
            for fid, block, a, b in _runs(batch):
                if key != (fid, block):
                    if key is not None:
                        yield told()
                    key, state = (fid, block), [0, 0, 0]
                quotes, blank = _quotes(batch.column(0).slice(a, b - a))
                before = state[0] + np.cumsum(quotes) - quotes
                state = [state[0] + int(quotes.sum()), state[1] + int((~blank & (before % 2 == 0)).sum()),
                         state[2] + int((~blank & (before % 2 == 1)).sum())]
        if key is not None:
            yield told()
    return lines.mapInArrow(run, "fid long, block long, quotes long, even long, odd long")


def ranges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(fid, file, block, odd, closed, before, base) per range: whether it begins and whether it ends
    inside a field, the records that begin before it in its file, and the data records of the
    files before (by path)."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file")) \
        .withColumn("fid", F.xxhash64("file"))
    counts = materialize(_range_counts(_lines(spark, path)), "csv-ranges")
    earlier = Window.partitionBy("fid").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    begun = counts.withColumn("inside", odd).withColumn("starts", F.when(F.col("inside"), F.col("odd")).otherwise(F.col("even"))) \
        .withColumn("before", F.coalesce(F.sum("starts").over(earlier), F.lit(0)))
    per_file = begun.groupBy("fid").agg((F.sum("starts") - 1).alias("rows")).join(files, "fid")
    files_before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)       # one row per file
    based = per_file.withColumn("base", F.coalesce(F.sum(F.greatest("rows", F.lit(0))).over(files_before), F.lit(0)))
    return materialize(begun.join(based.select("fid", "file", "base"), "fid").select(
        "fid", "file", "block", F.col("inside").alias("odd"),
        ((F.col("quotes") + F.col("inside").cast("int")) % 2 == 0).alias("closed"), "before", "base"), "csv-starts")


def _pieces(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """(fid, block, n, whole, record): ``n`` counts the records of the file from 1; pieces that
    are not ``whole`` go on in, or come from, another range."""
    names = ["fid", "block", "n", "whole", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        quotes_before = begun = 0           # in the open range; records begun in the file
        held: list[pa.Array] = []           # lines of the open record
        head = False                        # it began in an earlier range

        def rows(records: pa.Array, first: int, whole: bool) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])), pa.array(np.arange(first, first + n)),
                                               pa.array(np.full(n, whole)), records.cast(pa.string())], names)

        def close(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            if held:
                lines_ = pa.concat_arrays(held)
                yield rows(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines_)], pa.int32()), lines_), "\n"), begun, whole and not head)
                held = []

        for batch in batches:
            for fid, block, a, b in _runs(batch):
                if key != (fid, block):
                    yield from close(quotes_before % 2 == 0)
                    inside = bool(batch.column("odd")[a].as_py())
                    key, quotes_before, begun, head = (fid, block), int(inside), int(batch.column("before")[a].as_py()), inside
                lines_ = batch.column(0).slice(a, b - a)
                quotes, blank = _quotes(lines_)
                even = (quotes_before + np.cumsum(quotes) - quotes) % 2 == 0
                quotes_before += int(quotes.sum())
                part = ~(blank & even)
                if not part.all():
                    lines_, even = lines_.filter(pa.array(part)), even[part]
                at = np.flatnonzero(even)
                if not len(at):
                    held.append(lines_)
                    continue
                held.append(lines_.slice(0, int(at[0])))
                if sum(map(len, held)):
                    yield from close(True)
                held, head = [], False
                if len(at) > 1:
                    lists = pa.ListArray.from_arrays(pa.array((at - at[0]).astype(np.int32)), lines_.slice(int(at[0]), int(at[-1] - at[0])))
                    yield rows(pc.binary_join(lists, "\n"), begun + 1, True)
                begun += len(at)
                held = [lines_.slice(int(at[-1]))]
        yield from close(quotes_before % 2 == 0)
    starts = starts.select("fid", "block", "odd", "before")
    return (lines.join(F.broadcast(starts), ["fid", "block"]).select("value", "fid", "block", "odd", "before")     # a row per range, see above
            .mapInArrow(run, "fid long, block long, n long, whole boolean, record string"))


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source_file, source_row, record): the data records of the files below ``path``, in any
    order. ``source_row`` numbers them over all files (by path) from 1; the first record of a
    file is its header. Empty files have no records."""
    lines, starts = _lines(spark, path), ranges(spark, path)
    whole = _pieces(lines, starts).filter("whole").select("fid", "n", "record")
    cut = _pieces(lines, starts.filter("odd or not closed")).filter("not whole")
    joined = cut.groupBy("fid", "n").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "record"))),
                                                                  lambda x: x.record), "\n").alias("record"))
    files = starts.select("fid", "file", "base").distinct()
    both = whole.unionByName(joined.select("fid", "n", "record")).filter("n > 1").join(files, "fid")
    return both.select(F.element_at(F.split("file", "/"), -1).alias("source_file"), (F.col("base") + F.col("n") - 1).alias("source_row"),
                       F.regexp_replace("record", "\r\\z", "").alias("record"))


def csv_table(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """The records as text columns, with ``source_file`` and ``source_row``. Missing fields are
    null, surplus ones are dropped; an unquoted empty field is null, a quoted one empty text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    parsed = csv_records(spark, path).withColumn("fields", F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), PARSE))
    return parsed.select("fields.*", "source_file", "source_row")
