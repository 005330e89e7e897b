"""Line deduplication over a suffix order of line numbers, by prefix doubling.

The corpus is one sequence of lines, documents in the order of their ids; lines without a
word do not take part. A run of lines is removed where it repeats a run that begins earlier
in the corpus, if it has at least ``min_words`` words. The windows are the shortest such runs
that begin at each line and the shortest that end at each line: the last window that begins in
a maximal repeated run may end before it does, but the shortest that ends with the run begins
there too, so both kinds together cover the run to its last line.

1. Lines get numbers in the order of their hashes; lines that occur once cannot be part of a
   repeated run and cut the sequences into stretches. Stretches of fewer than ``min_words``
   words go at once.
2. Prefix doubling: the rank of a position for 2^(k+1) lines is the order number of the pair
   (rank for 2^k lines here, rank for 2^k lines 2^k further on). Pairs are counted in each
   task before they are sorted; a pair that occurs once ends all windows that need it. As a
   line has a word at least, windows of both kinds have at most ``min_words`` lines, and
   doubling ends after log2(min_words) rounds, whatever the data.
3. A window of m lines is the pair of its overlapping powers of two: (m, rank of its first
   2^k lines, rank of its last 2^k lines), 2^k <= m. Positions with equal windows are
   neighbours in the suffix order, an interval with a common prefix of m lines or more; its
   smallest position is the original, all others are later copies.
4. The lines that later copies cover are removed, one list of line numbers per document
   joined back to its text.

Windows of Spark are per document (its lines), counts are per line or pair with partial
aggregates, and the joins on pairs are split by adaptive execution when a passage is hot.
Only hashes and numbers are shuffled, no texts but in the last join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kickstar.llm.common import masked, space_words, stored, unmasked, without

HAS_WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _numbered(df: DataFrame, keys: list[str], name: str, label: str) -> DataFrame:
    """``df`` with increasing numbers in the order of ``keys`` (not consecutive), stored."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id()), label)


def _pairs(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Order numbers (``order``) of the key tuples that occur twice or more."""
    return _numbered(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times"), keys, "order", label)


def _corpus(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, __id, __h, lines): the documents that have a line with a word, numbered in the
    order of id and text hash; lines as (i: number in the text, a, b: hashes, w: words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__h"), F.transform(
        F.filter(F.transform(_lines(F.col(text_col)), lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: s.x.rlike(HAS_WORD)),
        lambda s: F.struct(s.i.alias("i"), F.xxhash64(s.x).alias("a"), F.xxhash64(F.lit(1), s.x).alias("b"),
                           F.size(space_words(s.x)).alias("w"))).alias("lines"))
    return _numbered(rows.filter("size(lines) > 0").dropDuplicates(["__id", "__h"]), ["__id", "__h"], "doc", "corpus")


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc, seq, i, lo, hi, rank) of the lines in stretches of repeated lines with ``min_words``
    words; the windows that begin here have ``lo`` to ``hi`` lines: ``lo`` reach the words
    (null if the stretch ends before), and any more are windows of their last line as long as
    the lines after this one do not reach the words alone."""
    ranked = lines.join(_pairs(lines, ["a", "b"], "line-ids"), ["a", "b"]).withColumnRenamed("order", "rank")
    runs = ranked.withColumn("run", F.col("seq") - F.row_number().over(Window.partitionBy("doc").orderBy("seq")))
    of_run = Window.partitionBy("doc", "run")
    stretch = (runs.withColumn("upto", F.sum("w").over(of_run.orderBy("seq"))).withColumn("all", F.sum("w").over(of_run))
               .filter(F.col("all") >= min_words))
    ahead = of_run.orderBy("seq").rowsBetween(0, min_words - 1)       # every line has a word, so more are not needed
    lo = F.expr(f"nullif(array_position(transform(sums, x -> x - upto + w >= {int(min_words)}), true), 0)").cast("int")
    return (stretch.withColumn("sums", F.collect_list("upto").over(ahead)).withColumn("lo", lo)
            .withColumn("hi", F.greatest("lo", F.expr(f"size(filter(sums, x -> x - upto < {int(min_words)}))")))
            .select("doc", "seq", "i", "lo", "hi", "rank"))


def later_copies(lines: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """Windows (doc, seq, m) that repeat an earlier one, and the lines of all stretches."""
    level = stretches = stored(_windows(lines, min_words), "rank1")
    copies, k = None, 1
    while True:
        # windows of k .. 2k-1 lines: an interval of the suffix order is (m, rank of the first
        # k lines, rank of the last k lines)
        tail = level.select("doc", F.col("seq").alias("tail"), F.col("rank").alias("last"))
        ready = (level.filter((F.col("hi") >= k) & (F.col("lo") < 2 * k))
                 .withColumn("m", F.explode(F.sequence(F.greatest("lo", F.lit(k)), F.least("hi", F.lit(2 * k - 1)))))
                 .withColumn("tail", F.col("seq") + F.col("m") - k).join(tail, ["doc", "tail"]).select("doc", "seq", "m", "rank", "last"))
        interval = (ready.groupBy("m", "rank", "last").agg(F.min(F.struct("doc", "seq")).alias("first"), F.count(F.lit(1)).alias("times"))
                    .filter("times > 1"))
        later = (ready.join(interval, ["m", "rank", "last"]).filter(F.struct("doc", "seq") > F.col("first")).select("doc", "seq", "m"))
        copies = later if copies is None else copies.unionAll(later)
        if 2 * k > min_words:
            return copies, stretches
        order = Window.partitionBy("doc").orderBy("seq")
        pair = (level.withColumn("next", F.lead("rank", k).over(order)).withColumn("there", F.lead("seq", k).over(order))
                .filter(F.col("there") == F.col("seq") + k).select("doc", "seq", "lo", "hi", "rank", "next"))
        level = stored(pair.join(_pairs(pair, ["rank", "next"], f"pairs{2 * k}"), ["rank", "next"])
                       .select("doc", "seq", "lo", "hi", F.col("order").alias("rank")), f"rank{2 * k}")
        k *= 2


def dedup_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with later copies of repeated line runs removed from its text,
    and ``n_lines`` and ``n_removed`` added (columns of those names are replaced).

    Lines are the parts between newlines; lines without a word are never removed. Earlier
    means: smaller id (null first), then text hash, then line number. Rows with equal id and
    equal text are one document and get the same text. A null text has one empty line and
    stays null. An empty table gives an empty result."""
    rows, names = masked(without(docs, ("n_lines", "n_removed"), (id_col, text_col)))
    id_col, text_col = names[id_col], names[text_col]
    corpus = _corpus(rows, id_col, text_col)
    lines = corpus.select("doc", F.posexplode("lines").alias("seq", "l")).select("doc", "seq", "l.i", "l.w", "l.a", "l.b")
    copies, stretches = later_copies(lines, min_words)
    gone = (copies.withColumn("seq", F.explode(F.expr("sequence(seq, seq + m - 1)"))).select("doc", "seq").distinct()
            .join(stretches.select("doc", "seq", "i"), ["doc", "seq"]).groupBy("doc").agg(F.collect_list("i").alias("__gone"))
            .join(corpus.select("doc", F.col("__id").alias("__gid"), F.col("__h").alias("__gh")), "doc").drop("doc"))
    key = rows.withColumn("__h", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    out = key.join(gone, F.col(id_col).eqNullSafe(F.col("__gid")) & (F.col("__h") == F.col("__gh")), "left") \
        .withColumn("__lines", _lines(F.col(text_col)))
    left = F.expr("array_except(sequence(0, size(__lines) - 1), __gone)")
    return (out.withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(
                F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n")))
            .withColumns({"n_lines": F.size("__lines").cast("long"), "n_removed": F.coalesce(F.size("__gone"), F.lit(0)).cast("long")})
            .withColumn("n_removed", F.greatest("n_removed", F.lit(0)).cast("long"))
            .select(*unmasked(names), "n_lines", "n_removed"))
