"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item (the whole item if it is
shorter). A document word is hit if it stands inside an occurrence of a window.

1. Windows are made distinct by content; each is a set of word shingles.
2. Every document is read once; its shingles that occur in any window give postings
   (document, position, shingle).
3. Shingles are ordered by rarity: their number of postings in the corpus. A window can only
   occur where all its shingles do, so the prefix that must be joined is one shingle, its
   rarest; postings of other shingles are dropped.
4. A posting of the prefix shingle fixes where its window would begin; places before the
   text's begin or with too few words left are dropped (positional and length bounds).
5. The remaining places are verified word by word in their document, and the union of the
   verified intervals is counted.

Joins are on shingles, window numbers and documents; a side is broadcast only where Spark
knows it to be below its threshold, a hot shingle is split by adaptive execution. Groups are
bounded by one document's words. Texts meet only their own places and results, and are not
shuffled at all where those are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickstar.llm.common import fraction, let, masked, stored, unmasked, without, words


def _shingles(w: str, lengths: list[int]) -> Column:
    """(h, at, k) of all runs of k words, k in ``lengths``, as an array; ``at`` counts from 0."""
    def runs_of(k: int) -> Column:
        run = lambda i: F.struct(F.xxhash64(F.lit(k), *[F.try_element_at(w, i + j) for j in range(k)]).alias("h"),
                                 (i - 1).alias("at"))
        return (F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(1))), run))
                .otherwise(F.array().cast("array<struct<h:bigint,at:int>>")))

    runs = [runs_of(k) for k in lengths]
    return runs[0] if len(runs) == 1 else F.concat(*runs)


def windows(benchmark: DataFrame, window: int = 13, shingle: int = 5, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(win, item, m, k): the words of every window with its item (as text; null: empty), its
    number of words and its shingle length. Items without words have none."""
    w = F.col("w")
    items = (benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w"))
             .filter(F.size("w") > 0).withColumn("m", F.least(F.size(w), F.lit(window))))
    return (items.withColumn("at", F.explode(F.sequence(F.lit(1), F.size(w) - F.col("m") + 1)))
            .select("item", F.slice(w, F.col("at"), F.col("m")).alias("win"), "m", F.least(F.col("m"), F.lit(shingle)).alias("k"))
            .distinct())


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, shingle: int = 5, share: float = 0.05,
                 id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with n_words, n_hit, n_items, items (sorted item ids, as text)
    and contaminated (``n_hit > 0`` and at least ``share`` of the words are hit).

    Columns of ``docs`` with those names are replaced. A null or empty text has no words and
    is never contaminated; rows with a null id and repeated rows are judged each on its own
    text; an empty benchmark hits nothing, an empty document table gives no rows. Very long texts
    are judged whole. Several items with one id count once."""
    spark = docs.sparkSession
    new = ("n_words", "n_hit", "n_items", "items", "contaminated")
    rows, names = masked(without(docs, new, (id_col, text_col)))
    id_col, text_col = names[id_col], names[text_col]
    rows = rows.withColumns({"__id": F.col(id_col), "__h": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})

    same = F.col("__id").eqNullSafe(F.col("__pid")) & (F.col("__h") == F.col("__ph"))
    member = stored(windows(benchmark, window, shingle, item_id_col, item_text_col), "windows")
    lengths = sorted(r.k for r in member.select("k").distinct().collect()) or [shingle]      # at most `shingle` numbers
    win = stored(member.select("win", "m", "k").distinct().select(F.monotonically_increasing_id().alias("wid"), "win", "m", "k"), "win")
    one = win.select("wid", "m", "win", "k", F.explode(_shingles("win", lengths)).alias("s")) \
        .select("wid", "m", F.col("s.h").alias("h"), F.col("s.at").alias("off"))
    wanted = stored(one.select("h").distinct(), "shingles")

    # step 2: one pass over the texts
    postings = stored(rows.select("__id", "__h", words(F.col(text_col)).alias("w"))
                      .select("__id", "__h", F.size("w").alias("n"), F.explode(_shingles("w", lengths)).alias("s"))
                      .select("__id", "__h", "n", F.col("s.h").alias("h"), F.col("s.at").alias("at"))
                      .join(wanted, "h"), "postings")
    # step 3: rarity in the corpus, counted over all postings
    rarity = postings.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    prefix = stored(one.join(rarity, "h")                       # a window with an absent shingle occurs nowhere
                    .join(one.groupBy("wid").agg(F.count(F.lit(1)).alias("need")), "wid")
                    .groupBy("wid", "m", "need").agg(F.min(F.struct("df", "h", "off")).alias("p"), F.count(F.lit(1)).alias("have"))
                    .filter("have = need").select("wid", "m", F.col("p.h").alias("h"), F.col("p.off").alias("off"))
                    .join(win.select("wid", "win"), "wid"), "prefix")
    # step 4
    places = stored(postings.join(prefix, "h").withColumn("start", F.col("at") - F.col("off"))
                    .filter((F.col("start") >= 0) & (F.col("start") + F.col("m") <= F.col("n")))
                    .groupBy("__id", "__h").agg(F.collect_set(F.struct("start", "m", "wid", "win")).alias("places")), "places")
    # step 5: texts meet their places as they are and are split after that
    verified = stored(rows.select("__id", "__h", F.col(text_col).alias("text"))
                      .join(places.withColumnsRenamed({"__id": "__pid", "__h": "__ph"}), same).drop("__pid", "__ph")
                      .withColumn("hits", let(words(F.col("text")), lambda w: F.array_sort(F.filter(
                          "places", lambda p: F.slice(w, p.start + 1, p.m) == p.win))))
                      .filter(F.size("hits") > 0)
                      .select("__id", "__h", F.aggregate("hits", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda s, p: F.struct(
                          F.greatest(s.end, p.start + p.m).alias("end"),
                          (s.n + F.greatest(F.lit(0), p.start + p.m - F.greatest(s.end, p.start))).alias("n"))).n.cast("long").alias("n_hit"),
                          F.array_distinct(F.transform("hits", lambda p: p.wid)).alias("wids"))
                      .dropDuplicates(["__id", "__h"]), "verified")
    found = (verified.withColumn("wid", F.explode("wids")).join(win.select("wid", "win"), "wid")
             .join(member.select("win", "item"), "win").groupBy("__id", "__h", "n_hit")
             .agg(F.sort_array(F.collect_set("item")).alias("items")).withColumnsRenamed({"__id": "__pid", "__h": "__ph"}))
    p, q = fraction(share)
    return (rows.withColumn("n_words", F.size(words(F.col(text_col))).cast("long")).join(found, same, "left")
            .withColumns({"items": F.coalesce("items", F.array().cast("array<string>")), "n_hit": F.coalesce("n_hit", F.lit(0))})
            .withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * q >= F.col("n_words") * p))
            .select(*unmasked(names), *new))
