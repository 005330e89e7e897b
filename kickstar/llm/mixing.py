"""Mixing sources to target weights by Poisson replication.

Every source has a target share of the mixture; the mean repetition rate of its documents is
``target share * mixture size / source size``. A document's number of copies is drawn by
inverting the Poisson distribution of that mean at a uniform number hashed from the seed and
the document's identity, so the draw needs no state, is the same on every executor and after
every lost task, and changes only with the seed. Copies are exploded and shuffled globally
by a hash of (seed, document, copy): equal-sized random partitions, random order inside.

The distribution function is built once per source from the rate, as the running sum of the
Poisson terms up to the last double below 1. Rates above ``CHUNK`` are split into equal parts
whose independent draws are added (a sum of Poisson numbers is Poisson), so there is no cap
on the rate.

One aggregate per source (partial sums in each task: a hot source sends one row per task);
its rows are joined back by source, a side that Spark broadcasts only when it is small and
else splits where one source is hot.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickstar.llm.common import let, masked, stored, unmasked, without

CHUNK = 16.0
#: 13 hex digits: 52 bits, exact in a double.
DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts (null as empty), joined by ``:``."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long") / F.lit(float(16 ** DIGITS))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ..., far enough that the rest is below 2**-53 for any rate up
    to ``CHUNK``; the terms are summed from the smallest k."""
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(80)),
        F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("cdf")),
        lambda s, k: F.struct((s.term * rate / k).alias("term"),
                              F.concat(s.cdf, F.array(F.element_at(s.cdf, -1) + s.term * rate / k)).alias("cdf")))
    return step.cdf


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, source_col: str = "source",
          text_col: str = "text", temperature: float = 0.5, mixture: float = 1.0) -> DataFrame:
    """(source, size, rate): size in characters and mean copies of a document.

    ``weights`` are relative target shares by source (a source without one gets 0); without
    them a source's share is its size to the power ``temperature``. ``mixture`` is the size of
    the mixture relative to the input. A null source is a source of its own. Sources of size
    0 have the rate ``mixture``: there is nothing to reach by repeating empty texts."""
    sizes = (docs.groupBy(F.col(source_col).alias("source"))
             .agg(F.sum(F.coalesce(F.char_length(text_col), F.lit(0)).cast("long")).alias("size")))
    if weights is None:
        share = F.pow(F.col("size").cast("double"), F.lit(float(temperature)))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        share = F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0))
    sizes = sizes.withColumn("share", F.when(F.col("size") > 0, share).otherwise(0.0))
    total = sizes.agg(F.sum("size").alias("all"), F.sum("share").alias("shares"))    # one row
    rate = F.col("share") / F.col("shares") * F.col("all") * F.lit(float(mixture)) / F.col("size")
    return (sizes.crossJoin(F.broadcast(total))
            .select("source", "size", F.when((F.col("size") > 0) & (F.col("shares") > 0), rate)
                    .when(F.col("size") > 0, F.lit(0.0)).otherwise(F.lit(float(mixture))).alias("rate")))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, seed: int = 17, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text", temperature: float = 0.5, mixture: float = 1.0,
        partitions: int | None = None) -> DataFrame:
    """Every document repeated by its drawn count, in a globally shuffled order, with
    ``copy`` (0, 1, ...) and ``shuffle_key`` added; columns of ``docs`` with those names are
    replaced.

    The identity of a document is its id and the md5 of its text, so rows with a null id are
    drawn by their texts, and fully repeated rows get the same number of copies each. Null
    texts have size 0. An empty table gives an empty mixture."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d, names = masked(without(docs, ("copy", "shuffle_key"), (id_col, source_col, text_col)))
    id_col, source_col, text_col = names[id_col], names[source_col], names[text_col]
    # one row per source, written first: its size is known, so that few sources are broadcast
    # and the texts are shuffled once, by the shuffle key
    plan = (stored(rates(d, weights, source_col, text_col, temperature, mixture), "rates").filter("rate > 0")
            .withColumn("__parts", F.ceil(F.col("rate") / F.lit(CHUNK)).cast("int"))
            .select(F.col("source").alias("__source"), "__parts", poisson_cdf(F.col("rate") / F.col("__parts")).alias("__cdf")))
    who = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    def draw(j: Column) -> Column:
        return let(uniform(F.lit(seed), F.col("__who"), j), lambda u: F.size(F.filter("__cdf", lambda c: c <= u)))

    drawn = (d.withColumn("__who", who).join(plan, F.col(source_col).eqNullSafe(F.col("__source")), "inner")
             .withColumn("__n", F.aggregate(F.sequence(F.lit(1), F.col("__parts")), F.lit(0), lambda t, j: t + draw(j)).cast("long")))
    copies = (drawn.filter("__n > 0").select(*names.values(), "__who",
                                            F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)).alias("copy"))
              .withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), "__who", "copy"))).drop("__who"))
    return copies.repartition(n, "shuffle_key").sortWithinPartitions("shuffle_key").select(*unmasked(names), "copy", "shuffle_key")
