"""Ranking, top-n, running and share windows.

Scale rules
-----------
* Top-n is ``orderBy().limit()`` → TakeOrderedAndProject: each task keeps its own
  top n, the driver merges n × tasks rows. Every ordering ends in a total
  tie-break so the result is deterministic.
* Per-group top-n uses a partitioned ``row_number``/``dense_rank`` whose filter
  Spark turns into a WindowGroupLimit (rows beyond n are dropped before the sort
  finishes). Inputs are aggregated first, so a partition is one group's members.
* Ranks and NTILE over a whole table never use an un-partitioned window over the
  whole table: a top-n's ranks are computed on the n kept rows (every row ahead of
  a kept row is kept too), and full positions come from the range-partitioned
  one-pass numbering in ``operators.keys``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kickstar.operators import keys as K


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def top_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """TOP n … ORDER BY; ``order`` must be total (end it with a key)."""
    return df.orderBy(*_cols(order)).limit(n)


def rank_within(df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], name: str,
                kind: str = "dense_rank") -> DataFrame:
    fn = {"dense_rank": F.dense_rank, "rank": F.rank, "row_number": F.row_number}[kind]
    w = Window.partitionBy(*partition).orderBy(*_cols(order))
    return df.withColumn(name, fn().over(w))


def top_per_group(df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], n: int,
                  name: str = "rank", kind: str = "dense_rank") -> DataFrame:
    """Keep rank <= n inside each group (GENERATE(TOPCOUNT) / DENSE_RANK <= n)."""
    return rank_within(df, partition, order, name, kind).filter(F.col(name) <= n)


def top_n_ranked(df: DataFrame, n: int, order: Sequence[Column | str], rank_order: Sequence[Column | str],
                 name: str, kind: str = "rank", position: str | None = None) -> DataFrame:
    """TOP n rows plus their RANK / DENSE_RANK over the whole table.

    Every row ahead of a top-n row is itself in the top n, so the rank computed over
    the n kept rows equals the rank over the whole table: the window runs on n rows
    only, after the distributed TakeOrderedAndProject.
    """
    top = top_n(df, n, order)
    fn = {"dense_rank": F.dense_rank, "rank": F.rank}[kind]
    out = top.withColumn(name, fn().over(Window.orderBy(*_cols(rank_order))))
    if position:
        out = out.withColumn(position, F.row_number().over(Window.orderBy(*_cols(order))))
    return out


def ntile_of_position(pos: Column, total: Column, buckets: int) -> Column:
    """NTILE(b) from a 1-based position and the row count: the first n % b groups get one more row."""
    size = F.floor(total / buckets)
    rem = total - size * buckets
    big = rem * (size + 1)
    return F.when(pos <= big, F.floor((pos - 1) / (size + 1)) + 1) \
        .otherwise(rem + F.floor((pos - 1 - big) / size) + 1).cast("int")


def with_ntile(df: DataFrame, order: Sequence[Column | str], buckets: int, name: str) -> DataFrame:
    """NTILE over a whole table without a single-partition window: the positions come from one
    written copy of the rows, and the row count is the largest position of that copy."""
    positioned = K.global_positions(df, order, "__pos")
    total = positioned.agg(F.max("__pos").alias("__n"))
    return (positioned.crossJoin(F.broadcast(total))
            .withColumn(name, ntile_of_position(F.col("__pos"), F.col("__n"), buckets))
            .drop("__pos", "__n"))


def running(df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], value: str,
            name: str, frame: tuple[int, int] | None = None, fn=F.sum) -> DataFrame:
    """Running aggregate; ``frame`` = (start, end) rows, default unbounded preceding..current."""
    w = Window.partitionBy(*partition).orderBy(*_cols(order))
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if frame is None else w.rowsBetween(*frame)
    return df.withColumn(name, fn(value).over(w))


def share_of_partition(df: DataFrame, value: str, partition: Sequence[str], name: str,
                       scale: float = 100.0) -> DataFrame:
    """value / SUM(value) OVER (PARTITION BY …) via a grouped total joined back (skew-safe)."""
    if partition:
        totals = df.groupBy(*partition).agg(F.sum(value).alias("__tot"))
        out = df.join(totals, list(partition), "left")
    else:
        out = df.crossJoin(F.broadcast(df.agg(F.sum(value).alias("__tot"))))
    return out.withColumn(name, F.try_divide(F.col(value).cast("double") * F.lit(scale),
                                             F.col("__tot").cast("double"))).drop("__tot")


def member_spine(facts: DataFrame, member_keys: Sequence[str], level: str) -> DataFrame:
    """Every level value between each member's first and last period — a dense spine for
    MDX-style neighbours (a gap season still occupies a period). Bounded by the span of
    the level (seasons), generated per member with ``sequence`` rather than a join."""
    span = facts.groupBy(*member_keys).agg(F.min(level).alias("__lo"), F.max(level).alias("__hi"))
    return span.select(*member_keys, F.explode(F.sequence("__lo", "__hi")).alias(level))
