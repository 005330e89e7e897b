"""Surrogate keys, global positions and ranks without a single-partition window.

One pass: the rows are range-partitioned and sorted on the (total) order and written once to
the shared checkpoint folder together with ``monotonically_increasing_id``, which holds the
partition and the position inside it. Everything else reads that copy: rows per partition
(one row per partition, so the offsets are bounded by the partition count) give each
partition's offset, and position = offset + local position. Positions and offsets can never
come from two different samplings of the ranges, whatever the optimizer reuses, and a
recomputed task after an executor loss reads the same files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


#: ``monotonically_increasing_id`` keeps the position inside a partition in its low 33 bits.
_LOCAL_BITS = 33


def _ranged(df: DataFrame, order: list[Column], partitions: int | None, label: str) -> DataFrame:
    """``df`` range-partitioned and sorted on ``order``, written once, with ``__pid`` and
    ``__lpos`` (1-based position inside the partition)."""
    from kickstar.frames import materialize
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__mid", F.monotonically_increasing_id())
    mid = F.col("__mid")
    return (materialize(rows, label)
            .withColumns({"__pid": F.shiftright(mid, _LOCAL_BITS), "__lpos": mid.bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)) + 1})
            .drop("__mid"))


def _before(per_part: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Running sums over the partitions before each one (one row per partition)."""
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("__pid", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(name) for c, name in sums.items()])


def global_positions(df: DataFrame, order: Sequence[Column | str], name: str = "pos",
                     partitions: int | None = None) -> DataFrame:
    """1-based position of every row in ``order`` (which must be a total order). The input is
    read once: numbering, counts and result all use the written copy."""
    ranged = _ranged(df, _cols(order), partitions, "positions")
    offsets = _before(ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt")), {"__cnt": "__off"})
    # one row per partition: bounded by the partition count
    return (ranged.join(F.broadcast(offsets), "__pid")
            .withColumn(name, (F.col("__off") + F.col("__lpos")).cast("long"))
            .drop("__pid", "__lpos", "__off"))


def surrogate_key(df: DataFrame, order: Sequence[Column | str], name: str, start_after: Column | int = 0) -> DataFrame:
    """IDENTITY-style keys: current max + position in ``order``."""
    pos = global_positions(df, order, "__pos")
    base = F.lit(start_after) if isinstance(start_after, int) else start_after
    return pos.withColumn(name, (base + F.col("__pos")).cast("long")).drop("__pos")


def next_key_base(dim: DataFrame, key: str) -> Column:
    """Scalar ``max(key)`` (ignoring special negative members) as a Column via a 1-row join."""
    return F.coalesce(F.max(F.when(F.col(key) > 0, F.col(key))), F.lit(0))


def global_rank(df: DataFrame, keys: Sequence[str], name: str, ascending: Sequence[bool] | None = None,
                dense: bool = False, partitions: int | None = None) -> DataFrame:
    """RANK (or DENSE_RANK) over a whole table without a single-partition window.

    1. Rows are counted per distinct tuple of ``keys`` (partial aggregation: a tuple
       shared by a third of all rows reaches the shuffle as one row per task).
    2. The distinct tuples are range-partitioned, sorted and written once; inside a
       partition each tuple learns the rows ahead of it (running sum of counts) and its
       tuple position; one row per partition, from the same copy, gives the offsets.
    3. rank = rows ahead + 1, dense rank = tuples ahead + 1; the rows get their rank back
       through a null-safe equi-join on the tuple (AQE splits a hot tuple's side).
    """
    keys = list(keys)
    asc = list(ascending) if ascending is not None else [True] * len(keys)
    oc = [F.col(k).asc() if a else F.col(k).desc() for k, a in zip(keys, asc)]
    tuples = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt"))
    ranged = _ranged(tuples, oc, partitions, "ranks")
    ahead = Window.partitionBy("__pid").orderBy("__lpos").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("__before", F.coalesce(F.sum("__cnt").over(ahead), F.lit(0)))
    offsets = _before(ranged.groupBy("__pid").agg(F.sum("__cnt").alias("__rows"), F.count(F.lit(1)).alias("__tuples")),
                      {"__rows": "__roff", "__tuples": "__toff"})
    value = (F.col("__toff") + F.col("__lpos")) if dense else (F.col("__roff") + F.col("__before") + 1)
    ranks = local.join(F.broadcast(offsets), "__pid").select(
        *[F.col(k).alias(f"__rk{i}") for i, k in enumerate(keys)], value.cast("long").alias(name))
    cond = [df[k].eqNullSafe(ranks[f"__rk{i}"]) for i, k in enumerate(keys)]
    return df.join(ranks, cond, "inner").drop(*[f"__rk{i}" for i in range(len(keys))])
