"""De-duplication and set operations.

``dedup_latest`` keeps one row per key with ``max`` over a struct of the whole row, its order
first: an aggregate with a map-side partial step, so a key repeated in many batches is
combined before the shuffle and never gathers its raw rows in one task. Every column is in the
struct or in the key, once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (e.g. batch_id, then a row id).

    Equivalent to ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC) = 1 with a
    total tie-break; of rows with equal ``order`` the one with the greatest other values. Columns
    must be of types that have an order."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    key_names = [f"__k{i}" for i in range(len(key_cols))]
    in_key = {k: n for k, n in zip(keys, key_names) if isinstance(k, str) and df.schema[k].dataType.typeName() not in ("float", "double")}
    packed_cols = [*order, *[c for c in df.columns if c not in order and c not in in_key]]
    packed = df.select(*[k.alias(n) for k, n in zip(key_cols, key_names)],
                       F.struct(*[F.col(c) for c in packed_cols]).alias("__row"))
    best = packed.groupBy(*key_names).agg(F.max("__row").alias("__row"))
    return best.select(*[(F.col(f"__row.{c}") if c in packed_cols else F.col(in_key[c])).alias(c) for c in df.columns])


def dedup_identical(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key when rows with equal keys are interchangeable."""
    return df.dropDuplicates(list(keys))


def select_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def except_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(col).isin(*values) | F.col(col).isNull())
