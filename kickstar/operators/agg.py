"""Aggregation operators: grouped measures, grouping sets with labels, pivots,
semi-additive measures.

All of them are ``groupBy``-family plans: Spark runs a partial (map-side)
aggregate before the shuffle, so a hot key sends one partial row per task, not its
raw rows. Distinct counts are exact (``count_distinct``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_agg(df: DataFrame, keys: Sequence[str | Column], aggs: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def count_rows() -> Column:
    return F.count(F.lit(1))


def conditional_sum(cond: Column, value: Column | int = 1) -> Column:
    v = value if isinstance(value, Column) else F.lit(value)
    return F.sum(F.when(cond, v).otherwise(F.lit(0)))


def ratio_of_sums(num: Column, den: Column, scale: float = 1.0) -> Column:
    """Ratio recomputed from sums at the asked level; a zero denominator gives NULL."""
    n = num.cast("double")
    if scale != 1.0:
        n = n * F.lit(float(scale))
    return F.try_divide(n, den.cast("double"))


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], columns: Sequence[str],
                  aggs: dict[str, Column]) -> DataFrame:
    """GROUP BY GROUPING SETS (…): one Expand + one aggregate pass over the input."""
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        *[c.alias(n) for n, c in aggs.items()])


def labelled_total(col: str, label: str) -> Column:
    """The column, or ``label`` on rows where it is rolled up (a real NULL stays NULL)."""
    return F.when(F.grouping(col) == 1, F.lit(label)).otherwise(F.col(col))


def pivot_sum(df: DataFrame, rows: Sequence[str], pivot_col: str, values: Sequence, measure: str) -> DataFrame:
    """Rows to columns; the pivot values are given so no extra distinct pass runs."""
    return df.groupBy(*rows).pivot(pivot_col, list(values)).agg(F.sum(measure))


def last_non_empty(df: DataFrame, slice_keys: Sequence[str], date_col: str, value: str, name: str) -> DataFrame:
    """Semi-additive LastNonEmpty: per slice, the sum of the rows dated on the slice's
    last date with data. Two aggregates joined on the slice keys (no window)."""
    last = df.groupBy(*slice_keys).agg(F.max(date_col).alias("__last"))
    on_last = df.join(last, list(slice_keys)).filter(F.col(date_col) == F.col("__last"))
    return on_last.groupBy(*slice_keys).agg(F.sum(value).alias(name))


def squad_value(df: DataFrame, group_keys: Sequence[str], member_key: str, date_col: str, value: str,
                name: str) -> DataFrame:
    """Per (group, member) the value on the member's last date, then summed per group.

    ``max_by`` is a partial aggregate, so members with many dates are combined
    map-side before the shuffle."""
    last = df.groupBy(*group_keys, member_key).agg(F.max_by(value, F.col(date_col)).alias("__v"))
    return last.groupBy(*group_keys).agg(F.sum("__v").alias(name))
