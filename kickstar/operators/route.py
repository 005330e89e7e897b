"""Reject routing: cast-or-reject, ordered validation, load-window filter.

One pass tags every row with a route; the valid stream and the reject stream are two
filters over that tagged DataFrame (persisted by the caller when both are written). The load
window is a filter of its own on the valid stream, so the optimizer can move it down to the
source; rejects are not bound to the window. :func:`rejected` gives the cast errors and the
broken rules of a load in one pass.
Rejects share one schema: batch_id, source_table, natural_key, reason, rejected_at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECT_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("source_table", T.StringType()),
    T.StructField("natural_key", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("rejected_at", T.TimestampType()),
])

REASON = "__reason"


def _typed(df: DataFrame, casts: dict[str, str], prefix: str) -> tuple[DataFrame, Column]:
    """The rows with ``prefix + column`` typed, and whether a value that is present does not cast."""
    failed = F.lit(False)
    for c in casts:
        failed = failed | (F.col(c).isNotNull() & F.col(prefix + c).isNull())
    return df.withColumns({prefix + c: F.col(c).try_cast(t) for c, t in casts.items()}), failed


def _first_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """The reason of the first rule that holds, else null."""
    reason = None
    for cond, why in rules:
        reason = F.when(cond, F.lit(why)) if reason is None else reason.when(cond, F.lit(why))
    return reason if reason is not None else F.lit(None).cast("string")


def cast_or_reject(df: DataFrame, casts: dict[str, str], reason: str = "cast error",
                   prefix: str = "c_") -> tuple[DataFrame, DataFrame]:
    """Cast text columns with ``try_cast``; a row whose raw value is present but does not
    cast goes to the reject stream, the rest continue with ``prefix + column`` typed."""
    typed, failed = _typed(df, casts, prefix)
    return typed.filter(~failed), typed.filter(failed).withColumn(REASON, F.lit(reason))


def validate_or_reject(df: DataFrame, rules: Sequence[tuple[Column, str]], window: Column | None = None
                       ) -> tuple[DataFrame, DataFrame]:
    """Ordered split: the first failing rule names the reject reason; rows outside the load
    window are skipped silently; everything else (a row without a date too) is valid."""
    reason = _first_reason(rules)
    valid = df.filter(reason.isNull())
    if window is not None:
        valid = valid.filter(F.coalesce(window, F.lit(True)))
    return valid, df.withColumn(REASON, reason).filter(F.col(REASON).isNotNull())


def rejected(df: DataFrame, casts: dict[str, str], rules: Sequence[tuple[Column, str]], reason: str = "cast error",
             prefix: str = "c_") -> DataFrame:
    """The reject streams of :func:`cast_or_reject` and of :func:`validate_or_reject` after it, in
    one pass over ``df``: as the union of both they read, and shuffled, the rows twice."""
    typed, failed = _typed(df, casts, prefix)
    return typed.withColumn(REASON, F.when(failed, F.lit(reason)).otherwise(_first_reason(rules))).filter(F.col(REASON).isNotNull())


def load_window_filter(date: Column, load_from: str, load_to: str) -> Column:
    """LoadFrom <= date <= LoadTo (inclusive)."""
    return date.between(F.to_date(F.lit(load_from)), F.to_date(F.lit(load_to)))


def to_reject_log(rejects: DataFrame, batch_id: str, source_table: str, natural_key: Column,
                  rejected_at: Column | None = None) -> DataFrame:
    """Project a reject stream onto the reject-log schema."""
    return rejects.select(
        F.lit(batch_id).alias("batch_id"), F.lit(source_table).alias("source_table"),
        natural_key.cast("string").alias("natural_key"), F.col(REASON).cast("string").alias("reason"),
        (rejected_at if rejected_at is not None else F.current_timestamp()).cast("timestamp").alias("rejected_at"))
