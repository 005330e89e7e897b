"""A whole version history from many staged batches at once.

Merging n batches one after the other reads and writes the dimension n times. Here all batches
are ordered per member in one shuffle; the change points are the rows whose type 2 attributes
differ from the row before, runs of equal versions collapse, and each version ends a day before
the next one begins. Type 1 attributes follow the merges' rule: a batch that changes only these
overwrites every version that there is by then, a batch with a new version gives its values to
that version alone. Windows are per member, over its batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kickstar import fixed
from kickstar.functions import exprs as X
from kickstar.operators import keys as K
from kickstar.plans.warehouse import ScdSpec


def scd2_history(batches: DataFrame, spec: ScdSpec, batch_date: str, key_base: int = 0,
                 first_start: str = fixed.SCD_FIRST_START) -> DataFrame:
    """All versions of all members of ``batches`` (the spec's columns and ``batch_date``, at most one
    row per member and date): the columns, ``valid_from``, ``valid_to``, ``current`` and the surrogate
    key, numbered by date and member from ``key_base + 1``. For specs of types 1 and 2; a member
    that a batch leaves out stays as it is."""
    if spec.scd3_trigger or spec.scd3_current:
        raise ValueError("the history has no type 3 attributes")
    nk, tracked = spec.natural_key, [*spec.scd1, *spec.scd2]
    order = Window.partitionBy(nk).orderBy("__d")

    def changed(cols) -> Column:
        out = F.lit(False)
        for c in cols:
            out = out | X.null_safe_changed(F.col(c), F.lag(c).over(order))
        return out

    rows = batches.select(nk, F.to_date(batch_date).alias("__d"), *tracked)
    action = (F.when(F.row_number().over(order) == 1, "new").when(changed(spec.scd2), "scd2").when(changed(spec.scd1), "scd1"))
    acted = rows.withColumn("__action", action).filter(F.col("__action").isNotNull())
    # the last batch that overwrote the type 1 attributes of all versions
    last = F.max(F.when(F.col("__action") == "scd1", F.struct("__d", *spec.scd1))).over(Window.partitionBy(nk))
    versions = acted.withColumn("__last", last).filter(F.col("__action") != "scd1")
    overwritten = F.coalesce(F.col("__d") < F.col("__last.__d"), F.lit(False))
    nth, after = F.row_number().over(order), F.lead("__d").over(order)
    built = versions.select(
        nk, "__d", *[F.when(overwritten, F.col(f"__last.{c}")).otherwise(F.col(c)).alias(c) for c in spec.scd1], *spec.scd2,
        F.when(nth == 1, F.to_date(F.lit(first_start))).otherwise(F.col("__d")).alias(spec.valid_from),
        F.coalesce(F.date_sub(after, 1), F.to_date(F.lit(fixed.SCD_OPEN_END))).alias(spec.valid_to), after.isNull().alias(spec.current))
    keyed = K.global_positions(built, [F.col("__d"), F.col(nk)], "__pos")
    return keyed.withColumn(spec.surrogate, (F.lit(key_base) + F.col("__pos")).cast("long")).drop("__pos", "__d")
