"""Data-quality checks (the post-load integrity script).

Every check is an aggregate; columns named ``*_errors`` are expected to be 0 on a
correct load. Several one-row checks are placed side by side with a broadcast
cross join of one-row frames (scalar sub-selects in one row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickstar import fixed
from kickstar.operators.joins import one_row


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, stacked (UNION ALL of counts)."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def window_max(facts: dict[str, DataFrame], window_from: str, window_to: str) -> DataFrame:
    """The load window next to the max date key of every fact (must not exceed window_to)."""
    frames = [F.broadcast(df.agg(F.max("date_key").alias(f"max_date_key_{name}"))) for name, df in facts.items()]
    win = facts[next(iter(facts))].sparkSession.range(1).select(
        F.to_date(F.lit(window_from)).alias("window_from"), F.to_date(F.lit(window_to)).alias("window_to"))
    return one_row(win, *frames)


def batch_delta(facts: dict[str, DataFrame], batch_col: str = "batch_id") -> DataFrame:
    """Rows per batch × fact, pivoted to one column per fact."""
    stacked = None
    for name, df in facts.items():
        part = df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n")).withColumn("fact", F.lit(name))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(batch_col).pivot("fact", list(facts)).agg(F.sum("n")).fillna(0, subset=list(facts))


def reject_summary(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("source_table", "reason").agg(F.count(F.lit(1)).alias("rows"))


def _dup_keys(df: DataFrame, keys: Sequence[str], name: str, having: Column | None = None) -> DataFrame:
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    g = g.filter(having if having is not None else F.col("__n") > 1)
    return g.agg(F.count(F.lit(1)).alias(name))


def integrity(team_match: DataFrame, appearance: DataFrame, valuation: DataFrame, transfer: DataFrame,
              club: DataFrame, player: DataFrame) -> DataFrame:
    """Group-size and uniqueness checks in one row."""
    return one_row(
        _dup_keys(team_match, ["match_key"], "match_not_two_rows_errors", F.col("__n") != 2),
        _dup_keys(appearance, ["appearance_id"], "appearance_duplicate_errors"),
        _dup_keys(valuation, ["player_key", "date_key"], "valuation_duplicate_errors"),
        _dup_keys(transfer, ["player_key", "date_key", "from_club_key", "to_club_key"], "transfer_duplicate_deals"),
        _dup_keys(club.filter(F.col("is_current")), ["club_id"], "club_multi_current_errors"),
        _dup_keys(player.filter(F.col("is_current")), ["player_id"], "player_multi_current_errors"),
    )


def formula(team_match: DataFrame) -> DataFrame:
    """Stored outcome columns equal their recomputation."""
    gf, ga = F.col("goals_for"), F.col("goals_against")
    expect_points = F.when(gf > ga, 3).when(gf == ga, 1).otherwise(0)

    def bad(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0))

    return team_match.agg(
        bad(F.col("points") != expect_points).alias("points_errors"),
        bad(F.col("goal_difference") != gf - ga).alias("goal_difference_errors"),
        bad(F.col("is_win") + F.col("is_draw") + F.col("is_loss") != 1).alias("outcome_errors"),
        bad(F.col("is_clean_sheet") != F.when(ga == 0, 1).otherwise(0)).alias("clean_sheet_errors"),
    )


def domain(valuation: DataFrame, transfer: DataFrame) -> DataFrame:
    """Age domains and youth-flag consistency (SQL three-valued logic kept)."""
    age, youth = F.col("age_at_transfer"), F.col("is_youth_transfer")
    v = valuation.agg(F.count(F.when(F.col("age_at_valuation") < 14, 1)).alias("valuation_under_14_errors"))
    t = transfer.agg(
        F.count(F.when(~age.between(4, 45), 1)).alias("transfer_age_out_of_domain_errors"),
        F.count(F.when(youth != F.when(age < 18, 1).otherwise(0), 1)).alias("youth_flag_errors"),
        F.count(F.when((youth.isNull() & age.isNotNull()) | (youth.isNotNull() & age.isNull()), 1))
        .alias("youth_null_mismatch_errors"))
    return one_row(v, t)


def segment_profile(transfer: DataFrame) -> DataFrame:
    """Youth / professional / unknown-age deal profile; the mean fee truncates like an
    integer AVG (sum div count)."""
    y = F.col("is_youth_transfer")
    label = F.when(y == 1, F.lit(fixed.YOUTH_LABELS[0])).when(y == 0, F.lit(fixed.YOUTH_LABELS[1])) \
        .otherwise(F.lit(fixed.YOUTH_LABELS[2]))
    g = transfer.groupBy(y.alias("is_youth_transfer")).agg(
        F.count(F.lit(1)).alias("deals"), F.avg(F.col("age_at_transfer").cast("double")).alias("avg_age"),
        F.sum("transfer_fee_eur").alias("__s"), F.count("transfer_fee_eur").alias("__c"))
    fee = F.when(F.col("__c") > 0, F.expr("__s div __c"))
    return g.select(label.alias("segment"), "deals", "avg_age", fee.alias("avg_fee_eur"))
