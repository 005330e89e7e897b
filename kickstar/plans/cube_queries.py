"""Registered queries over the measure registry and the cube operators: every valuation, transfer
and performance measure at a level, slices and dices with ranks, and overlapping member sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickstar.plans import cube as C
from kickstar.plans import measures as M
from kickstar.plans import star
from kickstar.plans.questions import SEASON, SEASONS_3

VALUATION = ("m_total_value", "m_value_change", "m_age_sum", "m_has_age", "m_valuations", "avg_value", "avg_age_at_valuation")
TRANSFER = ("m_fee", "m_fee_disclosed", "m_value_at_transfer", "m_premium", "m_has_premium", "m_deals", "m_free_deals", "m_youth_deals", "m_pro_age_sum",
            "m_pro_deals", "fee_m", "avg_fee", "avg_premium", "free_rate", "youth_rate", "avg_pro_age")
PERFORMANCE = ("m_appearances", "m_minutes", "m_goals", "m_assists", "m_yellow", "m_red", "m_distinct_matches", "m_distinct_players", "goals_per_90",
               "goals_assists_per_90", "yellow_per_match", "fair_play_per_match", "cards_per_player")


def _by_season(spark: SparkSession, fact: DataFrame, measures) -> DataFrame:
    return M.evaluate(fact, ["season_label"], measures, [(star.dim_season(spark), "season_key")])


def measures_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All valuation measures by position."""
    return M.evaluate(star.player_valuation(spark, sf_dir), ["position"], VALUATION, [(star.dim_player(spark, sf_dir), "player_key")])


def measures_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transfer measures by season."""
    return _by_season(spark, star.transfer(spark, sf_dir), TRANSFER)


def measures_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performance and discipline measures by season, with distinct matches and players."""
    return _by_season(spark, star.player_appearance(spark, sf_dir), PERFORMANCE)


def slice_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slice: the clubs of one season with rank and position by points, the first 20. Dice: the 20
    best (season, club) members of three seasons with three matches or more and some points."""
    base = M.evaluate(star.team_match(spark, sf_dir), ["season_label", "club_key"], ("m_points", "m_matches", "win_rate"),
                      [(star.dim_season(spark), "season_key")])
    one = C.rank_in_set(C.cube_slice(base, season_label=SEASON), "m_points", "rank", "position", ["club_key"]).filter("position <= 20")
    some = C.filter_members(C.non_empty(C.cube_dice(base, {"season_label": list(SEASONS_3)}), "m_points"), F.col("m_matches") >= 3)
    best = C.top_count(some, 20, "m_points", ["season_label", "club_key"])
    names = ["season_label", "club_key", "m_points", "m_matches", "win_rate"]
    none = F.lit(None).cast("long")
    return one.select(F.lit("slice").alias("part"), *names, F.col("rank").cast("long").alias("rank"), F.col("position").cast("long").alias("position")) \
        .unionAll(best.select(F.lit("dice").alias("part"), *names, none.alias("rank"), none.alias("position")))


def overlapping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches, points and wins of three overlapping club sets and all clubs, in one scan."""
    sets = {"even": F.col("club_key") % 2 == 0, "first": F.col("club_key") < 40, "europe": F.col("confederation") == "EUROPE", "all": F.lit(True)}
    return C.evaluate_sets(star.team_match(spark, sf_dir), star.dim_club(spark, sf_dir), "club_key", sets, ("m_matches", "m_points", "m_wins"))
