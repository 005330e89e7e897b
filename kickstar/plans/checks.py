"""Registered warehouse and data-quality queries over the driver-derived star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickstar.operators import keys as K
from kickstar.operators import windows as W
from kickstar.plans import quality, star, warehouse as WH
from kickstar.plans.questions import COMPETITION, SEASON, _seasons, in_competitions
from kickstar.sources.driver import table

# incremental windows over the team/appearance/transfer dates (1995-2001) and valuations (2024)
BATCH_WINDOWS = (
    WH.LoadWindow("1990-01-01", "1996-12-31", "BATCH_1"),
    WH.LoadWindow("1990-01-01", "1999-12-31", "BATCH_2"),
    WH.LoadWindow("1990-01-01", "2030-12-31", "BATCH_3"),
    WH.LoadWindow("1990-01-01", "2030-12-31", "BATCH_4"),   # re-run: adds no row
)


def _facts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "team_match": star.team_match(spark, sf_dir),
        "appearance": star.player_appearance(spark, sf_dir),
        "valuation": star.player_valuation(spark, sf_dir),
        "transfer": star.transfer(spark, sf_dir),
    }


def _date_of_key(dk) -> "F.Column":
    return F.to_date(dk.cast("string"), "yyyyMMdd")


def dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "dim_competition": star.dim_competition(spark, sf_dir),
        "dim_club": star.dim_club(spark, sf_dir),
        "dim_player": star.dim_player(spark, sf_dir),
        "dim_match": star.dim_match(spark, sf_dir),
        "dim_manager": star.dim_manager(spark, sf_dir),
    }
    tables.update({f"fact_{k}": v for k, v in _facts(spark, sf_dir).items()})
    return quality.row_counts(tables)


def dq_window_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.window_max(_facts(spark, sf_dir), "1990-01-01", "2030-12-31")


def dq_batch_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = {k: WH.assign_batches(v, _date_of_key(F.col("date_key")), BATCH_WINDOWS)
               for k, v in _facts(spark, sf_dir).items()}
    return quality.batch_delta(batched)


def dq_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _facts(spark, sf_dir)
    player = star.dim_player(spark, sf_dir).withColumn("is_current", F.lit(True))
    return quality.integrity(f["team_match"], f["appearance"], f["valuation"], f["transfer"],
                             star.dim_club(spark, sf_dir), player)


def dq_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.formula(star.team_match(spark, sf_dir))


def dq_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.domain(star.player_valuation(spark, sf_dir), star.transfer(spark, sf_dir))


def dq_segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.segment_profile(star.transfer(spark, sf_dir))


def dq_league_table(spark: SparkSession, sf_dir: str, competition: str = COMPETITION, season: str = SEASON,
                    n: int = 5) -> DataFrame:
    """Spot check: top of one league table (points, then goal difference)."""
    tm = star.team_match(spark, sf_dir, ship_range=star.season_span([season])) \
        .join(_seasons(spark, [season]).select("season_key"), "season_key", "left_semi")
    tm = in_competitions(spark, sf_dir, tm, [competition])
    per = tm.groupBy("club_key").agg(F.count(F.lit(1)).alias("matches"), F.sum("points").alias("points"),
                                     F.sum("goal_difference").alias("goal_difference"), F.sum("is_win").alias("wins"))
    per = per.join(star.dim_club(spark, sf_dir).select("club_key", "club_name"), "club_key")
    g = per.groupBy("club_name").agg(*[F.sum(c).alias(c) for c in ("matches", "points", "goal_difference", "wins")])
    return W.top_n(g, n, [F.desc("points"), F.desc("goal_difference"), F.asc("club_name")])


def dq_top_scorers(spark: SparkSession, sf_dir: str, competition: str = COMPETITION, season: str = SEASON,
                   n: int = 5) -> DataFrame:
    fa = star.player_appearance(spark, sf_dir, ship_range=star.season_span([season])) \
        .join(_seasons(spark, [season]).select("season_key"), "season_key", "left_semi")
    fa = in_competitions(spark, sf_dir, fa, [competition])
    per = fa.groupBy("player_key").agg(F.sum("goals").alias("goals"), F.sum("minutes_played").alias("minutes"))
    per = per.join(star.dim_player(spark, sf_dir).select("player_key", "full_name"), "player_key")
    g = per.groupBy("full_name").agg(F.sum("goals").alias("goals"), F.sum("minutes").alias("minutes"))
    g = g.withColumn("goals_per_90", F.try_divide(F.col("goals").cast("double") * F.lit(90.0),
                                                  F.col("minutes").cast("double")))
    return W.top_n(g, n, [F.desc("goals"), F.asc("full_name")])


def gen_dim_date_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension over the span of the ship dates (plus the unknown row)."""
    span = table(spark, sf_dir, "lineitem").agg(F.to_date(F.min("l_shipdate")).alias("start"),
                                                F.to_date(F.max("l_shipdate")).alias("end"))
    return WH.gen_dim_date(spark, span=span)


def gen_dim_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WH.gen_dim_age(star.player_valuation(spark, sf_dir), star.transfer(spark, sf_dir))


def surrogate_key_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDENTITY-style keys for the customers in (nation, name) order, without a global window."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    return K.surrogate_key(cust, ["c_nationkey", "c_name", "c_custkey"], "player_key") \
        .select("c_custkey", "player_key")
