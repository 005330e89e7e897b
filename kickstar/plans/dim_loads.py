"""Registered dimension loads over the staging that is derived from the driver tables.

Every query loads a dimension in two runs, so that new members, changed members (type 1 and
type 2) and members that stay as they are all occur; the special members come first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickstar.frames import literal_frame, materialize
from kickstar.plans import load, staged
from kickstar.plans import warehouse as WH

RUN_1, RUN_2 = "2024-01-01", "2024-07-01"


def _special(spark: SparkSession, name: str) -> DataFrame:
    return literal_frame(spark, load.SPECIAL_ROWS[name], load.DIM_SCHEMAS[name])


def load_dim_competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type 1: the leagues under old names, then all competitions."""
    new = WH.competition_incoming(staged.stg_competitions(spark, sf_dir), staged.stg_countries(spark, sf_dir))
    old = new.filter("competition_type = 'domestic_league'").withColumn("competition_name", F.concat(F.lit("Old "), "competition_name"))
    first = WH.scd_merge(_special(spark, "competition"), old, load.COMPETITION_SPEC, RUN_1)
    return WH.scd_merge(first, new, load.COMPETITION_SPEC, RUN_2)


def load_dim_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type 1: the played league games under an old referee, then all games."""
    new = WH.match_incoming(staged.stg_games(spark, sf_dir))
    old = new.filter("round_type = 'Matchday'").withColumn("referee", F.lit("Old referee"))
    first = WH.scd_merge(_special(spark, "match"), old, load.MATCH_SPEC, RUN_1)
    return WH.scd_merge(first, new, load.MATCH_SPEC, RUN_2)


def load_dim_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types 1 and 2: right-footed players first, under old names and partly with another
    agent; then all players. Another agent is a new version, another name is not."""
    new = WH.player_incoming(staged.stg_players(spark, sf_dir))
    agent = F.when(F.col("agent_name") == "Agent 5", F.lit("First agent")).otherwise(F.col("agent_name"))
    old = new.filter("foot = 'right'").withColumns({"full_name": F.concat(F.lit("Old "), "full_name"), "agent_name": agent})
    first = WH.scd_merge(_special(spark, "player"), old, WH.PLAYER_SPEC, RUN_1)
    return WH.scd_merge(first, new, WH.PLAYER_SPEC, RUN_2)


def load_dim_manager(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert only: manager names of the club games; a blank name is the unknown member."""
    names = WH.manager_members(staged.stg_club_games(spark, sf_dir))
    return WH.insert_only(_special(spark, "manager"), names, "manager_name", "manager_key")


def inferred_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clubs that only the facts name, with the names and type that they get."""
    clubs = load._fact_clubs(staged.staging_from_driver(spark, sf_dir))
    return WH.inferred_clubs(clubs, staged.club_dim_v1(spark, sf_dir))


def load_fact_transfer_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the whole transfer window adds after its first two years were loaded (and
    written: the second load reads them twice)."""
    player, club, _ = staged.load_dims(spark, sf_dir)
    dims = {"player": player, "club": club, "season": staged.star.dim_season(spark)}
    stg = staged.stg_transfers(spark, sf_dir)
    none = spark.createDataFrame([], staged.FACT_TRANSFER_KEYS)
    early = WH.LoadWindow("1995-01-01", "1996-12-31", "BATCH_TR_0")
    first, _ = WH.load_fact_transfer(stg, dims, none, early)
    fact, _ = WH.load_fact_transfer(stg, dims, materialize(first, "transfers-first"), staged.TRANSFER_WINDOW)
    return fact


def transfer_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reject stream of the transfer load by reason."""
    player, club, _ = staged.load_dims(spark, sf_dir)
    dims = {"player": player, "club": club, "season": staged.star.dim_season(spark)}
    none = spark.createDataFrame([], staged.FACT_TRANSFER_KEYS)
    _, rejects = WH.load_fact_transfer(staged.stg_transfers(spark, sf_dir), dims, none, staged.TRANSFER_WINDOW)
    return rejects.groupBy("source_table", "reason").agg(F.count(F.lit(1)).alias("rows"))


def standing_rollup_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored season and club standing after the rows since 1996 were appended."""
    from kickstar.plans.questions import standing_rollup
    fact = staged.star.team_match(spark, sf_dir)
    return WH.maintain_standing_rollup(standing_rollup(fact.filter("season_key <= 1995")), fact)
