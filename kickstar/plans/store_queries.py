"""Registered queries over a store: reruns that meet only the files they can collide with, a load
from CSV files, a merge by buckets, and the stored lattice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickstar.frames import literal_frame
from kickstar.plans import atomic_load as AL
from kickstar.plans import staged, star
from kickstar.plans import warehouse as WH
from kickstar.plans.history import scd2_history
from kickstar.plans.lattice import Lattice
from kickstar.session import checkpoint_dir
from kickstar.sources.store import Store

#: Appearances by season, competition and club, with exact distinct players at every level.
APPEARANCES = Lattice("appearance", (("season_key", "competition_key", "club_key"), ("season_key", "club_key"), ("season_key", "competition_key"),
                                     ("club_key",), ("season_key",)),
                      (("appearances", "1"), ("goals", "goals"), ("assists", "assists"), ("minutes", "minutes_played")),
                      (("players", "player_key"),))
#: Team matches by season, club and competition.
STANDINGS = Lattice("standing", (("season_key", "competition_key", "club_key"), ("season_key", "club_key"), ("season_key",)),
                    (("matches", "1"), ("points", "points"), ("wins", "is_win"), ("draws", "is_draw"), ("losses", "is_loss"),
                     ("goals_for", "goals_for"), ("goals_against", "goals_against")))


def new_store(spark: SparkSession) -> Store:
    return Store(spark, f"{checkpoint_dir(spark).rstrip('/')}/kickstar-warehouse-{uuid.uuid4().hex}")


def _rerun(spark: SparkSession, name: str, staging: dict[str, DataFrame], dims: dict[str, DataFrame], early: WH.LoadWindow, window: WH.LoadWindow) -> DataFrame:
    store = new_store(spark)
    run = store.begin(early.batch_id)
    AL.load_fact(run, name, staging, dims, early)
    run.commit()
    existing = AL.existing_rows(store, name, AL._batch_keys(name, staging, dims), AL.L.FACT_EXISTING_PROBE[name])
    return AL._flow(name, staging, dims, existing, window, lambda df: df)[0]


def load_fact_team_match_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the whole team-match window adds after its first two years were loaded, against
    the stored fact's files that hold a match of the batch."""
    manager = star.dim_manager(spark, sf_dir).unionByName(
        literal_frame(spark, [(-1, staged.fixed.UNKNOWN)], "manager_key int, manager_name string"))
    dims = {"match": star.dim_match(spark, sf_dir), "club": star.dim_club(spark, sf_dir), "competition": star.dim_competition(spark, sf_dir),
            "season": star.dim_season(spark), "manager": manager}
    staging = {"club_games": staged.stg_club_games(spark, sf_dir), "games": staged.stg_games(spark, sf_dir)}
    return _rerun(spark, "team_match", staging, dims, WH.LoadWindow("1995-01-01", "1996-12-31", "BATCH_TM_0"), staged.TEAM_WINDOW)


def load_fact_player_appearance_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for appearances, by their ids."""
    player, club, comp = staged.load_dims(spark, sf_dir)
    dims = {"match": star.dim_match(spark, sf_dir), "player": player, "club": club, "competition": comp, "season": star.dim_season(spark)}
    staging = {"appearances": staged.stg_appearances(spark, sf_dir), "games": staged.stg_games(spark, sf_dir)}
    return _rerun(spark, "player_appearance", staging, dims, WH.LoadWindow("1995-01-01", "1996-12-31", "BATCH_AP_0"), staged.APPEARANCE_WINDOW)


def _two_batches(spark: SparkSession, lattice: Lattice, fact: DataFrame) -> Store:
    store = new_store(spark)
    for k, part in enumerate((F.col("season_key") <= 1995, F.col("season_key") > 1995)):
        run = store.begin(f"BATCH_{k + 1}")
        lattice.append(run, fact.filter(part))
        run.commit()
    return store


def mv_reaggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appearance measures and exact distinct players at four levels, from the lattice after two
    batches: total, season, club, season and competition."""
    store = _two_batches(spark, APPEARANCES, star.player_appearance(spark, sf_dir))
    out = None
    for level in ((), ("season_key",), ("club_key",), ("season_key", "competition_key")):
        rows = APPEARANCES.answer(store, level)
        keys = [(F.col(c) if c in level else F.lit(None)).cast("long").alias(c) for c in APPEARANCES.nodes[0]]
        rows = rows.select(F.lit("+".join(level) or "total").alias("level"), *keys, "appearances", "goals", "assists", "minutes", "players")
        out = rows if out is None else out.unionAll(rows)
    return out


def mv_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season totals of the team matches, from the smallest stored node, after two batches."""
    return STANDINGS.answer(_two_batches(spark, STANDINGS, star.team_match(spark, sf_dir)), ("season_key",))


HISTORY_SPEC = WH.ScdSpec(natural_key="player_id", surrogate="player_key", scd1=("full_name",), scd2=("agent_name", "position"))
HISTORY_DATES = ("2024-01-01", "2024-03-01", "2024-05-01", "2024-07-01")


def player_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches of players: a third of them changes the agent in each batch, every seventh the
    name in the second and last, some join late or are left out once."""
    p = staged.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("player_id"), "c_name", "c_mktsegment")
    k, out = F.col("player_id"), None
    for i, date in enumerate(HISTORY_DATES):
        moves = F.floor((k + i) / 3).cast("long")
        rows = p.filter((k % 5 != 4) if i == 0 else (k % 11 != i)).select(
            "player_id", F.lit(date).alias("batch_date"),
            F.when((k % 7 == 0) & F.lit(i in (1, 3)), F.concat("c_name", F.lit(f" {i}"))).otherwise(F.col("c_name")).alias("full_name"),
            F.when(moves % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("Agent "), moves.cast("string"))).alias("agent_name"),
            F.col("c_mktsegment").alias("position"))
        out = rows if out is None else out.unionByName(rows)
    return out


def scd2_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The players' whole version history from four batches at once."""
    return scd2_history(player_batches(spark, sf_dir), HISTORY_SPEC, "batch_date")


def scd_merge_club_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SCD 1/2/3 club merge on a dimension in buckets: only buckets with a change are written."""
    store = new_store(spark)
    run = store.begin("BATCH_1")
    run.replace_buckets("dim_club", staged.club_dim_v1(spark, sf_dir), ["club_id"], AL.BUCKETS, range(AL.BUCKETS))
    AL.merge_dimension(run, "club", staged.club_incoming_v2(spark, sf_dir), WH.CLUB_SPEC, staged.SCD_RUN_DATE)
    run.commit()
    return store.read("dim_club")
