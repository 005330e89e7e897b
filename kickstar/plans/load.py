"""One warehouse load run: staging → dimensions → facts → rejects → audit → journal → rollup.

The stage order of the original package is kept (dimensions before facts; the club
merge after competitions because clubs take their league from them; clubs seen only in
facts after the club merge). Every step is a DataFrame plan; a run writes:

* dimension snapshots ``<root>/dim_<name>/v=<run>`` (a merge reads version n, writes
  n+1 — never the path it reads);
* fact rows appended to ``<root>/fact_<name>`` (partitioned by season where the fact
  has one) after natural-key anti-joins, so a re-run adds nothing;
* the reject log (the four fact sources purged at run start), the load window, the
  batch journal and the season × club standing rollup.

``root`` must be a shared folder on a cluster.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickstar import fixed
from kickstar.frames import literal_frame, materialize, path_exists
from kickstar.operators.route import REJECT_SCHEMA
from kickstar.plans import star, warehouse as WH
from kickstar.sources import sinks

COMPETITION_SPEC = WH.ScdSpec(natural_key="competition_id", surrogate="competition_key",
                              scd1=("competition_name", "competition_type", "competition_sub_type", "country_name",
                                    "confederation"))
MATCH_SPEC = WH.ScdSpec(natural_key="game_id", surrogate="match_key",
                        scd1=("round", "round_type", "stadium", "referee", "home_formation", "away_formation",
                              "attendance_band"))
_VALID = "effective_date date, expiry_date date, is_current boolean"
DIM_SCHEMAS = {
    "competition": "competition_key long, competition_id string, competition_name string, competition_type string, "
                   f"competition_sub_type string, country_name string, confederation string, {_VALID}",
    "club": "club_key long, club_id long, club_name string, club_type string, country_name string, "
            "confederation string, current_league_id string, current_league_name string, "
            f"previous_league_name string, stadium_name string, stadium_capacity_band string, {_VALID}",
    "player": "player_key long, player_id long, full_name string, date_of_birth date, country_of_birth string, "
              "citizenship string, position string, sub_position string, foot string, height_band string, "
              f"agent_name string, contract_expiry_year int, international_caps_band string, {_VALID}",
    "match": "match_key long, game_id long, round string, round_type string, stadium string, referee string, "
             f"home_formation string, away_formation string, attendance_band string, {_VALID}",
    "manager": "manager_key long, manager_name string",
}
U, NA = fixed.UNKNOWN, fixed.NOT_APPLICABLE
FIRST, OPEN = dt.date(1900, 1, 1), dt.date(9999, 12, 31)
SPECIAL_ROWS = {
    "competition": [(-1, "-1", fixed.UNKNOWN_COMPETITION, U, U, U, U, FIRST, OPEN, True),
                    (-2, "-2", fixed.NO_COMPETITION, NA, NA, NA, NA, FIRST, OPEN, True)],
    "club": [(-1, -1, fixed.UNKNOWN_CLUB, fixed.UNKNOWN_SHORT, U, U, None, U, None, U, U, FIRST, OPEN, True),
             (-2, -2, fixed.NO_CLUB, NA, NA, NA, None, NA, None, NA, NA, FIRST, OPEN, True)],
    "player": [(-1, -1, fixed.UNKNOWN_PLAYER, None, U, U, U, U, U, U, U, None, U, FIRST, OPEN, True)],
    "match": [(-1, -1, U, U, U, U, U, U, U, FIRST, OPEN, True)],
    "manager": [(-1, U)],
}
FACT_KEYS = {
    "team_match": ["match_key", "club_key"],
    "player_appearance": ["appearance_id"],
    "player_valuation": ["player_key", "date_key"],
    "transfer": ["player_key", "date_key", "from_club_key", "to_club_key"],
}
FACT_PARTITION = {"team_match": ["season_key"], "player_appearance": ["season_key"], "transfer": ["season_key"]}
FACT_SOURCES = ["club_games", "appearances", "player_valuations", "transfers", "fact_clubs", *WH.DIM_CASTS]


def _schema(name: str) -> T.StructType:
    return T._parse_datatype_string(DIM_SCHEMAS[name])


def _dim(spark: SparkSession, root: str, name: str) -> DataFrame:
    cur = sinks.snapshot_read(spark, f"{root}/dim_{name}")
    if cur is not None:
        return cur.select(*[F.col(f.name).cast(f.dataType) for f in _schema(name).fields])
    return literal_frame(spark, SPECIAL_ROWS[name], _schema(name))


def _fact_rows(spark: SparkSession, root: str) -> int:
    """Rows of the facts that were written yet; any other failure to read is an error."""
    paths = [f"{root}/fact_{name}" for name in FACT_KEYS]
    return sum(spark.read.parquet(p).count() for p in paths if path_exists(spark, p))


def _fact_clubs(staging: dict[str, DataFrame]) -> list[DataFrame]:
    """(id, name, batch) of the clubs named by valuations, transfers and games, where the
    staged table has those columns, and the ids of club games and appearances."""
    sources = [("player_valuations", "current_club_id", "current_club_name"), ("transfers", "from_club_id", "from_club_name"),
               ("transfers", "to_club_id", "to_club_name"), ("games", "away_club_id", "away_club_name"),
               ("games", "home_club_id", "home_club_name"), ("club_games", "club_id", None), ("club_games", "opponent_id", None),
               ("appearances", "player_club_id", None)]
    out = []
    for table, club, name in sources:
        df = staging[table]
        if club in df.columns:
            named = F.col(name) if name in df.columns else F.lit(None).cast("string")
            out.append(df.select(club, named.alias("club_name"), "batch_id"))
    return out


def inferred_rows(fact_clubs: list[DataFrame], dim_club: DataFrame) -> DataFrame:
    """Clubs that only facts name, as incoming rows of the club merge."""
    return WH.inferred_clubs(fact_clubs, dim_club).select(
        "club_id", "club_name", "club_type", F.lit(U).alias("country_name"),
        F.lit(U).alias("confederation"), F.lit(None).cast("string").alias("current_league_id"),
        F.lit(U).alias("current_league_name"), F.lit(U).alias("stadium_name"), F.lit(U).alias("stadium_capacity_band"))


def _in_parallel(tasks: dict) -> dict:
    """Run independent driver-side steps (each submits its own Spark jobs) concurrently;
    the scheduler overlaps their stages. The first failure is raised."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def _existing(spark: SparkSession, root: str, name: str, like: DataFrame) -> DataFrame:
    return sinks.read_or_empty(spark, f"{root}/fact_{name}", like.schema)


def run_load(spark: SparkSession, staging: dict[str, DataFrame], root: str, window: WH.LoadWindow,
             run_date: str, started_at: dt.datetime | None = None) -> dict[str, int]:
    started_at = started_at or dt.datetime.now()
    journal_path = f"{root}/etl_batch"
    journal = sinks.snapshot_read(spark, journal_path)
    journal = journal if journal is not None else spark.createDataFrame([], WH.JOURNAL_SCHEMA)
    run = (journal.agg(F.max("run_id")).first()[0] or 0) + 1
    before = _fact_rows(spark, root)
    # written before anything else: a run that dies is found as RUNNING and becomes FAILED
    sinks.snapshot_write(WH.journal_start(journal, window.batch_id, window, started_at, before), journal_path, 2 * run - 1)
    journal = sinks.snapshot_read(spark, journal_path)
    sinks.overwrite(WH.load_window_record(spark, window), f"{root}/etl_load_window")
    sinks.reject_purge(spark, f"{root}/etl_reject", FACT_SOURCES)

    # --- dimensions (competition → club → fact-only clubs → player → match → manager)
    dims: dict[str, DataFrame] = {}
    comp_in = WH.competition_incoming(staging["competitions"], staging["countries"])
    merged = WH.scd_merge(_dim(spark, root, "competition"), comp_in, COMPETITION_SPEC, run_date)
    club_in = WH.club_incoming(staging["clubs"], staging["national_teams"], merged)
    dims["competition"] = merged
    dims["club"] = WH.scd_merge(_dim(spark, root, "club"), club_in, WH.CLUB_SPEC, run_date)
    fact_clubs = _fact_clubs(staging)
    dims["club"] = WH.scd_merge(dims["club"], inferred_rows(fact_clubs, dims["club"]), WH.CLUB_SPEC, run_date)
    dims["player"] = WH.scd_merge(_dim(spark, root, "player"), WH.player_incoming(staging["players"]),
                                  WH.PLAYER_SPEC, run_date)
    dims["match"] = WH.scd_merge(_dim(spark, root, "match"), WH.match_incoming(staging["games"]), MATCH_SPEC,
                                 run_date)
    dims["manager"] = WH.insert_only(_dim(spark, root, "manager"), WH.manager_members(staging["club_games"]),
                                     "manager_name", "manager_key")
    # the six snapshot writes are independent jobs: submit them together
    paths = _in_parallel({name: (lambda df=df, name=name: sinks.snapshot_write(df, f"{root}/dim_{name}", run))
                          for name, df in dims.items()})
    for name, path in paths.items():
        dims[name] = spark.read.parquet(path)          # later steps read the written version
    dims["season"] = star.dim_season(spark)

    # --- facts
    loads = {
        "team_match": lambda ex, keep: WH.load_fact_team_match(staging["club_games"], staging["games"], dims, ex, window, keep),
        "player_appearance": lambda ex, keep: WH.load_fact_player_appearance(staging["appearances"], staging["games"],
                                                                             dims, ex, window, keep),
        "player_valuation": lambda ex, keep: WH.load_fact_player_valuation(staging["player_valuations"], dims["player"],
                                                                           dims["club"], ex, window, dims["competition"], keep),
        "transfer": lambda ex, keep: WH.load_fact_transfer(staging["transfers"], dims, ex, window, keep),
    }

    def load_one(name: str, load) -> tuple[int, DataFrame]:
        probe, _ = load(spark.createDataFrame([], FACT_EXISTING_PROBE[name]), lambda df: df)
        existing = _existing(spark, root, name, probe)
        # the rows are written once before they are routed into facts and rejects
        fact, rej = load(existing, lambda df: materialize(df, f"rows-{name}"))
        n = WH.incremental_append(spark, fact, f"{root}/fact_{name}", FACT_KEYS[name], probe.schema,
                                  FACT_PARTITION.get(name))
        if name == "team_match" and path_exists(spark, f"{root}/fact_{name}"):
            stored = sinks.snapshot_read(spark, f"{root}/mv_club_season_standing")
            sinks.snapshot_write(WH.maintain_standing_rollup(stored, spark.read.parquet(f"{root}/fact_{name}")),
                                 f"{root}/mv_club_season_standing", run)
        return n, rej

    # the four fact flows write different tables and read only the written dimensions:
    # they run as concurrent Spark jobs
    results = _in_parallel({name: (lambda name=name, load=load: load_one(name, load)) for name, load in loads.items()})
    added: dict[str, int] = {name: results[name][0] for name in loads}
    rejects = [results[name][1] for name in loads]

    # --- reject log and code audit
    audit = WH.code_audit(staging, dims, window.batch_id)
    log = rejects[0]
    for r in rejects[1:] + [audit, WH.inferred_club_rejects(fact_clubs, window.batch_id), WH.dimension_rejects(staging, window.batch_id)]:
        log = log.unionByName(r)
    sinks.reject_sink(log.select(*[F.col(f.name).cast(f.dataType) for f in REJECT_SCHEMA.fields]),
                      f"{root}/etl_reject")

    after = _fact_rows(spark, root)
    journal = WH.journal_finish(journal, window.batch_id, dt.datetime.now(), after)
    sinks.snapshot_write(journal, journal_path, 2 * run)
    return dict(added, run_id=run, fact_rows_before=before, fact_rows_after=after)


# empty "existing fact" frames used once to learn each load's output schema
FACT_EXISTING_PROBE = {
    "team_match": "match_key long, club_key long",
    "player_appearance": "appearance_id string",
    "player_valuation": "player_key long, date_key int, club_key long, competition_key int, "
                        "market_value_eur long, value_change_eur long, age_at_valuation int, valuation_count int, "
                        "batch_id string",
    "transfer": "player_key long, date_key int, from_club_key long, to_club_key long",
}
