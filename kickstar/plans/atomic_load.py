"""A warehouse load over a :class:`kickstar.sources.store.Store`: dimensions, facts, rejects and
the rollup of a run appear together.

It runs the same flows as :mod:`kickstar.plans.load`, with these differences:

* Dimensions lie in buckets of their natural key. The incoming rows are classified first; only
  buckets with a new or changed member are merged and written.
* A fact flow meets only the files that its batch can collide with, found in the key index. The
  indexed key does not change with a member's versions (match, appearance id, day), so a file
  with a row of the batch is always among them.
* The rows of a flow are written once before they are routed, so that facts and rejects come
  from one evaluation.
* A rerun adds no row, and a run that dies anywhere leaves the last committed state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickstar.frames import literal_frame, materialize
from kickstar.functions import exprs as X
from kickstar.operators.route import REJECT_SCHEMA
from kickstar.plans import load as L
from kickstar.plans import star
from kickstar.plans import warehouse as WH
from kickstar.sources.store import Run, Store, bucket_of

BUCKETS = 32
#: The columns of each fact's index.
INDEX_KEY = {"team_match": ["match_key"], "player_appearance": ["appearance_id"], "player_valuation": ["date_key"], "transfer": ["date_key"]}
FOLDERS = {"team_match": "season_key", "player_appearance": "season_key", "player_valuation": None, "transfer": "season_key"}


def _touched(rows: DataFrame, key: str) -> list[int]:
    """The buckets of the rows' keys: at most ``BUCKETS`` numbers."""
    return sorted(r.b for r in rows.select(bucket_of([key], BUCKETS).alias("b")).distinct().collect())


def _dimension(run: Run, name: str, key: str) -> DataFrame:
    """The dimension as the run sees it; the special members on its first load."""
    if run.read(f"dim_{name}") is None:
        special = literal_frame(run.spark, L.SPECIAL_ROWS[name], L.DIM_SCHEMAS[name])
        run.replace_buckets(f"dim_{name}", special, [key], BUCKETS, range(BUCKETS))
    return run.read(f"dim_{name}")


def merge_dimension(run: Run, name: str, incoming: DataFrame, spec: WH.ScdSpec, run_date: str) -> list[int]:
    """Merge ``incoming`` into the stored dimension; returns the buckets that were written."""
    dim = _dimension(run, name, spec.natural_key)
    incoming = materialize(incoming.select(F.col(spec.natural_key).cast(dim.schema[spec.natural_key].dataType).alias(spec.natural_key),
                                           *[c for c in incoming.columns if c != spec.natural_key]), f"incoming-{name}")
    touched = _touched(WH.scd_actions(dim, incoming, spec).select(F.col("__nk").alias(spec.natural_key)), spec.natural_key)
    if touched:
        here = bucket_of([spec.natural_key], BUCKETS).isin(touched)
        base = dim.agg(F.coalesce(F.max(F.when(F.col(spec.surrogate) > 0, F.col(spec.surrogate))), F.lit(0))).first()[0]
        merged = WH.scd_merge(run.read_buckets(f"dim_{name}", touched), incoming.filter(here), spec, run_date, key_base=base)
        run.replace_buckets(f"dim_{name}", merged, [spec.natural_key], BUCKETS, touched)
    return touched


def _insert_members(run: Run, name: str, incoming: DataFrame, key: str, surrogate: str) -> list[int]:
    dim = _dimension(run, name, key)
    new = materialize(incoming.select(key).distinct().join(dim.select(key), key, "left_anti"), f"members-{name}")
    touched = _touched(new, key)
    if touched:
        base = dim.agg(F.coalesce(F.max(F.when(F.col(surrogate) > 0, F.col(surrogate))), F.lit(0))).first()[0]
        merged = WH.insert_only(run.read_buckets(f"dim_{name}", touched), new, key, surrogate, key_base=base)
        run.replace_buckets(f"dim_{name}", merged, [key], BUCKETS, touched)
    return touched


def _batch_keys(name: str, staging: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """The index keys of a fact's staged rows."""
    day = lambda table, c: staging[table].select(X.date_key(F.try_to_date(X.clean_date_text(c), "yyyy-MM-dd")).alias("date_key"))
    if name == "team_match":
        games = staging["club_games"].select(X.clean_text("game_id").alias("g")).distinct()
        return games.join(dims["match"].select(F.col("game_id").cast("string").alias("g"), "match_key"), "g").select("match_key")
    if name == "player_appearance":
        return staging["appearances"].select(X.clean_text("appearance_id").alias("appearance_id"))
    return (day("player_valuations", "date") if name == "player_valuation" else day("transfers", "transfer_date")).distinct()


def existing_rows(store, name: str, keys: DataFrame, schema) -> DataFrame:
    """The fact rows that a batch with these index keys can collide with, from their files only."""
    found = store.read_files(f"fact_{name}", store.candidate_files(f"fact_{name}", keys))
    return store.spark.createDataFrame([], schema) if found is None else found


def _flow(name: str, staging: dict[str, DataFrame], dims: dict[str, DataFrame], existing: DataFrame, window: WH.LoadWindow,
          keep: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    if name == "team_match":
        return WH.load_fact_team_match(staging["club_games"], staging["games"], dims, existing, window, keep=keep)
    if name == "player_appearance":
        return WH.load_fact_player_appearance(staging["appearances"], staging["games"], dims, existing, window, keep=keep)
    if name == "player_valuation":
        return WH.load_fact_player_valuation(staging["player_valuations"], dims["player"], dims["club"], existing, window, dims["competition"], keep=keep)
    return WH.load_fact_transfer(staging["transfers"], dims, existing, window, keep=keep)


def load_fact(run: Run, name: str, staging: dict[str, DataFrame], dims: dict[str, DataFrame], window: WH.LoadWindow) -> tuple[int, DataFrame]:
    """Append the batch's new rows to the fact; returns their number and the rejects."""
    existing = existing_rows(run._view(), name, _batch_keys(name, staging, dims), L.FACT_EXISTING_PROBE[name])
    fact, rejects = _flow(name, staging, dims, existing, window, lambda df: materialize(df, f"rows-{name}"))
    written = run.append(f"fact_{name}", fact, FOLDERS[name], INDEX_KEY[name])
    return written.count(), rejects


def load_atomic(spark: SparkSession, staging: dict[str, DataFrame], root: str, window: WH.LoadWindow, run_date: str,
                started_at: dt.datetime | None = None) -> dict[str, int]:
    """One run: everything or nothing. Returns the rows added per fact, the commit's number and
    the buckets written per dimension."""
    store = Store(spark, root)
    run = store.begin(window.batch_id, started_at)
    wrote = {}
    wrote["competition"] = merge_dimension(run, "competition", WH.competition_incoming(staging["competitions"], staging["countries"]),
                                           L.COMPETITION_SPEC, run_date)
    wrote["club"] = merge_dimension(run, "club", WH.club_incoming(staging["clubs"], staging["national_teams"], run.read("dim_competition")),
                                    WH.CLUB_SPEC, run_date)
    fact_clubs = L._fact_clubs(staging)
    wrote["club"] += merge_dimension(run, "club", L.inferred_rows(fact_clubs, run.read("dim_club")), WH.CLUB_SPEC, run_date)
    wrote["player"] = merge_dimension(run, "player", WH.player_incoming(staging["players"]), WH.PLAYER_SPEC, run_date)
    wrote["match"] = merge_dimension(run, "match", WH.match_incoming(staging["games"]), L.MATCH_SPEC, run_date)
    wrote["manager"] = _insert_members(run, "manager", WH.manager_members(staging["club_games"]), "manager_name", "manager_key")
    dims = {name: run.read(f"dim_{name}") for name in L.DIM_SCHEMAS} | {"season": star.dim_season(spark)}

    added, rejects = {}, [WH.code_audit(staging, dims, window.batch_id), WH.inferred_club_rejects(fact_clubs, window.batch_id),
                          WH.dimension_rejects(staging, window.batch_id)]
    for name in L.FACT_KEYS:
        added[name], bad = load_fact(run, name, staging, dims, window)
        rejects.append(bad)
    log = rejects[0]
    for r in rejects[1:]:
        log = log.unionByName(r)
    run.replace("etl_reject", log.select(*[F.col(f.name).cast(f.dataType) for f in REJECT_SCHEMA.fields]))
    run.replace("mv_club_season_standing", WH.maintain_standing_rollup(run.read("mv_club_season_standing"), run.read("fact_team_match")))
    rows = {name: store.info.get("rows", {}).get(name, 0) + added[name] for name in added}
    number = run.commit(window_from=window.load_from, window_to=window.load_to, finished_at=f"{dt.datetime.now():%Y%m%dT%H%M%S%f}",
                        rows=rows, added=added)
    return {**added, "commit": number, "buckets": {k: sorted(set(v)) for k, v in wrote.items()}}
