"""Warehouse load: generated dimensions, SCD merges, fact loads, incremental windows, journal.

All set-based. A dimension merge is one classified join of the incoming rows with the
current versions, then a union of untouched / updated / closed / new rows; facts are
appended after an anti-join on *natural* keys, so a re-run of the same window adds 0
rows even after a dimension got a new SCD2 version.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickstar import fixed
from kickstar.functions import exprs as X
from kickstar.operators import dedup as D
from kickstar.operators import joins as J
from kickstar.operators import keys as K
from kickstar.operators import route as R

# ------------------------------------------------------------------ generated dimensions


def gen_dim_date(spark: SparkSession, start: str | Column = fixed.DATE_DIM_START,
                 end: str | Column = fixed.DATE_DIM_END, run_date: str = "2026-01-01",
                 span: DataFrame | None = None) -> DataFrame:
    """Calendar rows start..end (or the span of a one-row frame with ``start``/``end``) + unknown.

    Monday = 1; weekend = 6, 7; ``is_future_date`` is fixed at creation from ``run_date``."""
    if span is None:
        span = spark.range(1).select(F.to_date(F.lit(start)).alias("start"), F.to_date(F.lit(end)).alias("end"))
    days = span.select(F.explode(F.sequence("start", "end")).alias("full_date"))
    dow = X.day_of_week_monday1(F.col("full_date"))
    real = days.select(
        X.date_key(F.col("full_date")).alias("date_key"), "full_date",
        dow.cast("int").alias("day_of_week"), F.substring(F.date_format("full_date", "EEEE"), 1, 10).alias("day_name"),
        F.when(dow.isin(6, 7), 1).otherwise(0).alias("is_weekend"),
        F.month("full_date").alias("month"), F.substring(F.date_format("full_date", "MMMM"), 1, 10).alias("month_name"),
        F.quarter("full_date").alias("quarter"), F.year("full_date").alias("year"),
        F.when(F.col("full_date") > F.to_date(F.lit(run_date)), 1).otherwise(0).alias("is_future_date"))
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in real.schema.fields])
    unknown = spark.createDataFrame([(-1, None, 0, "Unknown", 0, 0, "Unknown", 0, 0, 0)], nullable)
    return real.unionByName(unknown)


def gen_dim_age(valuation: DataFrame, transfer: DataFrame) -> DataFrame:
    """Ages seen in either fact (NULL -> key 0) with the age group and its sort order."""
    ages = D.union_distinct([valuation.select(X.null_to_zero_key("age_at_valuation").alias("age_key")),
                             transfer.select(X.null_to_zero_key("age_at_transfer").alias("age_key"))])
    label, order = X.age_group6(F.col("age_key"))
    return ages.select("age_key", label.alias("age_group"), order.alias("age_group_order"))


def dim_labels(dim_date: DataFrame) -> DataFrame:
    """Display labels of the date dimension (month, quarter, dd/MM/yyyy)."""
    return dim_date.select("*", X.month_label("full_date").alias("month_label"),
                           X.quarter_label("full_date").alias("quarter_label"),
                           X.date_label("full_date").alias("date_label"))


# ------------------------------------------------------------------ SCD merge


@dataclass(frozen=True)
class ScdSpec:
    natural_key: str
    surrogate: str
    scd1: tuple[str, ...] = ()
    scd2: tuple[str, ...] = ()
    scd3_trigger: str | None = None                 # column whose change shifts the previous value
    scd3_current: tuple[str, ...] = ()              # columns overwritten on the current row only
    scd3_previous: dict[str, str] = field(default_factory=dict)   # previous_col -> current_col
    valid_from: str = "effective_date"
    valid_to: str = "expiry_date"
    current: str = "is_current"


def _changed(cols: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | X.null_safe_changed(F.col(f"n__{c}"), F.col(f"o__{c}"))
    return out


def scd_actions(dim: DataFrame, incoming: DataFrame, spec: ScdSpec) -> DataFrame:
    """The incoming rows that are new or change their member: ``__nk``, the new values (``n__``),
    the current ones (``o__``) and ``__action`` (new, scd2, scd3 or scd1; first match wins)."""
    tracked = _tracked(spec)
    current = dim.filter(F.col(spec.current) & (F.col(spec.surrogate) > 0))
    old = current.select(F.col(spec.natural_key).alias("__nk"), F.col(spec.surrogate).alias("o__key"),
                         *[F.col(c).alias(f"o__{c}") for c in tracked + list(spec.scd3_previous)])
    new = incoming.select(F.col(spec.natural_key).alias("__nk"), *[F.col(c).alias(f"n__{c}") for c in tracked])
    j = new.join(old, "__nk", "left")
    trig = _changed([spec.scd3_trigger]) if spec.scd3_trigger else F.lit(False)
    action = (F.when(F.col("o__key").isNull(), F.lit("new"))
              .when(_changed(spec.scd2), F.lit("scd2"))
              .when(trig, F.lit("scd3"))
              .when(_changed(spec.scd1), F.lit("scd1"))
              .otherwise(F.lit("none")))
    return j.withColumn("__action", action).filter(F.col("__action") != "none")


def _tracked(spec: ScdSpec) -> list[str]:
    return list(dict.fromkeys(spec.scd1 + spec.scd2 + spec.scd3_current + ((spec.scd3_trigger,) if spec.scd3_trigger else ())))


def scd_merge(dim: DataFrame, incoming: DataFrame, spec: ScdSpec, run_date: str,
              new_member_from: str = fixed.SCD_FIRST_START, key_base: int | None = None) -> DataFrame:
    """Merge ``incoming`` (one row per natural key, dimension column names) into ``dim``.

    Ordered classification (first match wins): SCD2 change → new version (old closed at
    run_date - 1, new open run_date..9999-12-31, carrying all new values, shifting the
    previous value if the SCD3 trigger changed too); SCD3 change → current row only;
    SCD1 change → overwrite every version of the member; else unchanged. New members get
    new keys from ``new_member_from``. Special members (key <= 0) are never touched. New keys
    follow ``key_base``, by default the largest key of ``dim``."""
    nk, sk = spec.natural_key, spec.surrogate
    tracked = _tracked(spec)
    j = scd_actions(dim, incoming, spec)

    # existing rows: apply SCD1 (all versions), SCD3 / close (current row)
    acts = j.select("__nk", "__action", *[f"n__{c}" for c in tracked],
                    *[F.col(f"o__{cur}").alias(f"s3__{prev}") for prev, cur in spec.scd3_previous.items()])
    d = dim.join(acts, dim[nk] == acts["__nk"], "left")
    a = F.col("__action")
    is_cur = F.col(spec.current) & (F.col(sk) > 0)
    cols = []
    for c in dim.columns:
        col = F.col(c)
        if c in spec.scd1:
            col = F.when(a == "scd1", F.col(f"n__{c}")).otherwise(col)
        if c in spec.scd3_current or c == spec.scd3_trigger:
            col = F.when((a == "scd3") & is_cur, F.col(f"n__{c}")).otherwise(col)
        if c in spec.scd3_previous:
            col = F.when((a == "scd3") & is_cur, F.col(f"s3__{c}")).otherwise(col)
        if c == spec.valid_to:
            col = F.when((a == "scd2") & is_cur, F.date_sub(F.to_date(F.lit(run_date)), 1)).otherwise(col)
        if c == spec.current:
            col = F.when((a == "scd2") & is_cur, F.lit(False)).otherwise(col)
        cols.append(col.cast(dim.schema[c].dataType).alias(c))
    existing = d.select(*cols)

    # new rows: new members and new SCD2 versions
    def built(rows: DataFrame, start: str, version: bool) -> DataFrame:
        sel = []
        for c in dim.columns:
            if c == nk:
                v = F.col("__nk")
            elif c in tracked:
                v = F.col(f"n__{c}")
            elif c in spec.scd3_previous:
                cur = spec.scd3_previous[c]
                v = (F.when(_changed([spec.scd3_trigger]), F.col(f"o__{cur}")).otherwise(F.col(f"o__{c}"))
                     if version and spec.scd3_trigger else F.lit(None))
            elif c == spec.valid_from:
                v = F.to_date(F.lit(start))
            elif c == spec.valid_to:
                v = F.to_date(F.lit(fixed.SCD_OPEN_END))
            elif c == spec.current:
                v = F.lit(True)
            elif c == sk:
                v = F.lit(None)
            else:
                v = F.lit(None)
            sel.append(v.cast(dim.schema[c].dataType).alias(c))
        return rows.select(*sel)

    fresh = built(j.filter(a == "new"), new_member_from, False).unionByName(
        built(j.filter(a == "scd2"), run_date, True))
    base = dim.agg(F.coalesce(F.max(F.when(F.col(sk) > 0, F.col(sk))), F.lit(0)).alias("__base"))
    if key_base is not None:
        base = dim.sparkSession.range(1).select(F.lit(key_base).cast("long").alias("__base"))
    keyed = K.global_positions(fresh.drop(sk), [F.col(nk), F.col(spec.valid_from)], "__pos")
    keyed = keyed.crossJoin(F.broadcast(base)).withColumn(sk, (F.col("__base") + F.col("__pos")).cast(
        dim.schema[sk].dataType)).drop("__base", "__pos")
    return existing.unionByName(keyed.select(*dim.columns))


# club / player specs (attribute names as in the warehouse)
CLUB_SPEC = ScdSpec(
    natural_key="club_id", surrogate="club_key",
    scd1=("club_name", "club_type", "country_name", "confederation"),
    scd2=("stadium_name", "stadium_capacity_band"),
    scd3_trigger="current_league_id", scd3_current=("current_league_name",),
    scd3_previous={"previous_league_name": "current_league_name"})
PLAYER_SPEC = ScdSpec(
    natural_key="player_id", surrogate="player_key",
    scd1=("full_name", "date_of_birth", "country_of_birth", "citizenship", "foot", "height_band",
          "contract_expiry_year", "international_caps_band"),
    scd2=("position", "sub_position", "agent_name"))


def insert_only(dim: DataFrame, incoming: DataFrame, natural_key: str, surrogate: str, key_base: int | None = None) -> DataFrame:
    """Insert-only member load (managers; prototype SCD1): new natural keys get new keys."""
    new = J.anti_join(incoming.select(natural_key).distinct(), dim.select(natural_key), natural_key)
    base = dim.agg(F.coalesce(F.max(F.when(F.col(surrogate) > 0, F.col(surrogate))), F.lit(0)).alias("__b"))
    if key_base is not None:
        base = dim.sparkSession.range(1).select(F.lit(key_base).cast("long").alias("__b"))
    keyed = K.global_positions(new, [F.col(natural_key)], "__pos").crossJoin(F.broadcast(base))
    keyed = keyed.select((F.col("__b") + F.col("__pos")).cast(dim.schema[surrogate].dataType).alias(surrogate),
                         natural_key)
    return dim.unionByName(keyed, allowMissingColumns=True)


def manager_members(club_games: DataFrame) -> DataFrame:
    """Manager names from the own and opponent columns, cleaned and ligature-folded, distinct;
    a blank name becomes the unknown label (which maps to the -1 member)."""
    names = D.union_all([club_games.select(F.col("own_manager_name").alias("n")),
                         club_games.select(F.col("opponent_manager_name").alias("n"))])
    clean = X.default_label(X.fold_ligatures(X.clean_text("n")))
    return names.select(clean.alias("manager_name")).distinct()


def _fact_clubs(fact_clubs: Sequence[DataFrame]) -> DataFrame:
    """(club_id, club_name, batch_id) as cleaned text from frames whose columns are the id and,
    where the source has them, the name and the batch; special codes are left out."""
    def part(f: DataFrame) -> DataFrame:
        rest = [X.clean_text(f.columns[1]) if len(f.columns) > 1 else F.lit(None).cast("string"),
                F.col(f.columns[2]) if len(f.columns) > 2 else F.lit(None).cast("string")]
        return f.select(X.clean_text(f.columns[0]).alias("club_id"), rest[0].alias("club_name"), rest[1].alias("batch_id"))
    ids = D.union_all([part(f) for f in fact_clubs])
    return ids.filter(F.col("club_id").isNotNull() & ~X.is_excluded_code(F.col("club_id"))).distinct()


def inferred_clubs(fact_clubs: Sequence[DataFrame], dim: DataFrame) -> DataFrame:
    """Clubs referenced by facts but absent from the club dimension (any version): the name
    is the source's (of several the smallest), else 'CLB <id>'; the type is the out-of-data
    label. Ids that do not cast are given by :func:`inferred_club_rejects`."""
    ids = _fact_clubs(fact_clubs).select(F.col("club_id").try_cast("int").cast("long").alias("club_id"), "club_name")
    one = ids.filter(F.col("club_id").isNotNull()).groupBy("club_id").agg(F.min("club_name").alias("club_name"))
    missing = J.anti_join(one, dim.select("club_id"), "club_id")
    return missing.select("club_id", F.coalesce("club_name", F.concat(F.lit(fixed.INFERRED_CLUB_PREFIX), F.col("club_id").cast("string")))
                          .alias("club_name"), F.lit(fixed.INFERRED_CLUB_NAME).alias("club_type"))


def inferred_club_rejects(fact_clubs: Sequence[DataFrame], batch_id: str) -> DataFrame:
    """Reject-log rows of club ids in facts that do not cast."""
    bad = _fact_clubs(fact_clubs).filter(F.col("club_id").try_cast("int").isNull()).select("club_id").distinct()
    return R.to_reject_log(bad.withColumn(R.REASON, F.lit("cast error (club_id)")), batch_id, "fact_clubs", F.col("club_id"))


# ------------------------------------------------------------------ facts from staging

@dataclass(frozen=True)
class LoadWindow:
    load_from: str
    load_to: str
    batch_id: str


def load_fact_player_valuation(stg: DataFrame, dim_player: DataFrame, dim_club: DataFrame,
                               existing_fact: DataFrame, window: LoadWindow,
                               dim_competition: DataFrame | None = None,
                               keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """Staged valuations -> fact rows + rejects.

    Order matters: de-duplicate (latest batch per player and day) → value change by LAG
    over the player's whole history → skip rows already in the fact (natural keys) →
    cast / validate / window → derive → key lookups (miss -> -1)."""
    s = stg.select(
        X.clean_text("player_id").alias("player_id"), X.clean_date_text("date").alias("date_raw"),
        X.clean_text("market_value_in_eur").alias("market_value"),
        X.remap_club_code(X.clean_text("current_club_id")).alias("current_club_id"),
        X.blank_to_code("player_club_domestic_competition_id").alias("competition_id"),
        "batch_id", F.col("source_row"))
    s = s.withColumn("d", F.try_to_date(F.col("date_raw"), "yyyy-MM-dd"))
    s = D.dedup_latest(s, ["player_id", "d"], ["batch_id", "source_row"])
    mv = F.col("market_value").try_cast("long")
    w = Window.partitionBy("player_id").orderBy("d")     # ≤ one row per day per player
    s = s.withColumn("value_change_eur", mv - F.lag(mv).over(w))
    done = existing_fact.join(dim_player.select("player_key", "player_id"), "player_key") \
        .select(F.col("player_id").cast("string").alias("player_id"), F.col("date_key").alias("__dk"))
    s = s.withColumn("__dk", X.date_key(F.col("d"))).join(done, ["player_id", "__dk"], "left_anti").drop("__dk")
    s = keep(s)                                                            # facts and rejects read the same rows
    casts = {"player_id": "int", "market_value": "long", "date_raw": "date"}
    rules = [(F.col("c_player_id").isNull(), "player_id missing"),
             (F.col("c_date_raw").isNull(), "date missing"),
             (F.col("c_market_value").isNotNull() & (F.col("c_market_value") < 0), "negative market value")]
    valid = _valid(s, casts, rules, F.col("c_date_raw"), window)
    players = dim_player.filter(F.col("is_current")).select(
        F.col("player_id").cast("int").alias("c_player_id"), "player_key", "date_of_birth")
    clubs = dim_club.filter(F.col("is_current")).select(F.col("club_id").cast("string").alias("current_club_id"),
                                                        F.col("club_key"))
    f = valid.join(players, "c_player_id", "left").join(clubs, "current_club_id", "left")
    if dim_competition is not None:
        f = f.join(dim_competition.select(F.col("competition_id"), "competition_key"), "competition_id", "left")
    else:
        f = f.withColumn("competition_key", F.lit(None).cast("int"))
    f = J.unknown_key(f, "player_key", "club_key", "competition_key")
    fact = f.select(
        "player_key", X.date_key(F.col("c_date_raw")).alias("date_key"), "club_key", "competition_key",
        F.col("c_market_value").alias("market_value_eur"), "value_change_eur",
        X.age_in_range(F.col("date_of_birth"), F.col("c_date_raw"), 14, 100).alias("age_at_valuation"),
        F.lit(1).alias("valuation_count"), F.lit(window.batch_id).alias("batch_id"))
    return fact, _rejects(s, casts, rules, window, "player_valuations", F.concat_ws("|", F.col("player_id"), F.col("date_raw")))


def assign_batches(df: DataFrame, date_col: Column, windows: Sequence[LoadWindow]) -> DataFrame:
    """Incremental loads in sequence, set-wise: a row is added by the first window that
    contains its date (later windows skip it as already loaded); rows in no window are not
    loaded. Re-running a window adds no row."""
    out = None
    for w in windows:
        cond = R.load_window_filter(date_col, w.load_from, w.load_to)
        out = F.when(cond, F.lit(w.batch_id)) if out is None else out.when(cond, F.lit(w.batch_id))
    return df.withColumn("batch_id", out).filter(F.col("batch_id").isNotNull())


def incremental_append(spark: SparkSession, new_rows: DataFrame, fact_path: str, natural_key: Sequence[str],
                       schema: T.StructType, partition_by: Sequence[str] | None = None,
                       existing_filter: Column | None = None) -> int:
    """Append the rows whose natural key is not in the fact yet; returns the rows added.

    The rows to add are materialised (shared checkpoint folder) before the write so the
    anti-join is not re-evaluated against the table it is appending to.
    ``existing_filter`` narrows the fact rows that can collide (e.g. the load window's
    date range), so the anti-join scans that slice rather than the whole fact."""
    from kickstar.sources import sinks
    existing = sinks.read_or_empty(spark, fact_path, schema)
    if existing_filter is not None:
        existing = existing.filter(existing_filter)
    from kickstar.frames import materialize
    todo = materialize(J.anti_join(new_rows, existing.select(*natural_key), list(natural_key)), "append")
    n = todo.count()
    if n:
        sinks.append(todo.select(*schema.fieldNames()), fact_path, list(partition_by) if partition_by else None)
    return n


JOURNAL_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()), T.StructField("batch_id", T.StringType()),
    T.StructField("window_from", T.DateType()), T.StructField("window_to", T.DateType()),
    T.StructField("started_at", T.TimestampType()), T.StructField("finished_at", T.TimestampType()),
    T.StructField("status", T.StringType()), T.StructField("fact_rows_before", T.LongType()),
    T.StructField("fact_rows_after", T.LongType()),
])


def journal_start(journal: DataFrame, batch_id: str, window: LoadWindow, started_at, rows_before: int) -> DataFrame:
    """New RUNNING row; stale RUNNING rows of earlier runs become FAILED (snapshot rewrite)."""
    spark = journal.sparkSession
    fixed_old = journal.withColumn("status", F.when(F.col("status") == "RUNNING", F.lit("FAILED"))
                                   .otherwise(F.col("status")))
    nxt = journal.agg(F.coalesce(F.max("run_id"), F.lit(0)).alias("m"))
    row = spark.createDataFrame([(batch_id, window.load_from, window.load_to, started_at, rows_before)],
                                "batch_id string, f string, t string, started_at timestamp, before long")
    row = row.crossJoin(nxt).select(
        (F.col("m") + 1).cast("long").alias("run_id"), "batch_id", F.to_date("f").alias("window_from"),
        F.to_date("t").alias("window_to"), "started_at", F.lit(None).cast("timestamp").alias("finished_at"),
        F.lit("RUNNING").alias("status"), F.col("before").alias("fact_rows_before"),
        F.lit(None).cast("long").alias("fact_rows_after"))
    return fixed_old.unionByName(row)


def journal_finish(journal: DataFrame, batch_id: str, finished_at, rows_after: int) -> DataFrame:
    hit = (F.col("batch_id") == batch_id) & (F.col("status") == "RUNNING")
    return journal.withColumns({
        "status": F.when(hit, F.lit("SUCCESS")).otherwise(F.col("status")),
        "finished_at": F.when(hit, F.lit(finished_at).cast("timestamp")).otherwise(F.col("finished_at")),
        "fact_rows_after": F.when(hit, F.lit(rows_after).cast("long")).otherwise(F.col("fact_rows_after")),
    })


def load_window_record(spark: SparkSession, window: LoadWindow) -> DataFrame:
    """The one-row load-window control table."""
    return spark.range(1).select(F.to_date(F.lit(window.load_from)).alias("window_from"),
                                 F.to_date(F.lit(window.load_to)).alias("window_to"),
                                 F.lit(window.batch_id).alias("batch_id"))


def maintain_standing_rollup(stored: DataFrame | None, team_match: DataFrame) -> DataFrame:
    """Keep the season × club SUM/COUNT rollup current: seasons whose stored matches differ
    from the fact's rows are aggregated anew from their partitions, the others are kept.

    The fact itself says what is missing, so a run that died between the append and the
    rollup is made up for by the next one, and no batch can be counted twice."""
    from kickstar.plans.questions import standing_rollup
    if stored is None:
        return standing_rollup(team_match)
    there = team_match.groupBy("season_key").agg(F.count(F.lit(1)).alias("n"))
    have = stored.groupBy("season_key").agg(F.sum("matches").alias("m"))
    stale = there.join(have, "season_key", "full").filter(~F.col("n").eqNullSafe(F.col("m"))).select("season_key")
    kept = stored.join(F.broadcast(stale), "season_key", "left_anti")                 # seasons: ≤ 43 rows
    return kept.unionByName(standing_rollup(team_match.join(F.broadcast(stale), "season_key", "left_semi")))


# ------------------------------------------------------------------ the other three fact loads

def _current_keys(dim: DataFrame, natural: str, key: str, out_nat: str, out_key: str, extra=()) -> DataFrame:
    """Current-version lookup table natural id (as text) -> surrogate key (facts point at the
    version current at load time)."""
    cur = dim.filter(F.col("is_current")) if "is_current" in dim.columns else dim
    return cur.select(F.col(natural).cast("string").alias(out_nat), F.col(key).alias(out_key), *extra)


def _valid(s: DataFrame, casts: dict[str, str], rules: list[tuple[Column, str]], date: Column, window: LoadWindow) -> DataFrame:
    """The rows of the window that cast and break no rule, with their typed columns."""
    ok, _ = R.cast_or_reject(s, casts)
    return R.validate_or_reject(ok, rules, window=R.load_window_filter(date, window.load_from, window.load_to))[0]


def _rejects(s: DataFrame, casts: dict[str, str], rules: list[tuple[Column, str]], window: LoadWindow, table: str, key: Column) -> DataFrame:
    return R.to_reject_log(R.rejected(s, casts, rules), window.batch_id, table, key)


def load_fact_team_match(stg_club_games: DataFrame, stg_games: DataFrame, dims: dict[str, DataFrame],
                         existing_fact: DataFrame, window: LoadWindow,
                         keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """Staged club_games (+ games for date, season, competition) -> team × match rows.

    dims: match (game_id, match_key), club, competition (competition_id), season
    (season_start_year), manager (manager_name)."""
    g = stg_games.select(X.clean_text("game_id").alias("game_id"), X.clean_text("competition_id").alias("g_comp"),
                         X.clean_text("season").alias("g_season"), X.clean_date_text("date").alias("game_date_raw"),
                         "batch_id", "source_row")
    g = D.dedup_latest(g, ["game_id"], ["batch_id", "source_row"]).drop("batch_id", "source_row")
    s = stg_club_games.select(
        X.clean_text("game_id").alias("game_id"), X.clean_text("club_id").alias("club_id"),
        X.clean_text("own_goals").alias("own_goals"), X.sentinel_to_null("own_position").alias("own_position"),
        X.fold_ligatures(X.clean_text("own_manager_name")).alias("own_manager_name"),
        X.clean_text("opponent_id").alias("opponent_id"), X.clean_text("opponent_goals").alias("opponent_goals"),
        X.fold_ligatures(X.clean_text("opponent_manager_name")).alias("opponent_manager_name"),
        X.clean_text("hosting").alias("hosting"), "batch_id", "source_row")
    # latest batch, then row id, then the values: a total order even for repeated source rows
    s = D.dedup_latest(s, ["game_id", "club_id"],
                       ["batch_id", "source_row", "own_goals", "opponent_goals", "opponent_id", "hosting",
                        "own_position", "own_manager_name", "opponent_manager_name"])
    s = s.join(g, "game_id", "left")                                        # lookup_enrich: date, season
    done = existing_fact.join(dims["match"].select("match_key", "game_id"), "match_key") \
        .join(dims["club"].select("club_key", "club_id"), "club_key") \
        .select(F.col("game_id").cast("string").alias("game_id"), F.col("club_id").cast("string").alias("club_id"))
    s = keep(s.join(done, ["game_id", "club_id"], "left_anti"))            # natural-key anti-join at source
    casts = {"game_id": "int", "club_id": "int", "own_goals": "int", "own_position": "int", "opponent_id": "int",
             "opponent_goals": "int", "game_date_raw": "date"}
    rules = [(F.col("c_game_id").isNull() | F.col("c_club_id").isNull() | F.col("c_own_goals").isNull()
              | F.col("c_opponent_goals").isNull() | F.col("c_game_date_raw").isNull(), "missing required value")]
    valid = _valid(s, casts, rules, F.col("c_game_date_raw"), window)
    gf, ga = F.col("c_own_goals"), F.col("c_opponent_goals")
    f = valid.withColumns({"own_manager_name": X.default_label("own_manager_name"),
                           "opponent_manager_name": X.default_label("opponent_manager_name")})
    f = (f.join(_current_keys(dims["match"], "game_id", "match_key", "game_id", "match_key"), "game_id", "left")
         .join(_current_keys(dims["club"], "club_id", "club_key", "club_id", "club_key"), "club_id", "left")
         .join(_current_keys(dims["club"], "club_id", "club_key", "opponent_id", "opponent_club_key"),
               "opponent_id", "left")
         .join(_current_keys(dims["competition"], "competition_id", "competition_key", "g_comp",
                             "competition_key"), "g_comp", "left")
         .join(_current_keys(dims["season"], "season_start_year", "season_key", "g_season", "season_key"),
               "g_season", "left")
         .join(_current_keys(dims["manager"], "manager_name", "manager_key", "own_manager_name", "manager_key"),
               "own_manager_name", "left")
         .join(_current_keys(dims["manager"], "manager_name", "manager_key", "opponent_manager_name",
                             "opponent_manager_key"), "opponent_manager_name", "left"))
    f = J.unknown_key(f, "match_key", "club_key", "opponent_club_key", "competition_key", "season_key",
                      "manager_key", "opponent_manager_key")
    outcome = X.match_outcome(gf, ga)
    fact = f.select("match_key", "club_key", "opponent_club_key", "competition_key", "season_key",
                    X.date_key(F.col("c_game_date_raw")).alias("date_key"), "manager_key", "opponent_manager_key",
                    X.is_home(F.col("hosting")).alias("is_home"), gf.alias("goals_for"), ga.alias("goals_against"),
                    *[c.alias(n) for n, c in outcome.items()], F.col("c_own_position").alias("league_position"),
                    F.lit(window.batch_id).alias("batch_id"))
    # sink check on surrogate keys as well (the source anti-join is the one that survives SCD2)
    fact = fact.join(existing_fact.select("match_key", "club_key"), ["match_key", "club_key"], "left_anti")
    return fact, _rejects(s, casts, rules, window, "club_games", F.concat_ws("|", F.col("game_id"), F.col("club_id")))


def load_fact_player_appearance(stg: DataFrame, stg_games: DataFrame, dims: dict[str, DataFrame],
                                existing_fact: DataFrame, window: LoadWindow,
                                keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """Staged appearances -> player × match rows, with the range checks of the source."""
    g = stg_games.select(X.clean_text("game_id").alias("game_id"), X.clean_text("season").alias("g_season"),
                         "batch_id", "source_row")
    g = D.dedup_latest(g, ["game_id"], ["batch_id", "source_row"]).drop("batch_id", "source_row")
    cols = ["appearance_id", "game_id", "player_id", "player_club_id", "competition_id", "yellow_cards",
            "red_cards", "goals", "assists", "minutes_played"]
    s = stg.select(*[X.clean_text(c).alias(c) for c in cols], X.clean_date_text("date").alias("date_raw"),
                   "batch_id", "source_row")
    s = D.dedup_latest(s, ["appearance_id"], ["batch_id", "source_row", "date_raw"] + cols[1:])
    s = keep(s.join(existing_fact.select("appearance_id"), "appearance_id", "left_anti").join(g, "game_id", "left"))
    ints = ["game_id", "player_id", "player_club_id", "yellow_cards", "red_cards", "goals", "assists",
            "minutes_played"]
    casts = {**{c: "int" for c in ints}, "date_raw": "date"}
    c = F.col
    rules = [
        (c("c_game_id").isNull() | c("c_player_id").isNull() | c("c_date_raw").isNull()
         | c("c_minutes_played").isNull() | c("c_goals").isNull() | c("c_assists").isNull()
         | c("c_yellow_cards").isNull() | c("c_red_cards").isNull(), "missing required value"),
        ((c("c_minutes_played") < 0) | (c("c_minutes_played") > fixed.MINUTES_MAX), "minutes out of range"),
        ((c("c_goals") < 0) | (c("c_assists") < 0) | (c("c_yellow_cards") < 0) | (c("c_red_cards") < 0),
         "negative count")]
    valid = _valid(s, casts, rules, c("c_date_raw"), window)
    f = (valid.join(_current_keys(dims["match"], "game_id", "match_key", "game_id", "match_key"), "game_id", "left")
         .join(_current_keys(dims["player"], "player_id", "player_key", "player_id", "player_key"), "player_id",
               "left")
         .join(_current_keys(dims["club"], "club_id", "club_key", "player_club_id", "club_key"), "player_club_id",
               "left")
         .join(_current_keys(dims["competition"], "competition_id", "competition_key", "competition_id",
                             "competition_key"), "competition_id", "left")
         .join(_current_keys(dims["season"], "season_start_year", "season_key", "g_season", "season_key"),
               "g_season", "left"))
    f = J.unknown_key(f, "match_key", "player_key", "club_key", "competition_key", "season_key")
    fact = f.select("appearance_id", "match_key", "player_key", "club_key", "competition_key", "season_key",
                    X.date_key(c("c_date_raw")).alias("date_key"), c("c_minutes_played").alias("minutes_played"),
                    c("c_goals").alias("goals"), c("c_assists").alias("assists"),
                    c("c_yellow_cards").alias("yellow_cards"), c("c_red_cards").alias("red_cards"),
                    F.lit(1).alias("appearance_count"), F.lit(window.batch_id).alias("batch_id"))
    return fact, _rejects(s, casts, rules, window, "appearances", c("appearance_id"))


def load_fact_transfer(stg: DataFrame, dims: dict[str, DataFrame], existing_fact: DataFrame,
                       window: LoadWindow,
                       keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """Staged transfers -> deals: fee kept NULL when undisclosed (≠ 0 = free / loan), fee
    status and band -> transfer type key, premium, age and youth flag."""
    s = stg.select(
        X.clean_text("player_id").alias("player_id"), X.clean_date_text("transfer_date").alias("date_raw"),
        X.clean_text("transfer_season").alias("transfer_season"),
        X.remap_club_code(X.clean_text("from_club_id")).alias("from_club_id"),
        X.remap_club_code(X.clean_text("to_club_id")).alias("to_club_id"),
        X.clean_text("transfer_fee").alias("transfer_fee"), X.clean_text("market_value_in_eur").alias("mv"),
        "batch_id", "source_row")
    # latest batch wins; equal batches fall back to the row id, then the values (a total order)
    s = D.dedup_latest(s, ["player_id", "date_raw", "from_club_id", "to_club_id"],
                       ["batch_id", "source_row", "transfer_fee", "mv"])
    # deals of the window that are in the fact already, by the natural ids of any version of
    # the player and the clubs: a club that got a new version since keeps its deals. Dates meet as
    # the text of the key, so the join finds the rows as the de-duplication spread them
    lo, hi = (X.date_key(F.to_date(F.lit(x))) for x in (window.load_from, window.load_to))
    loaded = existing_fact.filter(F.col("date_key").between(lo, hi)).select("player_key", "date_key", "from_club_key", "to_club_key")
    club_ids = dims["club"].select("club_key", F.col("club_id").cast("string").alias("club_id"))
    done = (loaded.join(club_ids.withColumnsRenamed({"club_key": "from_club_key", "club_id": "__f"}), "from_club_key")
            .join(club_ids.withColumnsRenamed({"club_key": "to_club_key", "club_id": "__t"}), "to_club_key")
            .join(dims["player"].select("player_key", F.col("player_id").cast("string").alias("__pid")), "player_key")
            .select("__pid", F.date_format(F.try_to_date(F.col("date_key").cast("string"), "yyyyMMdd"), "yyyy-MM-dd").alias("__d"),
                    "__f", "__t"))
    s = s.join(done, (s.player_id == done["__pid"]) & (s.date_raw == done["__d"]) & (s.from_club_id == done["__f"])
               & (s.to_club_id == done["__t"]), "left_anti")
    s = keep(s)
    c = F.col
    casts = {"player_id": "int", "date_raw": "date", "from_club_id": "int", "to_club_id": "int",
             "transfer_fee": "decimal(19,3)", "mv": "decimal(19,3)"}
    rules = [(c("c_player_id").isNull() | c("c_date_raw").isNull(), "missing required value"),
             (c("c_transfer_fee").isNotNull() & (c("c_transfer_fee") < 0), "negative fee"),
             (c("c_mv").isNotNull() & (c("c_mv") < 0), "negative market value")]
    valid = _valid(s, casts, rules, c("c_date_raw"), window)
    players = dims["player"].filter(c("is_current")).select(c("player_id").cast("string").alias("player_id"),
                                                              "player_key", "date_of_birth")
    seasons = dims["season"].select(c("season_short").alias("transfer_season"), "season_key")
    # clubs and seasons first: what is moved to the players are keys and numbers, no text but the id
    f = valid.select("player_id", "transfer_season", "from_club_id", "to_club_id", c("c_date_raw").alias("__date"),
                     c("c_transfer_fee").cast("long").alias("transfer_fee_eur"), c("c_mv").cast("long").alias("market_value_eur"))
    f = (f.join(F.broadcast(seasons), "transfer_season", "left")
         .join(_current_keys(dims["club"], "club_id", "club_key", "from_club_id", "from_club_key"), "from_club_id",
               "left")
         .join(_current_keys(dims["club"], "club_id", "club_key", "to_club_id", "to_club_key"), "to_club_id", "left")
         .join(players, "player_id", "left"))
    f = J.unknown_key(f, "player_key", "from_club_key", "to_club_key", "season_key")
    f = f.select("player_key", X.date_key(c("__date")).alias("date_key"), "season_key", "from_club_key", "to_club_key",
                 "transfer_fee_eur", "market_value_eur", "date_of_birth", "__date")
    # clubs that were unknown when the deal was loaded have no natural id in the fact: the keys
    # decide. What follows from other columns is added after the rows were moved
    f = f.join(loaded, ["player_key", "date_key", "from_club_key", "to_club_key"], "left_anti")
    fee, mv, d = c("transfer_fee_eur"), c("market_value_eur"), c("__date")
    fact = f.select("player_key", "date_key", "season_key", "from_club_key", "to_club_key",
                    X.transfer_type_key(fee).cast("int").alias("transfer_type_key"), "transfer_fee_eur",
                    "market_value_eur", X.fee_premium(fee, mv).alias("fee_premium_eur"),
                    X.age_in_range(c("date_of_birth"), d, 0, 100).alias("age_at_transfer"),
                    X.youth_flag(c("date_of_birth"), d).alias("is_youth_transfer"),
                    F.lit(1).alias("transfer_count"), F.lit(window.batch_id).alias("batch_id"))
    return fact, _rejects(s, casts, rules, window, "transfers",
                          F.concat_ws("|", c("player_id"), c("date_raw"), c("from_club_id"), c("to_club_id")))


def code_audit(staging: dict[str, DataFrame], dims: dict[str, DataFrame], batch_id: str) -> DataFrame:
    """Reject-log rows of source rows whose competition or player is not in its dimension (the
    fact is loaded with key -1 all the same); blank codes are not errors.

    Competitions of club games (through their game), appearances and valuations, players of
    appearances and transfers; one row per source row, under its natural key. The anti-joins
    are on the code; one that very many rows share is split by adaptive execution."""
    comps = dims["competition"].select(F.col("competition_id").alias("__code")).distinct()
    players = dims["player"].select(F.col("player_id").cast("int").cast("string").alias("__code")).distinct()
    games = staging["games"].select(X.clean_text("game_id").alias("__gid"), X.clean_text("competition_id").alias("__comp")).distinct()
    club_games = staging["club_games"].join(games, X.clean_text("game_id") == F.col("__gid"))
    number = lambda c: F.col(c).try_cast("int").cast("string")
    day = lambda c: F.substring(F.col(c), 1, 10)
    checks = [
        ("club_games", club_games, F.col("__comp"), comps, F.concat_ws("|", "game_id", "club_id"), "competition"),
        ("appearances", staging["appearances"], X.clean_text("competition_id"), comps, F.col("appearance_id"), "competition"),
        ("appearances", staging["appearances"], number("player_id"), players, F.col("appearance_id"), "player"),
        ("player_valuations", staging["player_valuations"], X.clean_text("player_club_domestic_competition_id"), comps,
         F.concat_ws("|", "player_id", day("date")), "competition"),
        ("transfers", staging["transfers"], number("player_id"), players, F.concat_ws("|", "player_id", day("transfer_date")), "player"),
    ]
    out = None
    for table, df, code, members, key, what in checks:
        rows = df.select(code.alias("__code"), key.alias("__key")).filter(F.col("__code").isNotNull())
        rows = rows.join(members, "__code", "left_anti")
        rows = rows.withColumn(R.REASON, F.concat(F.lit(f"{what} "), F.col("__code"), F.lit(" not in dimension, key -1")))
        part = R.to_reject_log(rows, batch_id, table, F.col("__key"))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ dimension sources (staging -> merge input)

# columns that a dimension row must cast in, by staging table: (id, {column: type})
DIM_CASTS = {
    "clubs": ("club_id", {"club_id": "int", "stadium_seats": "int"}),
    "national_teams": ("national_team_id", {"national_team_id": "int"}),
    "players": ("player_id", {"player_id": "int", "date_of_birth": "date", "height_in_cm": "smallint",
                              "contract_expiration_date": "date", "international_caps": "int"}),
    "games": ("game_id", {"game_id": "int", "attendance": "int"}),
}


def _fails_to_cast(table: str) -> Column:
    """True for a row with a value that does not cast; blanks are no values."""
    bad = F.lit(False)
    for c, kind in DIM_CASTS[table][1].items():
        typed = X.safe_date(c) if kind == "date" else X.clean_text(c).try_cast(kind)
        bad = bad | (X.clean_text(c).isNotNull() & typed.isNull())
    return bad


def castable(stg: DataFrame, table: str) -> DataFrame:
    """Staged dimension rows that have an id and cast; the others are in
    :func:`dimension_rejects` (a row without an id is left out silently)."""
    return stg.filter(X.clean_text(DIM_CASTS[table][0]).isNotNull() & ~_fails_to_cast(table))


def dimension_rejects(staging: dict[str, DataFrame], batch_id: str) -> DataFrame:
    """Reject-log rows of club, national team, player and match rows that do not cast."""
    out = None
    for table, (key, casts) in DIM_CASTS.items():
        bad = staging[table].filter(_fails_to_cast(table)).withColumn(R.REASON, F.lit(f"cast error ({', '.join(casts)})"))
        part = R.to_reject_log(bad, batch_id, table, F.coalesce(X.clean_text(key), F.lit("")))
        out = part if out is None else out.unionByName(part)
    return out

def _text(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    return [X.clean_text(c).alias(c) for c in cols]


def competition_incoming(stg_competitions: DataFrame, stg_countries: DataFrame) -> DataFrame:
    """Competitions for the SCD1 merge: cleaned, de-duplicated per id, labels defaulted,
    international competitions get the referenced country (or 'International'), the
    confederation normalised."""
    cols = ["competition_id", "name", "type", "sub_type", "country_id", "country_name", "confederation"]
    s = stg_competitions.select(*_text(stg_competitions, cols), "batch_id", "source_row")
    s = D.dedup_latest(s.filter(F.col("competition_id").isNotNull()), ["competition_id"], ["batch_id", "source_row"])
    ref = stg_countries.select(X.clean_text("country_id").alias("country_id"),
                               X.clean_text("country_name").alias("ref_country_name"), "batch_id", "source_row")
    ref = D.dedup_latest(ref.filter(F.col("country_id").isNotNull()), ["country_id"], ["batch_id", "source_row"])
    s = J.lookup_enrich(s, ref.select("country_id", "ref_country_name"), "country_id")
    return s.select(
        "competition_id", X.default_label("name").alias("competition_name"),
        X.default_label("type").alias("competition_type"), X.default_label("sub_type").alias("competition_sub_type"),
        X.country_fallback(F.col("country_id"), F.col("country_name"), F.col("ref_country_name")).alias("country_name"),
        X.normalize_confederation("confederation").alias("confederation"))


def club_incoming(stg_clubs: DataFrame, stg_national_teams: DataFrame, dim_competition: DataFrame) -> DataFrame:
    """Clubs ∪ national teams (tagged by type) for the SCD 1/2/3 club merge; the domestic
    league supplies the country, confederation and league name of a club."""
    clubs = castable(stg_clubs, "clubs").select(
        X.clean_text("club_id").alias("club_id"), X.clean_text("name").alias("raw_name"),
        X.clean_text("domestic_competition_id").alias("current_league_id"),
        X.clean_text("stadium_name").alias("stadium_name"),
        X.clean_text("stadium_seats").try_cast("int").alias("seats"),
        F.lit(None).cast("string").alias("country_name"), F.lit(None).cast("string").alias("confederation"),
        F.lit("Club").alias("club_type"), "batch_id", "source_row")
    teams = castable(stg_national_teams, "national_teams").select(
        X.clean_text("national_team_id").alias("club_id"), X.clean_text("name").alias("raw_name"),
        F.lit(None).cast("string").alias("current_league_id"), F.lit(None).cast("string").alias("stadium_name"),
        F.lit(None).cast("int").alias("seats"), X.clean_text("country_name").alias("country_name"),
        X.clean_text("confederation").alias("confederation"), F.lit("National Team").alias("club_type"),
        "batch_id", "source_row")
    both = D.union_all([clubs, teams])
    both = D.dedup_latest(both, ["club_id"], ["batch_id", "source_row"])
    league = dim_competition.select(F.col("competition_id").alias("current_league_id"),
                                    F.col("competition_name").alias("league_name"),
                                    F.col("country_name").alias("league_country"),
                                    F.col("confederation").alias("league_confederation"))
    j = both.join(league, "current_league_id", "left")
    is_club = F.col("club_type") == "Club"
    return j.select(
        F.col("club_id").cast("long").alias("club_id"),
        X.default_name(F.col("raw_name"), fixed.CLUB_PREFIX, F.col("club_id")).alias("club_name"),
        "club_type",
        F.when(is_club, X.default_label("league_country")).otherwise(X.default_label("country_name"))
        .alias("country_name"),
        F.when(is_club, X.default_label("league_confederation"))
        .otherwise(X.normalize_confederation("confederation")).alias("confederation"),
        "current_league_id",
        F.when(~is_club, F.lit(fixed.NOT_APPLICABLE)).otherwise(X.default_label("league_name"))
        .alias("current_league_name"),
        X.default_label("stadium_name").alias("stadium_name"),
        X.stadium_band(F.col("seats")).alias("stadium_capacity_band"))


def player_incoming(stg_players: DataFrame) -> DataFrame:
    """Players for the SCD 1/2 merge: defaults, height / caps bands, contract year."""
    texts = ["player_id", "name", "country_of_birth", "country_of_citizenship", "position", "sub_position", "foot",
             "agent_name", "height_in_cm", "international_caps", "date_of_birth", "contract_expiration_date"]
    s = castable(stg_players, "players").select(*_text(stg_players, texts), "batch_id", "source_row")
    s = D.dedup_latest(s, ["player_id"], ["batch_id", "source_row"])
    h = F.col("height_in_cm").try_cast("int")
    caps = F.col("international_caps").try_cast("int")
    contract = X.safe_date("contract_expiration_date")
    return s.select(
        F.col("player_id").cast("long").alias("player_id"),
        X.default_name(F.col("name"), fixed.PLAYER_PREFIX, F.col("player_id")).alias("full_name"),
        X.safe_date("date_of_birth").alias("date_of_birth"),
        X.default_label("country_of_birth").alias("country_of_birth"),
        X.default_label("country_of_citizenship").alias("citizenship"),
        X.default_label("position").alias("position"), X.default_label("sub_position").alias("sub_position"),
        X.default_label("foot").alias("foot"), X.height_band(h).alias("height_band"),
        X.default_label("agent_name").alias("agent_name"),
        F.year(contract).cast("int").alias("contract_expiry_year"), X.caps_band(caps).alias("international_caps_band"))


def match_incoming(stg_games: DataFrame) -> DataFrame:
    """Matches for the SCD1 merge: round type, defaults, attendance band."""
    texts = ["game_id", "round", "stadium", "referee", "home_club_formation", "away_club_formation", "attendance"]
    s = castable(stg_games, "games").select(*_text(stg_games, texts), "batch_id", "source_row")
    s = D.dedup_latest(s, ["game_id"], ["batch_id", "source_row"])
    return s.select(
        F.col("game_id").cast("long").alias("game_id"), X.default_label("round").alias("round"),
        X.round_type(F.col("round")).alias("round_type"), X.default_label("stadium").alias("stadium"),
        X.default_label("referee").alias("referee"),
        X.default_label("home_club_formation").alias("home_formation"),
        X.default_label("away_club_formation").alias("away_formation"),
        X.attendance_band(F.col("attendance").try_cast("int")).alias("attendance_band"))
