"""Star shapes derived from the driver tables.

The warehouse being re-built holds four facts over shared dimensions. The driver
ships TPC-H-style tables instead of football data, so this module derives the same
shapes from them with a fixed, documented rule. Every query in ``questions`` reads
these DataFrames, so its work grows with the driver tables.

Mapping (all integer arithmetic, so any engine reproduces it exactly)::

  n_supp                = number of suppliers
  competition_key       = s_nationkey*10 + (1 if l_linestatus = 'F' else 2)
  season_key            = year(l_shipdate)            (season 'yyyy/yy' starts that year)

  dim_club              supplier ⋈ nation ⋈ region; club = supplier, country = nation,
                        confederation = region; seats = floor(s_acctbal*10); -1 / -2 members
  dim_competition       nation × {league 'F', cup 'O'}; id 'COMP<key>'; -1 / -2 members
  dim_player            customer ⋈ nation; dob = 1972-03-01 + (c_custkey*97 % 10000) days;
                        position from c_mktsegment; -1 member
  dim_match             orders; referee = o_orderpriority; round from o_orderstatus;
                        attendance = floor(o_totalprice / 5)
  dim_manager           part brands; manager_key = brand number

  fact_team_match       lineitem ⋈ supplier [⋈ part for the manager]
      match_key = l_orderkey, club_key = l_suppkey,
      opponent_club_key = (l_suppkey + l_linenumber) % n_supp,
      is_home = l_returnflag = 'N', goals_for = int(l_quantity) % 5,
      goals_against = l_linenumber % 4, league_position = l_partkey % 20 + 1
  fact_player_appearance lineitem ⋈ orders ⋈ supplier
      player = o_custkey, appearance_id = '<orderkey>-<linenumber>' (not unique),
      minutes = int(l_quantity)*13 % 91, goals = l_linenumber % 3, assists = l_partkey % 3,
      yellow = round(l_discount*100) >= 7, red = round(l_discount*100) = 10 and round(l_tax*100) >= 6
  fact_player_valuation  events, one row per (user_id, day): the latest event (ts, event_id)
      market_value_eur = round(value*100000), club_key = user_id % n_supp,
      value_change_eur = lag over the player's dates, age from the player's dob (14..100)
  fact_transfer          lineitem ⋈ orders ⋈ part ⋈ customer
      from_club_key = l_suppkey, to_club_key = -2 (line 7), -1 (line 6 and flag 'N'),
      else (l_suppkey + 3*l_linenumber) % n_supp;
      fee = NULL if flag 'R', 0 if flag 'A' and status 'O', else round(l_extendedprice*1000);
      market_value_eur = round(p_retailprice*l_quantity*1000); ages from the player's dob

Storage: each fact is derived once per session and written as parquet under the shared
``spark.checkpoint.dir`` (team match, appearance and transfer partitioned by season), the
way the warehouse loads its facts once and answers many questions from them. Season
filters of the questions then prune directories instead of re-joining line items, and
a recomputed task after an executor loss reads the stored files.

Scale notes: dims with a fixed size (region 5, nation 25, competitions 50, seasons 41,
transfer types 7) are broadcast explicitly; supplier, customer, part and orders grow
with the data and are left to the planner (size statistics + AQE). The only window
over raw rows (valuation lag) runs after the (player, day) de-duplication, so a
partition holds at most one row per calendar day of one player.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickstar import fixed
from kickstar.frames import literal_frame, session_memo, source_fingerprint, stored
from kickstar.functions import exprs as X
from kickstar.sources.driver import table

# --- fixed values: synthetic position per market segment (this mapping is ours) ---
POSITIONS = (
    ("AUTOMOBILE", "Attack"),
    ("BUILDING", "Defender"),
    ("FURNITURE", "Midfield"),
    ("HOUSEHOLD", "Goalkeeper"),
    ("MACHINERY", "Missing"),
)
DOB_BASE = "1972-03-01"


def _n_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one row; joined with a broadcast nested-loop join of a single row
    return table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("_n_supp"))


def season_span(labels) -> tuple[str, str] | None:
    """Ship-date range [first season start, last season end) covering season labels
    'yyyy/yy'; a superset filter on the raw date column that parquet can push down
    (row-group statistics, partition pruning). The exact label filter still follows. No range
    when any label names no years (such as the unknown season)."""
    years = [int(lab[:4]) for lab in labels if re.fullmatch(r"\d{4}/\d{2}", lab)]
    return (f"{min(years)}-01-01", f"{max(years) + 1}-01-01") if years and len(years) == len(labels) else None


def _lineitem(spark: SparkSession, sf_dir: str, cols: list[str], ship_range: tuple[str, str] | None) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*cols)
    if ship_range:
        lo, hi = ship_range
        li = li.filter((F.col("l_shipdate") >= F.lit(lo).cast("timestamp_ntz"))
                       & (F.col("l_shipdate") < F.lit(hi).cast("timestamp_ntz")))
    return li


def competition_key(nationkey: Column, linestatus: Column) -> Column:
    return (nationkey * 10 + F.when(linestatus == "F", 1).otherwise(2)).cast("int")


def _season(ts: Column) -> Column:
    return F.year(ts).cast("int")


# ------------------------------------------------------------------ dimensions

@session_memo
def dim_season(spark: SparkSession) -> DataFrame:
    years = spark.range(fixed.SEASON_FIRST, fixed.SEASON_LAST + 1).select(F.col("id").cast("int").alias("y"))
    real = years.select(
        F.col("y").alias("season_key"), F.col("y").alias("season_start_year"),
        X.season_label("y").alias("season_label"), X.season_short("y").alias("season_short"))
    unknown = literal_frame(spark, [(-1, -1, "Unknown", "Unknown")], real.schema)
    return real.unionByName(unknown)


@session_memo
def dim_competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    kinds = literal_frame(spark, [("F", "League", "domestic_league"), ("O", "Cup", "domestic_cup")],
                          "status string, kind string, ctype string")
    base = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).crossJoin(F.broadcast(kinds))
    key = competition_key(F.col("n_nationkey"), F.col("status"))
    real = base.select(
        key.alias("competition_key"),
        F.concat(F.lit("COMP"), key.cast("string")).alias("competition_id"),
        F.concat_ws(" ", "n_name", "kind").alias("competition_name"),
        F.col("ctype").alias("competition_type"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("confederation"),
    )
    special = literal_frame(
        spark, [(-1, "-1", fixed.UNKNOWN_COMPETITION, fixed.UNKNOWN, fixed.UNKNOWN, fixed.UNKNOWN),
         (-2, "-2", fixed.NO_COMPETITION, fixed.NOT_APPLICABLE, fixed.NOT_APPLICABLE, fixed.NOT_APPLICABLE)],
        real.schema)
    return real.unionByName(special)


@session_memo
def dim_club(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    seats = F.floor(F.col("s_acctbal") * 10).cast("int")
    real = sup.join(F.broadcast(geo), sup.s_nationkey == geo.n_nationkey).select(
        F.col("s_suppkey").alias("club_key"),
        F.col("s_suppkey").alias("club_id"),
        F.col("s_name").alias("club_name"),
        F.lit("Club").alias("club_type"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("confederation"),
        X.stadium_band(seats).alias("stadium_capacity_band"),
        F.to_date(F.lit(fixed.SCD_FIRST_START)).alias("effective_date"),
        F.to_date(F.lit(fixed.SCD_OPEN_END)).alias("expiry_date"),
        F.lit(True).alias("is_current"),
    )
    special = literal_frame(
        spark, [(-1, -1, fixed.UNKNOWN_CLUB, fixed.UNKNOWN_SHORT, fixed.UNKNOWN, fixed.UNKNOWN, fixed.UNKNOWN),
         (-2, -2, fixed.NO_CLUB, fixed.NOT_APPLICABLE, fixed.NOT_APPLICABLE, fixed.NOT_APPLICABLE,
          fixed.NOT_APPLICABLE)],
        "club_key long, club_id long, club_name string, club_type string, country_name string, "
        "confederation string, stadium_capacity_band string",
    ).select("*", F.to_date(F.lit(fixed.SCD_FIRST_START)).alias("effective_date"),
             F.to_date(F.lit(fixed.SCD_OPEN_END)).alias("expiry_date"), F.lit(True).alias("is_current"))
    return real.unionByName(special)


def position_of(segment: Column) -> Column:
    out = None
    for seg, pos in POSITIONS:
        out = F.when(segment == seg, F.lit(pos)) if out is None else out.when(segment == seg, F.lit(pos))
    return out.otherwise(F.lit(fixed.UNKNOWN))


def player_dob(custkey: Column) -> Column:
    return F.date_add(F.to_date(F.lit(DOB_BASE)), ((custkey * 97) % 10000).cast("int"))


@session_memo
def dim_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pos = position_of(F.col("c_mktsegment"))
    real = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("player_key"),
        F.col("c_custkey").alias("player_id"),
        F.col("c_name").alias("full_name"),
        player_dob(F.col("c_custkey")).alias("date_of_birth"),
        F.col("n_name").alias("citizenship"),
        pos.alias("position"),
        F.concat(pos, F.when(F.col("c_acctbal") >= 0, F.lit(" - first team")).otherwise(F.lit(" - rotation")))
        .alias("sub_position"),
    )
    special = literal_frame(
        spark, [(-1, -1, fixed.UNKNOWN_PLAYER, None, fixed.UNKNOWN, fixed.UNKNOWN, fixed.UNKNOWN)], real.schema)
    return real.unionByName(special)


def match_round(status: Column, orderkey: Column) -> Column:
    return (F.when(status == "F", F.concat((orderkey % 38 + 1).cast("string"), F.lit(". Matchday")))
            .when(status == "O", F.lit("Group A"))
            .when((orderkey % 7) == 0, F.lit("Final"))
            .otherwise(F.lit("Quarter-Finals")))


@session_memo
def dim_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                              "o_orderpriority")
    rnd = match_round(F.col("o_orderstatus"), F.col("o_orderkey"))
    return o.select(
        F.col("o_orderkey").alias("match_key"),
        F.col("o_orderkey").alias("game_id"),
        rnd.alias("round"),
        X.round_type(rnd).alias("round_type"),
        F.col("o_orderpriority").alias("referee"),
        X.attendance_band(F.floor(F.col("o_totalprice") / 5).cast("int")).alias("attendance_band"),
        F.to_date("o_orderdate").alias("match_date"),
    )


@session_memo
def dim_manager(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    return brands.select(F.substring("p_brand", 7, 10).cast("int").alias("manager_key"),
                         F.col("p_brand").alias("manager_name"))


@session_memo
def dim_transfer_type(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, list(fixed.TRANSFER_TYPES), "transfer_type_key int, fee_status string, fee_band string")


# ------------------------------------------------------------------ facts

def in_seasons(df: DataFrame, ship_range: tuple[str, str] | None) -> DataFrame:
    """Keep the seasons of a ``season_span`` range; on a stored fact this filter on the
    partition column prunes whole season directories."""
    if not ship_range:
        return df
    lo, hi = int(ship_range[0][:4]), int(ship_range[1][:4])
    return df.filter((F.col("season_key") >= lo) & (F.col("season_key") < hi))


TEAM_MATCH_COLUMNS = ["match_key", "club_key", "competition_key", "season_key", "date_key", "is_home", "goals_for",
                      "goals_against", "is_win", "is_draw", "is_loss", "is_clean_sheet", "points", "goal_difference",
                      "league_position"]


# A fact is derived in two steps: the narrow rows that the joins and the write move, and the
# columns that follow from them, which are added where the rows are written.

def _team_match_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ supplier, with the manager (part brand; left join, so a missing part leaves
    NULL) attached once."""
    li = _lineitem(spark, sf_dir, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                   "l_returnflag", "l_linestatus", "l_shipdate"], None)
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = li.join(sup, li.l_suppkey == sup.s_suppkey).select(
        F.col("l_orderkey").alias("match_key"),
        F.col("l_suppkey").alias("club_key"),
        competition_key(F.col("s_nationkey"), F.col("l_linestatus")).alias("competition_key"),
        _season(F.col("l_shipdate")).alias("season_key"),
        X.date_key(F.col("l_shipdate")).alias("date_key"),
        F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("is_home"),
        (F.col("l_quantity").cast("int") % 5).cast("int").alias("goals_for"),
        "l_linenumber", "l_partkey")
    return lines.join(part, F.col("l_partkey") == part.p_partkey, "left").select(
        *lines.columns, F.substring("p_brand", 7, 10).cast("int").alias("manager_key"),
        F.col("p_partkey").isNotNull().alias("__has_part"))


def _team_match_columns(spark: SparkSession, sf_dir: str, base: DataFrame) -> DataFrame:
    """The columns that follow from the narrow rows and the supplier count (opponent)."""
    gf, ga = F.col("goals_for"), (F.col("l_linenumber") % 4).cast("int")
    cols = ["match_key", "club_key", "competition_key", "season_key", "date_key", "is_home", gf.alias("goals_for"),
            ga.alias("goals_against")]
    cols += [c.alias(n) for n, c in X.match_outcome(gf, ga).items()]
    cols.append(((F.col("l_partkey") % 20) + 1).cast("int").alias("league_position"))
    cols.append(((F.col("club_key") + F.col("l_linenumber")) % F.col("_n_supp")).alias("opponent_club_key"))
    return base.crossJoin(F.broadcast(_n_supp(spark, sf_dir))).select(*cols, "manager_key", "__has_part")


def _team_match_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team × match rows with the opponent and the manager."""
    return _team_match_columns(spark, sf_dir, _team_match_base(spark, sf_dir))


# driver tables the stored facts are derived from (their fingerprint names the stored copy)
FACT_SOURCES = ("lineitem", "orders", "supplier", "part", "customer", "events")


def _code_version() -> str:
    """Hash of the code that derives the facts: a changed rule never reuses an old copy."""
    import hashlib
    import inspect
    import sys
    from kickstar import fixed as _fixed, frames as _frames
    from kickstar.functions import exprs as _exprs
    from kickstar.sources import driver as _driver
    text = "".join(inspect.getsource(m) for m in (sys.modules[__name__], _exprs, _fixed, _frames, _driver))
    return hashlib.sha1(text.encode()).hexdigest()[:12]


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    from kickstar.sources.driver import path
    return source_fingerprint(spark, [path(sf_dir, t) for t in FACT_SOURCES]) + "-" + _code_version()


def _store(spark: SparkSession, sf_dir: str, df: DataFrame, label: str, partition_by, reuse: bool,
           sort_by=None, after=None) -> DataFrame:
    """``after(spark, sf_dir, df)`` gives the fact's columns from its narrow rows."""
    more = (lambda rows: after(spark, sf_dir, rows)) if after else (lambda rows: rows)
    return stored(df, label, _fingerprint(spark, sf_dir), partition_by, reuse=reuse, sort_by=sort_by, after=more)


# inside a season folder, rows are ordered by competition: a competition filter reads
# only the row groups whose min/max range holds it
BY_COMPETITION = ["season_key", "competition_key"]


@session_memo
def stored_team_match(spark: SparkSession, sf_dir: str, reuse: bool = True) -> DataFrame:
    """The team-match fact, derived from the driver tables and stored (shared checkpoint
    folder) partitioned by season: the queries read this table like the warehouse's fact."""
    return _store(spark, sf_dir, _team_match_base(spark, sf_dir), "fact_team_match", ["season_key"], reuse,
                  BY_COMPETITION, _team_match_columns)


def team_match(spark: SparkSession, sf_dir: str, with_manager: bool = False, with_opponent: bool = False,
               ship_range: tuple[str, str] | None = None) -> DataFrame:
    """Team × match rows; the manager and opponent columns are returned only when asked
    (asking for the manager keeps only rows whose part exists, as an inner join would)."""
    df = in_seasons(stored_team_match(spark, sf_dir), ship_range)
    if with_manager:
        df = df.filter(F.col("__has_part"))
    cols = list(TEAM_MATCH_COLUMNS)
    if with_opponent:
        cols.append("opponent_club_key")
    if with_manager:
        cols.append("manager_key")
    return df.select(*cols)


def _appearance_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lineitem(spark, sf_dir, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                   "l_discount", "l_tax", "l_linestatus", "l_shipdate"], None)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    disc, tax = F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100)
    lines = li.join(sup, F.col("l_suppkey") == sup.s_suppkey).select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.col("l_suppkey").alias("club_key"),
        competition_key(F.col("s_nationkey"), F.col("l_linestatus")).alias("competition_key"),
        _season(F.col("l_shipdate")).alias("season_key"),
        X.date_key(F.col("l_shipdate")).alias("date_key"),
        (F.col("l_partkey") % 3).cast("int").alias("assists"),
        F.when(disc >= 7, 1).otherwise(0).alias("yellow_cards"),
        F.when((disc == 10) & (tax >= 6), 1).otherwise(0).alias("red_cards"))
    return lines.join(o, lines.l_orderkey == o.o_orderkey).select(*lines.columns, F.col("o_custkey").alias("player_key"))


def _appearance_columns(spark: SparkSession, sf_dir: str, base: DataFrame) -> DataFrame:
    return base.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("appearance_id"),
        F.col("l_orderkey").alias("match_key"), "player_key", "club_key", "competition_key", "season_key", "date_key",
        ((F.col("l_quantity").cast("int") * 13) % 91).cast("int").alias("minutes_played"),
        (F.col("l_linenumber") % 3).cast("int").alias("goals"), "assists", "yellow_cards", "red_cards",
        F.lit(1).alias("appearance_count"))


def _appearance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appearance_columns(spark, sf_dir, _appearance_base(spark, sf_dir))


@session_memo
def stored_player_appearance(spark: SparkSession, sf_dir: str, reuse: bool = True) -> DataFrame:
    return _store(spark, sf_dir, _appearance_base(spark, sf_dir), "fact_player_appearance", ["season_key"], reuse,
                  BY_COMPETITION, _appearance_columns)


def player_appearance(spark: SparkSession, sf_dir: str, ship_range: tuple[str, str] | None = None) -> DataFrame:
    return in_seasons(stored_player_appearance(spark, sf_dir), ship_range)


@session_memo
def valuation_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (player, day): the latest event of the day (ts, then event_id).

    ``max_by`` over a struct is a partial aggregate: map-side combine before the
    shuffle, so a hot player does not pile raw rows into one task.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    latest = F.max_by(F.col("value"), F.struct("ts", "event_id"))
    return (ev.groupBy(F.col("user_id").alias("player_key"), F.to_date("ts").alias("valuation_date"))
            .agg(latest.alias("value")))


def _valuation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = valuation_days(spark, sf_dir)
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    mv = F.round(F.col("value") * 100000).cast("long")
    w = Window.partitionBy("player_key").orderBy("valuation_date")
    df = (days.crossJoin(F.broadcast(_n_supp(spark, sf_dir)))
          .join(cust, days.player_key == cust.c_custkey, "left"))
    dob = F.when(F.col("c_custkey").isNotNull(), player_dob(F.col("c_custkey")))
    return df.select(
        "player_key",
        "valuation_date",
        X.date_key(F.col("valuation_date")).alias("date_key"),
        (F.col("player_key") % F.col("_n_supp")).alias("club_key"),
        mv.alias("market_value_eur"),
        (mv - F.lag(mv).over(w)).alias("value_change_eur"),
        X.age_in_range(dob, F.col("valuation_date"), 14, 100).alias("age_at_valuation"),
        F.lit(1).alias("valuation_count"),
    )


@session_memo
def player_valuation(spark: SparkSession, sf_dir: str, reuse: bool = True) -> DataFrame:
    """The valuation fact (no season key: semi-additive over dates), stored like the others."""
    return _store(spark, sf_dir, _valuation_rows(spark, sf_dir), "fact_player_valuation", None, reuse)


def _transfer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines meet their part, then their order, which knows already whether its customer exists."""
    li = _lineitem(spark, sf_dir, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                   "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"], None)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    tdate = F.to_date("l_shipdate")
    lines = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", tdate.alias("transfer_date"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double"))
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), F.lit(0.0))
        .otherwise(F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linenumber") == 7, F.lit(-2).cast("long"))
        .when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "N"), F.lit(-1).cast("long")).alias("to_code"))
    priced = lines.join(part, lines.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_suppkey", "l_linenumber", "transfer_date", "price", "to_code",
        F.round(F.col("p_retailprice") * F.col("l_quantity") * 1000).alias("mv"))
    known = o.join(cust, F.col("o_custkey") == cust.c_custkey, "left") \
        .select("o_orderkey", F.col("o_custkey").alias("player_key"), F.col("c_custkey").isNotNull().alias("has_player"))
    return priced.join(known, priced.l_orderkey == known.o_orderkey).select(
        "player_key", "has_player", "transfer_date", F.year("transfer_date").cast("int").alias("season_key"),
        "l_suppkey", "l_linenumber", "to_code", "price", "mv")


def _transfer_columns(spark: SparkSession, sf_dir: str, base: DataFrame) -> DataFrame:
    fee = F.round(F.col("price") * 1000).cast("long")
    mv, tdate = F.col("mv").cast("long"), F.col("transfer_date")
    to_club = F.coalesce(F.col("to_code"), (F.col("l_suppkey") + 3 * F.col("l_linenumber")) % F.col("_n_supp"))
    dob = F.when(F.col("has_player"), player_dob(F.col("player_key")))
    return base.crossJoin(F.broadcast(_n_supp(spark, sf_dir))).select(
        "player_key", "transfer_date",
        X.date_key(tdate).alias("date_key"), "season_key",
        F.col("l_suppkey").alias("from_club_key"),
        to_club.alias("to_club_key"),
        X.transfer_type_key(fee).cast("int").alias("transfer_type_key"),
        fee.alias("transfer_fee_eur"),
        mv.alias("market_value_eur"),
        X.fee_premium(fee, mv).alias("fee_premium_eur"),
        X.age_in_range(dob, tdate, 0, 100).alias("age_at_transfer"),
        X.youth_flag(dob, tdate).alias("is_youth_transfer"),
        F.lit(1).alias("transfer_count"),
    )


def _transfer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transfer_columns(spark, sf_dir, _transfer_base(spark, sf_dir))


@session_memo
def stored_transfer(spark: SparkSession, sf_dir: str, reuse: bool = True) -> DataFrame:
    return _store(spark, sf_dir, _transfer_base(spark, sf_dir), "fact_transfer", ["season_key"], reuse,
                  after=_transfer_columns)


def transfer(spark: SparkSession, sf_dir: str, ship_range: tuple[str, str] | None = None) -> DataFrame:
    return in_seasons(stored_transfer(spark, sf_dir), ship_range)


def store_facts(spark: SparkSession, sf_dir: str, reuse: bool = True) -> None:
    """Derive and store the four facts (the warehouse load step); later calls in the
    session reuse them. ``reuse=False`` derives them again even if a stored copy for the
    same sources exists (the bench uses it, so the load step is always measured).

    The four loads are independent Spark jobs submitted together (as the reference runs
    its staging flows in parallel), so the scheduler overlaps their stages."""
    from concurrent.futures import ThreadPoolExecutor
    loads = {stored_team_match: "team_match", stored_player_appearance: "appearance",
             player_valuation: "valuation", stored_transfer: "transfer"}
    with ThreadPoolExecutor(max_workers=len(loads)) as pool:
        done = [pool.submit(load, spark, sf_dir, reuse) for load in loads]
        for f in done:
            f.result()
    if not reuse:
        for load in loads:      # later default calls of this session read the fresh copies
            load.remember(spark, sf_dir, value=load(spark, sf_dir, False))


SCHEMAS = {
    "dim_transfer_type": T.StructType([
        T.StructField("transfer_type_key", T.IntegerType()),
        T.StructField("fee_status", T.StringType()),
        T.StructField("fee_band", T.StringType()),
    ]),
}
