"""Staging-shaped inputs derived from the driver tables, and the load queries over them.

The warehouse loads all-text staging tables. Here they are produced from the driver
tables with value-based rules, so the whole load path (clean → de-duplicate → LAG →
anti-join → cast / validate / window → lookups) runs on data that grows with the
driver tables:

* ``stg_player_valuations`` — one text row per event: player_id = user_id,
  date = ts as text, market value = round(value*100000) as text, except
  'n/a' for error events with value < 5 (cast reject) and a negative number for
  signup events with value < 3 (rule reject); club id = user_id % n_supp; domestic
  competition blank for view events (→ -2) else 'COMP<(user_id % 25)*10+1>';
  batch_id = 'BATCH_' + ts as yyyyMMdd_HHmmss; source_row = event_id.
* ``stg_transfers`` — one text row per line item: player = o_custkey, date = ship date
  as text, season 'yy/yy' of the ship year, from club = l_suppkey, to club '515' (a
  not-applicable code) on line 7, '75' (the unknown code) on line 6 with flag 'N', else
  (l_suppkey + 3*l_linenumber) % n_supp; fee empty for flag 'R', '0' for flag 'A' with
  status 'O', '-1' (rule reject) for flag 'A' with no discount, else
  round(l_extendedprice*1000) + '.000'; market value round(p_retailprice*l_quantity*1000);
  batch 'BATCH_' + order date; source_row = l_orderkey*8 + l_linenumber.
* ``stg_club_games`` / ``stg_games`` — one text row per line item (game = order, club =
  supplier): own goals int(l_quantity) % 5 ('x' — a cast reject — for flag 'R' on
  line 5), position l_partkey % 20 + 1 ('-1' sentinel for status 'O'), own manager =
  part brand, opponent (l_suppkey + l_linenumber) % n_supp with l_linenumber % 4
  goals and the brand as manager for status 'F' (blank otherwise), 'Home' for flag
  'N'; games from orders with competition 'COMP<(o_custkey % 25)*10+1>', season =
  order year, date = order date.
* ``stg_appearances`` — one text row per line item: id '<orderkey>-<linenumber>' (repeats
  in the data: the latest row wins), game = order, player = o_custkey, club = supplier,
  competition 'COMP<(o_custkey % 25)*10+1>', date = ship date, cards from the discount,
  goals l_linenumber % 3, assists l_partkey % 3, minutes int(l_quantity)*13 % 91, except
  '131' minutes (flag 'R', line 1) and '-1' goals (flag 'A', line 2) as rule rejects.
* club dimension v1 (suppliers with s_acctbal >= 0) and incoming v2 (all suppliers):
  name + ' FC' when 0 <= s_acctbal < 2000 (SCD1), stadium 'Arena <id>' when
  s_acctbal >= 8000 (SCD2), league moved to the next nation when
  1000 <= s_acctbal < 3000 or s_acctbal >= 9000 (SCD3); negative balances are new clubs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickstar import fixed
from kickstar.frames import literal_frame, materialize, shuffles_removed
from kickstar.functions import exprs as X
from kickstar.plans import star, warehouse as WH
from kickstar.sources import sinks
from kickstar.sources.driver import table

VAL_WINDOW_1 = WH.LoadWindow("2024-01-01", "2024-01-15", "BATCH_RUN_1")
VAL_WINDOW_2 = WH.LoadWindow("2024-01-01", "2024-01-31", "BATCH_RUN_2")
SCD_RUN_DATE = "1998-07-01"


def stg_player_valuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ns = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("_n"))
    mv = F.round(F.col("value") * 100000).cast("long")
    mv_text = (F.when((F.col("event_type") == "error") & (F.col("value") < 5), F.lit("n/a"))
               .when((F.col("event_type") == "signup") & (F.col("value") < 3), (-mv).cast("string"))
               .otherwise(mv.cast("string")))
    comp = F.when(F.col("event_type") == "view", F.lit("")) \
        .otherwise(F.concat(F.lit("COMP"), ((F.col("user_id") % 25) * 10 + 1).cast("string")))
    return ev.crossJoin(F.broadcast(ns)).select(
        F.col("user_id").cast("string").alias("player_id"),
        F.col("ts").cast("string").alias("date"),
        mv_text.alias("market_value_in_eur"),
        F.lit(None).cast("string").alias("current_club_name"),
        (F.col("user_id") % F.col("_n")).cast("string").alias("current_club_id"),
        comp.alias("player_club_domestic_competition_id"),
        F.date_format("ts", "'BATCH_'yyyyMMdd_HHmmss").alias("batch_id"),
        F.col("event_id").alias("source_row"))


TRANSFER_WINDOW = WH.LoadWindow("1995-01-01", "1999-12-31", "BATCH_TR_1")


def stg_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines move twice, to their part and to their order: what follows from a line alone (the
    special codes of fee and club, the price that counts) is worked out before, texts after."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    ns = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("_n"))
    c = F.col
    flag = c("l_returnflag")
    free, refused = (flag == "A") & (c("l_linestatus") == "O"), (flag == "A") & (F.round(c("l_discount") * 100) == 0)
    lines = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate",
        F.when(c("l_linenumber") == 7, F.lit("515")).when((c("l_linenumber") == 6) & (flag == "N"), F.lit("75")).alias("to_code"),
        F.when((flag == "R"), F.lit(None).cast("string")).when(free, F.lit("0")).when(refused, F.lit("-1")).alias("fee_code"),
        F.when((flag == "R") | free | refused, F.lit(None).cast("double")).otherwise(c("l_extendedprice")).alias("price"))
    priced = lines.join(part, lines.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", "to_code", "fee_code", "price",
        F.round(c("p_retailprice") * c("l_quantity") * 1000).alias("mv"))
    df = priced.join(o, priced.l_orderkey == o.o_orderkey).crossJoin(F.broadcast(ns))
    to_club = F.coalesce(c("to_code"), ((c("l_suppkey") + 3 * c("l_linenumber")) % c("_n")).cast("string"))
    fee = F.coalesce(c("fee_code"), F.concat(F.round(c("price") * 1000).cast("long").cast("string"), F.lit(".000")))
    return df.select(
        c("o_custkey").cast("string").alias("player_id"), c("l_shipdate").cast("string").alias("transfer_date"),
        X.season_short(F.year("l_shipdate")).alias("transfer_season"), c("l_suppkey").cast("string").alias("from_club_id"),
        to_club.alias("to_club_id"), F.lit(None).cast("string").alias("from_club_name"),
        F.lit(None).cast("string").alias("to_club_name"), fee.alias("transfer_fee"),
        c("mv").cast("long").cast("string").alias("market_value_in_eur"),
        F.lit(None).cast("string").alias("player_name"),
        F.date_format("o_orderdate", "'BATCH_'yyyyMMdd").alias("batch_id"),
        (c("l_orderkey") * 8 + c("l_linenumber")).alias("source_row"))


TEAM_WINDOW = WH.LoadWindow("1995-01-01", "1998-12-31", "BATCH_TM_1")


def stg_club_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                 "l_returnflag", "l_linestatus")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    ns = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("_n"))
    df = li.join(part, li.l_partkey == part.p_partkey).crossJoin(F.broadcast(ns))
    c = F.col
    return df.select(
        c("l_orderkey").cast("string").alias("game_id"), c("l_suppkey").cast("string").alias("club_id"),
        F.when((c("l_returnflag") == "R") & (c("l_linenumber") == 5), F.lit("x"))
        .otherwise((c("l_quantity").cast("int") % 5).cast("string")).alias("own_goals"),
        F.when(c("l_linestatus") == "O", F.lit("-1")).otherwise((c("l_partkey") % 20 + 1).cast("string"))
        .alias("own_position"),
        c("p_brand").alias("own_manager_name"),
        ((c("l_suppkey") + c("l_linenumber")) % c("_n")).cast("string").alias("opponent_id"),
        (c("l_linenumber") % 4).cast("string").alias("opponent_goals"),
        F.lit(None).cast("string").alias("opponent_position"),
        F.when(c("l_linestatus") == "F", c("p_brand")).otherwise(F.lit(" ")).alias("opponent_manager_name"),
        F.when(c("l_returnflag") == "N", F.lit("Home")).otherwise(F.lit("Away")).alias("hosting"),
        F.lit(None).cast("string").alias("is_win"),
        F.lit("BATCH_1").alias("batch_id"), (c("l_orderkey") * 8 + c("l_linenumber")).alias("source_row"))


def stg_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                              "o_orderpriority", "o_totalprice")
    return o.select(F.col("o_orderkey").cast("string").alias("game_id"),
                    F.concat(F.lit("COMP"), ((F.col("o_custkey") % 25) * 10 + 1).cast("string")).alias("competition_id"),
                    F.year("o_orderdate").cast("string").alias("season"),
                    F.col("o_orderdate").cast("string").alias("date"),
                    star.match_round(F.col("o_orderstatus"), F.col("o_orderkey")).alias("round"),
                    F.lit(None).cast("string").alias("stadium"), F.col("o_orderpriority").alias("referee"),
                    F.lit("4-3-3").alias("home_club_formation"), F.lit(None).cast("string").alias("away_club_formation"),
                    F.floor(F.col("o_totalprice") / 5).cast("long").cast("string").alias("attendance"),
                    F.lit("BATCH_1").alias("batch_id"), F.col("o_orderkey").alias("source_row"))


def team_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    manager = star.dim_manager(spark, sf_dir).unionByName(
        literal_frame(spark, [(-1, fixed.UNKNOWN)], "manager_key int, manager_name string"))
    return {"match": star.dim_match(spark, sf_dir), "club": written_clubs(spark, sf_dir),
            "competition": star.dim_competition(spark, sf_dir), "season": star.dim_season(spark), "manager": manager}


def load_fact_team_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged club games of the window 1995-1998 → team × match facts (seven key lookups)."""
    empty = spark.createDataFrame([], "match_key long, club_key long")
    fact, _ = WH.load_fact_team_match(stg_club_games(spark, sf_dir), stg_games(spark, sf_dir), team_dims(spark, sf_dir), empty,
                                      TEAM_WINDOW)
    return fact


APPEARANCE_WINDOW = WH.LoadWindow("1995-01-01", "1999-12-31", "BATCH_AP_1")


def stg_appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                 "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    df = li.join(o, li.l_orderkey == o.o_orderkey)
    c = F.col
    disc, tax = F.round(c("l_discount") * 100).cast("int"), F.round(c("l_tax") * 100).cast("int")
    minutes = F.when((c("l_returnflag") == "R") & (c("l_linenumber") == 1), F.lit("131")) \
        .otherwise(((c("l_quantity").cast("int") * 13) % 91).cast("string"))
    goals = F.when((c("l_returnflag") == "A") & (c("l_linenumber") == 2), F.lit("-1")) \
        .otherwise((c("l_linenumber") % 3).cast("string"))
    return df.select(
        F.concat_ws("-", c("l_orderkey").cast("string"), c("l_linenumber").cast("string")).alias("appearance_id"),
        c("l_orderkey").cast("string").alias("game_id"), c("o_custkey").cast("string").alias("player_id"),
        c("l_suppkey").cast("string").alias("player_club_id"), F.lit(None).cast("string").alias("player_current_club_id"),
        c("l_shipdate").cast("string").alias("date"), F.lit(None).cast("string").alias("player_name"),
        F.concat(F.lit("COMP"), ((c("o_custkey") % 25) * 10 + 1).cast("string")).alias("competition_id"),
        F.when(disc >= 7, F.lit("1")).otherwise(F.lit("0")).alias("yellow_cards"),
        F.when((disc == 10) & (tax >= 6), F.lit("1")).otherwise(F.lit("0")).alias("red_cards"),
        goals.alias("goals"), (c("l_partkey") % 3).cast("string").alias("assists"), minutes.alias("minutes_played"),
        F.lit("BATCH_1").alias("batch_id"), (c("l_orderkey") * 8 + c("l_linenumber")).alias("source_row"))


def load_fact_player_appearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged appearances of the window 1995-1999 → player × match facts with range checks."""
    player, club, comp = load_dims(spark, sf_dir)
    dims = {"match": star.dim_match(spark, sf_dir), "player": player, "club": club, "competition": comp,
            "season": star.dim_season(spark)}
    empty = spark.createDataFrame([], "appearance_id string")
    fact, _ = WH.load_fact_player_appearance(stg_appearances(spark, sf_dir), stg_games(spark, sf_dir), dims, empty,
                                             APPEARANCE_WINDOW)
    return fact


FACT_TRANSFER_KEYS = "player_key long, date_key int, from_club_key long, to_club_key long"


def load_fact_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged transfers of the window 1995-1999 → transfer facts (remapped codes, NULL vs 0 fee)."""
    player, club, _ = load_dims(spark, sf_dir)
    dims = {"player": player, "club": club, "season": star.dim_season(spark)}
    empty = spark.createDataFrame([], FACT_TRANSFER_KEYS)
    fact, _ = WH.load_fact_transfer(stg_transfers(spark, sf_dir), dims, empty, TRANSFER_WINDOW)
    return fact


def written_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The club dimension as a load finds it, written: the planner knows the size of its lookups and
    broadcasts them as long as they are small (of a derived one it assumes the worst, and moves
    the facts to every lookup)."""
    return materialize(star.dim_club(spark, sf_dir), "dim-club")


def load_dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    player = star.dim_player(spark, sf_dir).withColumn("is_current", F.lit(True))
    club = written_clubs(spark, sf_dir)
    comp = star.dim_competition(spark, sf_dir)
    return player, club, comp


FACT_VAL_SCHEMA = T.StructType([
    T.StructField("player_key", T.LongType()), T.StructField("date_key", T.IntegerType()),
    T.StructField("club_key", T.LongType()), T.StructField("competition_key", T.IntegerType()),
    T.StructField("market_value_eur", T.LongType()), T.StructField("value_change_eur", T.LongType()),
    T.StructField("age_at_valuation", T.IntegerType()), T.StructField("valuation_count", T.IntegerType()),
    T.StructField("batch_id", T.StringType()),
])


def _two_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    stg = stg_player_valuations(spark, sf_dir)
    player, club, comp = load_dims(spark, sf_dir)
    empty = spark.createDataFrame([], FACT_VAL_SCHEMA)
    run1, _ = WH.load_fact_player_valuation(stg, player, club, empty, VAL_WINDOW_1, comp)
    run2, rej2 = WH.load_fact_player_valuation(stg, player, club, run1, VAL_WINDOW_2, comp)
    return run1, run2, rej2


def load_fact_player_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows added by the second window after a first, narrower window was loaded."""
    _, run2, _ = _two_runs(spark, sf_dir)
    return run2


def dq_reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reject log of the second run, by source table and reason."""
    from kickstar.plans import quality
    _, _, rej = _two_runs(spark, sf_dir)
    return quality.reject_summary(rej)


# ------------------------------------------------------------------ SCD merge over suppliers

CLUB_DIM_SCHEMA = T.StructType([
    T.StructField("club_key", T.LongType()), T.StructField("club_id", T.LongType()),
    T.StructField("club_name", T.StringType()), T.StructField("club_type", T.StringType()),
    T.StructField("country_name", T.StringType()), T.StructField("confederation", T.StringType()),
    T.StructField("current_league_id", T.StringType()), T.StructField("current_league_name", T.StringType()),
    T.StructField("previous_league_name", T.StringType()), T.StructField("stadium_name", T.StringType()),
    T.StructField("stadium_capacity_band", T.StringType()), T.StructField("effective_date", T.DateType()),
    T.StructField("expiry_date", T.DateType()), T.StructField("is_current", T.BooleanType()),
])


def _club_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = F.broadcast(nation.join(region, nation.n_regionkey == region.r_regionkey))
    return sup.join(geo, sup.s_nationkey == geo.n_nationkey)


def _league(nationkey) -> tuple:
    return (F.concat(F.lit("COMP"), (nationkey * 10 + 1).cast("string")),)


def club_dim_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _club_source(spark, sf_dir).filter(F.col("s_acctbal") >= 0)
    seats = F.floor(F.col("s_acctbal") * 10).cast("int")
    real = src.select(
        (F.col("s_suppkey") + 1).alias("club_key"), F.col("s_suppkey").alias("club_id"),
        F.col("s_name").alias("club_name"), F.lit("Club").alias("club_type"), F.col("n_name").alias("country_name"),
        F.col("r_name").alias("confederation"),
        F.concat(F.lit("COMP"), (F.col("s_nationkey") * 10 + 1).cast("string")).alias("current_league_id"),
        F.concat(F.col("n_name"), F.lit(" League")).alias("current_league_name"),
        F.lit(None).cast("string").alias("previous_league_name"),
        F.concat(F.lit("Ground "), F.col("s_suppkey").cast("string")).alias("stadium_name"),
        X.stadium_band(seats).alias("stadium_capacity_band"),
        F.to_date(F.lit(fixed.SCD_FIRST_START)).alias("effective_date"),
        F.to_date(F.lit(fixed.SCD_OPEN_END)).alias("expiry_date"), F.lit(True).alias("is_current"))
    special = spark.createDataFrame(
        [(-1, -1, fixed.UNKNOWN_CLUB, fixed.UNKNOWN_SHORT, fixed.UNKNOWN, fixed.UNKNOWN, None, fixed.UNKNOWN, None,
          fixed.UNKNOWN, fixed.UNKNOWN),
         (-2, -2, fixed.NO_CLUB, fixed.NOT_APPLICABLE, fixed.NOT_APPLICABLE, fixed.NOT_APPLICABLE, None,
          fixed.NOT_APPLICABLE, None, fixed.NOT_APPLICABLE, fixed.NOT_APPLICABLE)],
        T.StructType(CLUB_DIM_SCHEMA.fields[:11]))
    special = special.select("*", F.to_date(F.lit(fixed.SCD_FIRST_START)).alias("effective_date"),
                             F.to_date(F.lit(fixed.SCD_OPEN_END)).alias("expiry_date"),
                             F.lit(True).alias("is_current"))
    return real.unionByName(special).select(*[F.col(f.name).cast(f.dataType) for f in CLUB_DIM_SCHEMA.fields])


def club_incoming_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _club_source(spark, sf_dir)
    bal = F.col("s_acctbal")
    moved = bal.between(1000, 2999.99) | (bal >= 9000)
    league_nation = F.when(moved, (F.col("s_nationkey") + 1) % 25).otherwise(F.col("s_nationkey"))
    seats = F.floor(bal * 10).cast("int")
    return src.select(
        F.col("s_suppkey").alias("club_id"),
        F.when((bal >= 0) & (bal < 2000), F.concat(F.col("s_name"), F.lit(" FC"))).otherwise(F.col("s_name"))
        .alias("club_name"),
        F.lit("Club").alias("club_type"), F.col("n_name").alias("country_name"), F.col("r_name").alias("confederation"),
        F.concat(F.lit("COMP"), (league_nation * 10 + 1).cast("string")).alias("current_league_id"),
        F.concat(F.lit("NATION_"), league_nation.cast("string"), F.lit(" League")).alias("current_league_name"),
        F.when(bal >= 8000, F.concat(F.lit("Arena "), F.col("s_suppkey").cast("string")))
        .otherwise(F.concat(F.lit("Ground "), F.col("s_suppkey").cast("string"))).alias("stadium_name"),
        X.stadium_band(seats).alias("stadium_capacity_band"))


def scd_merge_club(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD 1/2/3 merge of the incoming club rows into the v1 club dimension."""
    return WH.scd_merge(club_dim_v1(spark, sf_dir), club_incoming_v2(spark, sf_dir), WH.CLUB_SPEC, SCD_RUN_DATE)


def asof_club_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers → the buying club's version valid on the transfer date (miss → -1).

    The deals are counted per (club, date) first — a partial aggregate, so a club with a
    third of all deals reaches the shuffle as one row per task and day — and the as-of
    join runs on those counts; every deal of a (club, date) resolves to the same version."""
    from kickstar.operators.joins import asof_version_join
    dim = materialize(scd_merge_club(spark, sf_dir), "club-versions")      # read three times below
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate")
    ft = li.groupBy(F.col("l_suppkey").alias("club_id"), F.to_date("l_shipdate").alias("transfer_date")) \
        .agg(F.count(F.lit(1)).alias("__n"))
    out = asof_version_join(ft, dim, "club_id", "transfer_date", "club_key")
    return out.groupBy("club_key").agg(F.sum("__n").alias("deals"))


# ------------------------------------------------------------------ dimension staging from the driver tables

# fixed values (ours): region -> the source's confederation spelling
REGION_CONFEDERATION = (("AFRICA", "AFRIKA"), ("AMERICA", "AMERIKA"), ("ASIA", "ASIEN"), ("EUROPE", "EUROPA"),
                        ("MIDDLE EAST", "AFC"))


def _confed(region: "F.Column") -> "F.Column":
    out = None
    for r, c in REGION_CONFEDERATION:
        out = F.when(region == r, F.lit(c)) if out is None else out.when(region == r, F.lit(c))
    return out.otherwise(F.lit(None).cast("string"))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)


def stg_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo(spark, sf_dir).select(F.col("n_nationkey").cast("string").alias("country_id"),
                                      F.col("n_name").alias("country_name"), F.lit("BATCH_1").alias("batch_id"),
                                      F.col("n_nationkey").cast("long").alias("source_row"))


def stg_competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [("1", "League", "domestic_league"), ("2", "Cup", "domestic_cup")]
    g = _geo(spark, sf_dir)
    parts = []
    for code, kind, ctype in kinds:
        parts.append(g.select(
            F.concat(F.lit("COMP"), (F.col("n_nationkey") * 10 + int(code)).cast("string")).alias("competition_id"),
            F.concat_ws(" ", "n_name", F.lit(kind)).alias("name"), F.lit(ctype).alias("type"),
            F.lit(None).cast("string").alias("sub_type"), F.col("n_nationkey").cast("string").alias("country_id"),
            F.col("n_name").alias("country_name"), _confed(F.col("r_name")).alias("confederation"),
            F.lit("BATCH_1").alias("batch_id"), (F.col("n_nationkey") * 10 + int(code)).cast("long").alias("source_row")))
    return parts[0].unionByName(parts[1])


def stg_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return sup.select(
        F.col("s_suppkey").cast("string").alias("club_id"), F.col("s_name").alias("name"),
        F.concat(F.lit("COMP"), (F.col("s_nationkey") * 10 + 1).cast("string")).alias("domestic_competition_id"),
        F.concat(F.lit("Ground "), F.col("s_suppkey").cast("string")).alias("stadium_name"),
        F.floor(F.col("s_acctbal") * 10).cast("long").cast("string").alias("stadium_seats"),
        F.lit("BATCH_1").alias("batch_id"), F.col("s_suppkey").alias("source_row"))


def stg_national_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo(spark, sf_dir).select(
        (F.col("n_nationkey") + 100000).cast("string").alias("national_team_id"), F.col("n_name").alias("name"),
        F.col("n_name").alias("country_name"), _confed(F.col("r_name")).alias("confederation"),
        F.lit("BATCH_1").alias("batch_id"), F.col("n_nationkey").cast("long").alias("source_row"))


def stg_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    return cust.select(
        k.cast("string").alias("player_id"), F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("country_of_birth"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("country_of_citizenship"),
        star.position_of(F.col("c_mktsegment")).alias("position"), F.lit(None).cast("string").alias("sub_position"),
        F.when(k % 3 == 0, F.lit("left")).otherwise(F.lit("right")).alias("foot"),
        F.concat(F.lit("Agent "), (k % 13).cast("string")).alias("agent_name"),
        (k % 80 + 145).cast("string").alias("height_in_cm"), (k % 70).cast("string").alias("international_caps"),
        star.player_dob(k).cast("string").alias("date_of_birth"), F.lit("2027-06-30").alias("contract_expiration_date"),
        F.lit("BATCH_1").alias("batch_id"), k.alias("source_row"))


#: Equal source rows of club games are told apart by these values, as the load does.
CLUB_GAME_ORDER = ("own_goals", "opponent_goals", "opponent_id", "hosting", "own_position", "own_manager_name", "opponent_manager_name")


def write_csv_files(spark: SparkSession, staging: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """The staging tables as quoted CSV, a folder of files per table, in the order of the source
    rows (then of the values), so that row numbers keep that order; returns the folders.

    Columns of the source that a derived table lacks hold text with quotes, commas and line
    ends, which no load reads; it is put in once the rows are in order. The ranges are in number
    to the input, as for any shuffle: with a fixed number, a sort grows until it spills."""
    from kickstar.sources.staging import STAGING_COLUMNS
    out = {}
    for name, df in staging.items():
        columns = STAGING_COLUMNS[name]
        there = [c for c in columns if c in df.columns]
        filler = F.concat(F.lit('free "text", line one\nand line '), F.col("source_row").cast("string"))
        order = ["source_row", *(CLUB_GAME_ORDER if name == "club_games" else there)]
        path = f"{folder.rstrip('/')}/{name}"
        rows = df.select("source_row", *there).repartitionByRange(*order).sortWithinPartitions(*order) \
            .select(*[F.col(c) if c in there else filler.alias(c) for c in columns])
        with shuffles_removed(spark):
            (rows.write
             .option("header", "true").option("quote", '"').option("escape", '"').option("quoteAll", "true")
             .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").option("emptyValue", "").csv(path))
        out[name] = path
    return out


def csv_team_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Club games and games as CSV files, staged from them by byte ranges and loaded: the
    team-match facts of the staged load, which reads the same rows without the files. The files
    of a table, many times the staged rows, go as soon as it is staged from them."""
    import datetime as dt

    from kickstar.session import checkpoint_dir
    from kickstar.sources.staging import stage_csv
    import uuid
    root = f"{checkpoint_dir(spark).rstrip('/')}/kickstar-csv-{uuid.uuid4().hex}"
    stg = {}
    for name, rows in {"club_games": stg_club_games(spark, sf_dir), "games": stg_games(spark, sf_dir)}.items():
        files = write_csv_files(spark, {name: rows}, f"{root}/files")
        stg |= stage_csv(spark, files, f"{root}/staging", dt.datetime(2024, 7, 1), "BATCH_1")
        sinks.remove(spark, files[name])
    empty = spark.createDataFrame([], "match_key long, club_key long")
    fact, _ = WH.load_fact_team_match(stg["club_games"], stg["games"], team_dims(spark, sf_dir), empty, TEAM_WINDOW)
    return fact


def staging_from_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All ten staging tables, as text, derived from the driver tables."""
    return {
        "competitions": stg_competitions(spark, sf_dir), "countries": stg_countries(spark, sf_dir),
        "clubs": stg_clubs(spark, sf_dir), "national_teams": stg_national_teams(spark, sf_dir),
        "players": stg_players(spark, sf_dir), "games": stg_games(spark, sf_dir),
        "club_games": stg_club_games(spark, sf_dir), "appearances": stg_appearances(spark, sf_dir),
        "player_valuations": stg_player_valuations(spark, sf_dir), "transfers": stg_transfers(spark, sf_dir),
    }
