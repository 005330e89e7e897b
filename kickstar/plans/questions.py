"""Named business questions over the star.

Each function takes ``(spark, sf_dir, **params)`` and returns a DataFrame. Season,
competition, club and threshold literals of the original reports are parameters;
defaults are chosen to hit populated members of the driver data (the original
values are noted in each docstring).

Plan shape, everywhere: filter the fact through small filtered dimension key sets →
aggregate on surrogate keys (partial aggregation, skew-safe) → join the now-small
aggregate to the dimensions for names → re-aggregate by name when the report groups
by name → calculated members → ranks / top-n on the aggregated rows.

Ratios are returned unrounded (double from exact integer sums); rounding is display.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kickstar import fixed
from kickstar.frames import session_memo
from kickstar.functions import exprs as X
from kickstar.operators import agg as A
from kickstar.operators import keys as K
from kickstar.operators import windows as W
from kickstar.plans import measures as M
from kickstar.plans import star

# defaults (original report literal -> driver-data member)
SEASON = "1998/99"                  # '2015/16', '2024/25', '2012/13' in the reports
COMPETITION = "COMP31"              # 'GB1' (a national first division)
FORM_CLUB = "Supplier#000000001"    # 'Arsenal FC'
MANAGER_CLUB = "Supplier#000000002"  # 'Chelsea FC'
STRONG_CLUBS = tuple(f"Supplier#00000000{i}" for i in range(6))   # the "big six"
CAREER_PLAYER = "Customer#000000010"   # 'Mohamed Salah'
SEASONS_3 = ("1999/00", "1998/99", "1997/98")   # ('2013/14', '2012/13', '2011/12')
SEASONS_2 = ("1999/00", "1998/99")              # ('2013/14', '2012/13')


def _dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _seasons(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    """Filtered season members (≤ 42 rows by construction)."""
    return F.broadcast(star.dim_season(spark).filter(F.col("season_label").isin(*labels))
                       .select("season_key", "season_label", "season_start_year"))


def in_competitions(spark: SparkSession, sf_dir: str, fact: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Fact rows of the named competitions: the members are looked up in the dimension by id
    and the fact is semi-joined to their keys."""
    return fact.join(_competitions(spark, sf_dir, ids), "competition_key", "left_semi").select(*fact.columns)


def _competitions(spark: SparkSession, sf_dir: str, ids: Sequence[str]) -> DataFrame:
    return (star.dim_competition(spark, sf_dir).filter(F.col("competition_id").isin(*ids))
            .select("competition_key"))


def _clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_club(spark, sf_dir).select("club_key", "club_name")


def team_sums() -> dict[str, Column]:
    """Base measures of the team-match fact (built lazily: Columns need a session)."""
    return {
    "matches": A.count_rows(),
    "wins": F.sum("is_win"),
    "draws": F.sum("is_draw"),
    "losses": F.sum("is_loss"),
    "goals_for": F.sum("goals_for"),
    "goals_against": F.sum("goals_against"),
    "goal_difference": F.sum("goal_difference"),
    "points": F.sum("points"),
    "clean_sheets": F.sum("is_clean_sheet"),
    }


TEAM_MEASURES = ("matches", "wins", "draws", "losses", "goals_for", "goals_against", "goal_difference", "points",
                 "clean_sheets")


def _team_by_club(spark: SparkSession, sf_dir: str, season: str | None = None,
                  competition: str | None = None, extra: dict[str, Column] | None = None) -> DataFrame:
    """Team-match sums per club name (club_key <> -1), pre-aggregated per club key."""
    tm = star.team_match(spark, sf_dir, ship_range=star.season_span([season]) if season else None)
    if season is not None:
        tm = tm.join(_seasons(spark, [season]).select("season_key"), "season_key", "left_semi")
    if competition is not None:
        tm = in_competitions(spark, sf_dir, tm, [competition])
    tm = tm.filter(F.col("club_key") != -1)
    aggs = dict(team_sums(), **(extra or {}))
    per_key = tm.groupBy("club_key").agg(*[c.alias(n) for n, c in aggs.items()])
    named = per_key.join(_clubs(spark, sf_dir), "club_key")
    # the reports group by club name: merge keys that share a name
    return named.groupBy("club_name").agg(*[F.sum(n).alias(n) for n in aggs])


# ------------------------------------------------------------------ team performance (P1)

def t1_league_table(spark: SparkSession, sf_dir: str, competition: str = COMPETITION,
                    season: str = SEASON) -> DataFrame:
    """League table of one competition and season, RANK on points, GD, GF."""
    t = _team_by_club(spark, sf_dir, season, competition)
    # a league's clubs grow with the data (clubs = suppliers of a nation): distributed RANK
    t = K.global_rank(t, ["points", "goal_difference", "goals_for"], "rank", ascending=[False, False, False])
    return t.select("club_name", "matches", "wins", "draws", "losses", "goals_for", "goals_against",
                    "goal_difference", "points", F.col("rank").cast("int").alias("rank"))


def t2_most_wins(spark: SparkSession, sf_dir: str, season: str = SEASON, n: int = 10) -> DataFrame:
    t = _team_by_club(spark, sf_dir, season)
    t = t.select("club_name", "matches", "wins", (_dbl("wins") * 100.0 / _dbl("matches")).alias("win_rate_pct"))
    return W.top_n(t, n, [F.desc("wins"), F.desc("win_rate_pct"), F.asc("club_name")])


def t3_best_attack(spark: SparkSession, sf_dir: str, season: str = SEASON, n: int = 10) -> DataFrame:
    t = _team_by_club(spark, sf_dir, season,
                      extra={"matches_3plus": A.conditional_sum(F.col("goals_for") >= 3)})
    t = t.select("club_name", "matches", "goals_for",
                 (_dbl("goals_for") / _dbl("matches")).alias("goals_per_match"), "matches_3plus")
    return W.top_n(t, n, [F.desc("goals_for"), F.desc("goals_per_match"), F.asc("club_name")])


def t4_best_defence(spark: SparkSession, sf_dir: str, season: str = SEASON, n: int = 10) -> DataFrame:
    t = _team_by_club(spark, sf_dir, season)
    t = t.select("club_name", "matches", "goals_against",
                 (_dbl("goals_against") / _dbl("matches")).alias("goals_against_per_match"),
                 "clean_sheets", (_dbl("clean_sheets") * 100.0 / _dbl("matches")).alias("clean_sheet_rate_pct"))
    return W.top_n(t, n, [F.desc("clean_sheet_rate_pct"), F.asc("goals_against"), F.asc("club_name")])


def t5_home_away_split(spark: SparkSession, sf_dir: str, season: str = SEASON) -> DataFrame:
    home, away = F.col("is_home") == 1, F.col("is_home") == 0
    extra = {
        "home_matches": A.conditional_sum(home),
        "home_wins": A.conditional_sum(home & (F.col("is_win") == 1)),
        "home_points": A.conditional_sum(home, F.col("points")),
        "home_gd": A.conditional_sum(home, F.col("goal_difference")),
        "away_matches": A.conditional_sum(away),
        "away_wins": A.conditional_sum(away & (F.col("is_win") == 1)),
        "away_points": A.conditional_sum(away, F.col("points")),
        "away_gd": A.conditional_sum(away, F.col("goal_difference")),
    }
    t = _team_by_club(spark, sf_dir, season, extra=extra)
    return t.select(
        "club_name", "home_matches",
        A.ratio_of_sums(F.col("home_wins"), F.col("home_matches"), 100.0).alias("home_win_rate_pct"),
        A.ratio_of_sums(F.col("home_points"), F.col("home_matches")).alias("home_points_per_match"),
        "home_gd", "away_matches",
        A.ratio_of_sums(F.col("away_wins"), F.col("away_matches"), 100.0).alias("away_win_rate_pct"),
        A.ratio_of_sums(F.col("away_points"), F.col("away_matches")).alias("away_points_per_match"),
        "away_gd")


def t6_season_form(spark: SparkSession, sf_dir: str, club: str = FORM_CLUB) -> DataFrame:
    """Season trend of one club with the year-on-year change of points per match (LAG over rows)."""
    clubs = star.dim_club(spark, sf_dir).filter(F.col("club_name") == club).select("club_key")
    tm = star.team_match(spark, sf_dir).join(clubs, "club_key", "left_semi")
    per = tm.groupBy("season_key").agg(A.count_rows().alias("matches"), F.sum("points").alias("points"),
                                       F.sum("is_win").alias("wins"), F.sum("goal_difference").alias("goal_difference"),
                                       F.max("league_position").alias("max_league_position"))
    per = per.join(F.broadcast(star.dim_season(spark)), "season_key")
    ppm = _dbl("points") / _dbl("matches")
    w = Window.orderBy("season_start_year")   # one club's seasons: bounded
    return per.select(
        "season_label", ppm.alias("points_per_match"),
        (_dbl("wins") * 100.0 / _dbl("matches")).alias("win_rate_pct"), "goal_difference",
        (ppm - F.lag(ppm).over(w)).alias("ppm_change_yoy"))


def t7_club_managers(spark: SparkSession, sf_dir: str, club: str = MANAGER_CLUB, min_matches: int = 10) -> DataFrame:
    clubs = star.dim_club(spark, sf_dir).filter(F.col("club_name") == club).select("club_key", "club_name")
    tm = star.team_match(spark, sf_dir, with_manager=True).filter(F.col("manager_key") != -1)
    tm = tm.join(clubs.select("club_key"), "club_key", "left_semi")
    per = tm.groupBy("club_key", "manager_key").agg(
        A.count_rows().alias("matches"), F.sum("is_win").alias("wins"), F.sum("points").alias("points"),
        F.sum("goal_difference").alias("goal_difference"))
    per = per.join(clubs, "club_key").join(star.dim_manager(spark, sf_dir), "manager_key")
    g = per.groupBy("club_name", "manager_name").agg(*[F.sum(c).alias(c) for c in
                                                       ("matches", "wins", "points", "goal_difference")])
    g = g.filter(F.col("matches") >= min_matches)
    return g.select("club_name", "manager_name", "matches", "wins",
                    (_dbl("wins") * 100.0 / _dbl("matches")).alias("win_rate_pct"),
                    (_dbl("points") / _dbl("matches")).alias("points_per_match"), "goal_difference")


def t8_vs_strong_opponents(spark: SparkSession, sf_dir: str, season: str = SEASON,
                           strong: Sequence[str] = STRONG_CLUBS) -> DataFrame:
    clubs = _clubs(spark, sf_dir)
    strong_keys = clubs.filter(F.col("club_name").isin(*strong)).select(F.col("club_key").alias("opponent_club_key"))
    tm = star.team_match(spark, sf_dir, with_opponent=True, ship_range=star.season_span([season])) \
        .join(_seasons(spark, [season]).select("season_key"), "season_key", "left_semi")
    tm = tm.join(strong_keys, "opponent_club_key", "left_semi")   # role: opponent
    sums = team_sums()
    per = tm.groupBy("club_key").agg(*[sums[k].alias(k) for k in
                                       ("matches", "wins", "draws", "losses", "points", "goals_for", "goals_against")])
    per = per.join(clubs, "club_key").filter(~F.col("club_name").isin(*strong))   # role: club
    g = per.groupBy("club_name").agg(*[F.sum(c).alias(c) for c in
                                       ("matches", "wins", "draws", "losses", "points", "goals_for", "goals_against")])
    return g.select("club_name", "matches", "wins", "draws", "losses",
                    (_dbl("points") / _dbl("matches")).alias("points_per_match"), "goals_for", "goals_against")


# ------------------------------------------------------------------ advanced team reports (Q 1, 6, 7, 10)

def bq_home_advantage(spark: SparkSession, sf_dir: str, min_matches: int = 20, top: int = 3) -> DataFrame:
    """Top clubs by home win rate inside each competition (DENSE_RANK <= top)."""
    tm = star.team_match(spark, sf_dir)
    home, away = F.col("is_home") == 1, F.col("is_home") == 0
    sums = {
        "total_matches": A.count_rows(),
        "home_matches": A.conditional_sum(home),
        "home_wins": A.conditional_sum(home & (F.col("is_win") == 1)),
        "home_goals_scored": A.conditional_sum(home, F.col("goals_for")),
        "away_matches": A.conditional_sum(away),
        "away_wins": A.conditional_sum(away & (F.col("is_win") == 1)),
        "total_clean_sheets": F.sum("is_clean_sheet"),
    }
    per = tm.groupBy("competition_key", "club_key").agg(*[c.alias(n) for n, c in sums.items()])
    comp = star.dim_competition(spark, sf_dir).select("competition_key", "competition_name")
    per = per.join(comp, "competition_key").join(_clubs(spark, sf_dir), "club_key")
    g = per.groupBy("competition_name", "club_name").agg(*[F.sum(n).alias(n) for n in sums])
    g = g.filter(F.col("total_matches") >= min_matches)
    hw = A.ratio_of_sums(F.col("home_wins"), F.col("home_matches"), 100.0)
    aw = A.ratio_of_sums(F.col("away_wins"), F.col("away_matches"), 100.0)
    g = g.select("*", hw.alias("home_win_rate_pct"), aw.alias("away_win_rate_pct"))
    ranked = W.top_per_group(g, ["competition_name"],
                             [F.desc_nulls_last("home_win_rate_pct"), F.desc("home_goals_scored")], top,
                             name="home_rank")
    return ranked.select("competition_name", "home_rank", "club_name", "home_matches", "home_wins",
                         "home_win_rate_pct", "away_win_rate_pct",
                         (F.col("home_win_rate_pct") - F.col("away_win_rate_pct")).alias("home_advantage_delta"),
                         "total_clean_sheets")


def _manager_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tm = star.team_match(spark, sf_dir, with_manager=True).filter(F.col("manager_key") != -1)
    per = tm.groupBy("manager_key").agg(*[c.alias(n) for n, c in team_sums().items()])
    per = per.join(star.dim_manager(spark, sf_dir), "manager_key")
    return per.groupBy("manager_name").agg(*[F.sum(n).alias(n) for n in TEAM_MEASURES])


def bq_manager_ppm(spark: SparkSession, sf_dir: str, min_matches: int = 25, n: int = 15) -> DataFrame:
    g = _manager_table(spark, sf_dir).filter(F.col("matches") >= min_matches)
    g = g.select("*", (_dbl("wins") * 100.0 / _dbl("matches")).alias("win_rate_pct"),
                 (_dbl("points") / _dbl("matches")).alias("points_per_match"))
    order = [F.desc("points_per_match"), F.desc("win_rate_pct")]
    top = W.top_n_ranked(g, n, order + [F.asc("manager_name")], order, "rank_manager", kind="dense_rank")
    return top.select("rank_manager", "manager_name", F.col("matches").alias("total_games_managed"),
                      F.col("wins").alias("total_wins"), F.col("draws").alias("total_draws"),
                      F.col("losses").alias("total_losses"), "win_rate_pct", "points_per_match",
                      F.col("goals_for").alias("goals_scored"), F.col("goals_against").alias("goals_conceded"),
                      "goal_difference", "clean_sheets")


def bq_goals_rollup(spark: SparkSession, sf_dir: str, season: str = SEASON) -> DataFrame:
    """ROLLUP(confederation, country, competition) with GROUPING_ID and total labels.

    The fact is first summed per competition key; the rollup's Expand then runs on
    one row per competition instead of one per fact row (sums and counts re-add)."""
    tm = star.team_match(spark, sf_dir, ship_range=star.season_span([season])) \
        .join(_seasons(spark, [season]).select("season_key"), "season_key", "left_semi")
    per = tm.groupBy("competition_key").agg(A.count_rows().alias("n"), F.sum("goals_for").alias("gf"),
                                            F.sum("is_clean_sheet").alias("cs"))
    comp = star.dim_competition(spark, sf_dir)
    per = per.join(comp, "competition_key")
    r = per.rollup("confederation", "country_name", "competition_name").agg(
        F.grouping_id().alias("grouping_level"), F.grouping("confederation").alias("g_conf"),
        F.grouping("country_name").alias("g_country"), F.grouping("competition_name").alias("g_comp"),
        F.sum("n").alias("team_matches"), F.sum("gf").alias("goals"), F.sum("cs").alias("clean_sheets"))
    return r.select(
        F.col("grouping_level").cast("int").alias("grouping_level"),
        F.when(F.col("g_conf") == 1, F.lit(fixed.ROLLUP_GRAND_TOTAL)).otherwise(F.col("confederation"))
        .alias("confederation_label"),
        F.when(F.col("g_country") == 1, F.lit(fixed.ROLLUP_CONFED_TOTAL))
        .when(F.col("country_name").isNull(), F.lit(fixed.ROLLUP_NO_COUNTRY)).otherwise(F.col("country_name"))
        .alias("country_label"),
        F.when(F.col("g_comp") == 1, F.lit(fixed.ROLLUP_COUNTRY_TOTAL)).otherwise(F.col("competition_name"))
        .alias("competition_label"),
        "team_matches", "goals",
        A.ratio_of_sums(F.col("goals"), F.col("team_matches")).alias("goals_per_team_match"),
        A.ratio_of_sums(F.col("clean_sheets"), F.col("team_matches"), 100.0).alias("clean_sheet_pct"))


def standing_rollup(team_match: DataFrame) -> DataFrame:
    """The stored season × club aggregate: SUM and COUNT only, so coarser levels stay exact."""
    return team_match.groupBy("season_key", "club_key").agg(
        A.count_rows().alias("matches"), F.sum(F.coalesce("points", F.lit(0))).alias("points"),
        F.sum(F.coalesce("is_win", F.lit(0))).alias("wins"), F.sum(F.coalesce("is_draw", F.lit(0))).alias("draws"),
        F.sum(F.coalesce("is_loss", F.lit(0))).alias("losses"),
        F.sum(F.coalesce("goals_for", F.lit(0))).alias("goals_for"),
        F.sum(F.coalesce("goals_against", F.lit(0))).alias("goals_against"))


@session_memo
def stored_standing(spark: SparkSession, sf_dir: str, node: str = "season_club") -> DataFrame:
    """A stored node of the standing lattice: season x club, or season, which is summed from it."""
    import hashlib
    import inspect
    rule = hashlib.sha1(inspect.getsource(standing_rollup).encode()).hexdigest()[:8]
    if node == "season":
        finer = stored_standing(spark, sf_dir)
        rows = finer.groupBy("season_key").agg(*[F.sum(c).alias(c) for c in finer.columns if c not in ("season_key", "club_key")])
    else:
        rows = standing_rollup(star.team_match(spark, sf_dir))
    return star._store(spark, sf_dir, rows, f"mv_standing_{node}-{rule}", None, True)


def bq_mv_standings(spark: SparkSession, sf_dir: str, season: str = SEASON, n: int = 10,
                    rollup: DataFrame | None = None) -> DataFrame:
    """Top clubs read from the stored season × club aggregate (RANK on points, GD)."""
    mv = rollup if rollup is not None else stored_standing(spark, sf_dir)
    v = mv.join(_seasons(spark, [season]).select("season_key"), "season_key", "left_semi") \
        .join(_clubs(spark, sf_dir), "club_key")
    gd = F.col("goals_for") - F.col("goals_against")
    v = v.select("*", gd.alias("goal_difference"))
    rank_order = [F.desc("points"), F.desc("goal_difference")]
    top = W.top_n_ranked(v, n, rank_order + [F.asc("club_name"), F.asc("club_key")], rank_order, "rank")
    return top.select("rank", "club_name", "matches", "wins", "draws", "losses", "points", "goal_difference",
                      A.ratio_of_sums(F.col("points"), F.col("matches")).alias("points_per_match"),
                      A.ratio_of_sums(F.col("wins"), F.col("matches"), 100.0).alias("win_rate_pct"))


def bq_mv_season_rates(spark: SparkSession, sf_dir: str, seasons: Sequence[str] = SEASONS_3,
                       rollup: DataFrame | None = None) -> DataFrame:
    """Season rates from the stored sums (never averages of ratios), of the season node."""
    mv = rollup if rollup is not None else stored_standing(spark, sf_dir, "season")
    v = mv.join(_seasons(spark, seasons), "season_key")
    g = v.groupBy("season_label").agg(F.sum("matches").alias("matches"), F.sum("wins").alias("wins"),
                                      F.sum("points").alias("points"))
    return g.select("season_label", "matches",
                    A.ratio_of_sums(F.col("wins"), F.col("matches"), 100.0).alias("win_rate_pct"),
                    A.ratio_of_sums(F.col("points"), F.col("matches")).alias("points_per_match"))


# ------------------------------------------------------------------ player performance (Q 2, 9, 11; P2; C4)

FIVE_COMPETITIONS = ("COMP31", "COMP11", "COMP21", "COMP41", "COMP51")   # ('GB1','ES1','L1','IT1','FR1')
REFEREE_UNKNOWN = fixed.UNKNOWN
EXCLUDED_POSITIONS = (fixed.UNKNOWN, "Missing")


def _appearances(spark: SparkSession, sf_dir: str, season: str | None = None,
                 competitions: Sequence[str] | None = None) -> DataFrame:
    fa = star.player_appearance(spark, sf_dir, ship_range=star.season_span([season]) if season else None)
    if season is not None:
        fa = fa.join(_seasons(spark, [season]).select("season_key"), "season_key", "left_semi")
    if competitions is not None:
        fa = in_competitions(spark, sf_dir, fa, competitions)
    return fa


def _players(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return star.dim_player(spark, sf_dir).select("player_key", *cols)


def bq_top_scorers(spark: SparkSession, sf_dir: str, min_minutes: int = 45, min_goals: int = 2,
                   top: int = 3) -> DataFrame:
    """Top scorers per season × competition (DENSE_RANK on goals, assists <= top).

    Report thresholds were 900 minutes and 10 goals; defaults fit the driver data."""
    fa = star.player_appearance(spark, sf_dir).filter(F.col("minutes_played") > 0)
    keys = ["season_key", "competition_key", "player_key", "club_key"]
    sums = {"total_matches_played": F.sum("appearance_count"), "total_minutes": F.sum("minutes_played"),
            "total_goals": F.sum("goals"), "total_assists": F.sum("assists")}
    per = fa.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()])
    per = (per.join(F.broadcast(star.dim_season(spark).select("season_key", "season_label")), "season_key")
           .join(star.dim_competition(spark, sf_dir).select("competition_key", "competition_name"),
                 "competition_key")
           .join(_players(spark, sf_dir, "full_name"), "player_key")
           .join(_clubs(spark, sf_dir), "club_key"))
    g = per.groupBy("season_label", "competition_name", F.col("full_name").alias("player_name"), "club_name") \
        .agg(*[F.sum(n).alias(n) for n in sums])
    g = g.filter((F.col("total_minutes") >= min_minutes) & (F.col("total_goals") >= min_goals))
    r = W.top_per_group(g, ["season_label", "competition_name"], [F.desc("total_goals"), F.desc("total_assists")],
                        top, name="rank_top_scorer")
    return r.select("season_label", "competition_name", "rank_top_scorer", "player_name", "club_name",
                    "total_matches_played", "total_minutes", "total_goals", "total_assists",
                    (F.col("total_goals") + F.col("total_assists")).alias("goal_contributions"),
                    A.ratio_of_sums(F.col("total_minutes"), F.col("total_goals")).alias("minutes_per_goal"),
                    A.ratio_of_sums(F.col("total_goals") + F.col("total_assists"), F.col("total_minutes"), 90.0)
                    .alias("contributions_per_90"))


def _player_sums(fa: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    return fa.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()])


def p1_scorers(spark: SparkSession, sf_dir: str, competition: str = COMPETITION, season: str = "1997/98",
               n: int = 5) -> DataFrame:
    fa = _appearances(spark, sf_dir, season, [competition]).filter(F.col("player_key") > 0)
    per = _player_sums(fa, ["player_key"], {"goals": F.sum("goals"), "assists": F.sum("assists"),
                                             "minutes": F.sum("minutes_played")})
    per = per.join(_players(spark, sf_dir, "full_name"), "player_key")
    per = per.select("player_key", "full_name", "goals", "assists", "minutes",
                     A.ratio_of_sums(F.col("goals"), F.col("minutes"), 90.0).alias("goals_per_90"))
    return W.top_n(per, n, [F.desc("goals"), F.desc("assists"), F.asc("player_key")])


def p2_striker_efficiency(spark: SparkSession, sf_dir: str, competition: str = COMPETITION,
                          season: str = "1997/98", position: str = "Attack", min_minutes: int = 45,
                          n: int = 5) -> DataFrame:
    """Goals per 90 of one position, minimum minutes (report: 900)."""
    fa = _appearances(spark, sf_dir, season, [competition]).filter(F.col("player_key") > 0)
    per = _player_sums(fa, ["player_key"], {"goals": F.sum("goals"), "minutes": F.sum("minutes_played")})
    pl = star.dim_player(spark, sf_dir).filter(F.col("position") == position) \
        .select("player_key", "full_name", "sub_position")
    per = per.join(pl, "player_key").filter(F.col("minutes") >= min_minutes)
    per = per.select("player_key", "full_name", "sub_position", "goals", "minutes",
                     A.ratio_of_sums(F.col("goals"), F.col("minutes"), 90.0).alias("goals_per_90"))
    return W.top_n(per, n, [F.desc_nulls_last("goals_per_90"), F.asc("player_key")])


def p3_most_used(spark: SparkSession, sf_dir: str, season: str = "1997/98", n: int = 5) -> DataFrame:
    fa = _appearances(spark, sf_dir, season).filter(F.col("player_key") > 0)
    per = _player_sums(fa, ["player_key", "club_key"], {"appearances": F.sum("appearance_count"),
                                                         "minutes": F.sum("minutes_played")})
    per = per.join(_players(spark, sf_dir, "full_name"), "player_key").join(_clubs(spark, sf_dir), "club_key")
    per = per.select("player_key", "full_name", "club_key", "club_name", "appearances", "minutes")
    return W.top_n(per, n, [F.desc("appearances"), F.desc("minutes"), F.asc("player_key"), F.asc("club_key")])


def p4_goals_by_position(spark: SparkSession, sf_dir: str, season: str = "1997/98",
                         competitions: Sequence[str] = FIVE_COMPETITIONS) -> DataFrame:
    fa = _appearances(spark, sf_dir, season, competitions).filter(F.col("player_key") > 0)
    pl = star.dim_player(spark, sf_dir).filter(F.col("position") != fixed.UNKNOWN).select("player_key", "position")
    comp = star.dim_competition(spark, sf_dir).select("competition_key", "competition_name")
    return M.evaluate(fa, ["competition_name", "position"], ["m_goals", "m_assists", "m_minutes"],
                      dims=[(pl, "player_key"), (comp, "competition_key")]) \
        .select("competition_name", "position", F.col("m_goals").alias("goals"),
                F.col("m_assists").alias("assists"), F.col("m_minutes").alias("minutes"))


def _referee_cards(fa: DataFrame, spark: SparkSession, sf_dir: str, measures: Sequence[str]) -> DataFrame:
    ref = star.dim_match(spark, sf_dir).filter(F.col("referee") != REFEREE_UNKNOWN).select("match_key", "referee")
    return M.evaluate(fa, ["referee"], measures, dims=[(ref, "match_key")])


def p5_strict_referees(spark: SparkSession, sf_dir: str, season: str = "1997/98", min_matches: int = 10,
                       n: int = 5) -> DataFrame:
    g = _referee_cards(_appearances(spark, sf_dir, season), spark, sf_dir, ["cards_per_match"])
    g = g.filter(F.col("m_distinct_matches") >= min_matches)
    g = g.select("referee", F.col("m_distinct_matches").alias("matches"), F.col("m_yellow").alias("yellows"),
                 F.col("m_red").alias("reds"), "cards_per_match")
    return W.top_n(g, n, [F.desc_nulls_last("cards_per_match"), F.asc("referee")])


def p6_young_minutes(spark: SparkSession, sf_dir: str, season: str = "1997/98", max_age: int = 21,
                     n: int = 5) -> DataFrame:
    fa = _appearances(spark, sf_dir, season).filter(F.col("player_key") > 0)
    per = _player_sums(fa, ["player_key", "season_key"], {"minutes": F.sum("minutes_played"),
                                                           "appearances": F.sum("appearance_count"),
                                                           "goals": F.sum("goals")})
    pl = star.dim_player(spark, sf_dir).filter(F.col("date_of_birth").isNotNull()) \
        .select("player_key", "full_name", "date_of_birth")
    per = per.join(pl, "player_key").join(F.broadcast(star.dim_season(spark)), "season_key")
    per = per.withColumn("age", X.season_age(F.col("season_start_year"), F.col("date_of_birth"))) \
        .filter(F.col("age") < max_age)
    g = per.groupBy("player_key", "full_name", "age").agg(*[F.sum(c).alias(c) for c in
                                                            ("minutes", "appearances", "goals")])
    return W.top_n(g, n, [F.desc("minutes"), F.asc("player_key")])


def bq_strict_referees(spark: SparkSession, sf_dir: str, min_matches: int = 50, n: int = 10) -> DataFrame:
    g = _referee_cards(star.player_appearance(spark, sf_dir), spark, sf_dir, ["total_cards", "cards_per_match"])
    g = g.filter(F.col("m_distinct_matches") >= min_matches)
    g = g.select("referee", F.col("m_distinct_matches").alias("matches"), F.col("m_yellow").alias("yellows"),
                 F.col("m_red").alias("reds"), "total_cards", "cards_per_match")
    return W.top_n(g, n, [F.desc_nulls_last("cards_per_match"), F.asc("referee")])


def bq_cards_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    pl = star.dim_player(spark, sf_dir).filter(~F.col("position").isin(*EXCLUDED_POSITIONS)) \
        .select("player_key", "position")
    g = M.evaluate(star.player_appearance(spark, sf_dir), ["position"], ["total_cards"], dims=[(pl, "player_key")])
    g = g.select("position", F.col("m_yellow").alias("yellows"), F.col("m_red").alias("reds"), "total_cards")
    return W.share_of_partition(g, "total_cards", [], "pct")


def bq_fair_play(spark: SparkSession, sf_dir: str, competition: str = COMPETITION, season: str = SEASON,
                 n: int = 5) -> DataFrame:
    fa = _appearances(spark, sf_dir, season, [competition])
    per = _player_sums(fa, ["club_key"], {"yellows": F.sum("yellow_cards"), "reds": F.sum("red_cards")})
    g = per.join(_clubs(spark, sf_dir), "club_key").groupBy("club_name").agg(
        F.sum("yellows").alias("yellows"), F.sum("reds").alias("reds"))
    g = g.select("club_name", "yellows", "reds", (F.col("yellows") + F.col("reds")).alias("total_cards"),
                 (F.col("yellows") * 1 + F.col("reds") * 3).alias("discipline_points"))
    return W.top_n(g, n, [F.desc("discipline_points"), F.asc("club_name")])


def bq_player_career(spark: SparkSession, sf_dir: str, player: str = CAREER_PLAYER) -> DataFrame:
    """One player's seasons: running total, 3-season moving average, LAG/LEAD, growth, career share.

    SQL window semantics (walk the rows with data); the MDX form that walks the season
    dimension is ``c_player_career_members``."""
    pl = star.dim_player(spark, sf_dir).filter(F.col("full_name") == player).select("player_key")
    fa = star.player_appearance(spark, sf_dir).join(pl, "player_key", "left_semi")
    per = fa.groupBy("season_key").agg(F.sum("goals").alias("goals"), F.sum("assists").alias("assists"),
                                       F.sum("minutes_played").alias("minutes"))
    per = per.join(F.broadcast(star.dim_season(spark).select("season_key", "season_label")), "season_key")
    w = Window.orderBy("season_key")            # one player's seasons: bounded
    lag = F.lag("goals").over(w)
    return per.select(
        "season_label", "goals", "assists", "minutes",
        F.sum("goals").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("goals_running"),
        F.avg(F.col("goals").cast("double")).over(w.rowsBetween(-2, 0)).alias("goals_moving_avg_3"),
        lag.alias("goals_prev"), F.lead("goals").over(w).alias("goals_next"),
        A.ratio_of_sums(F.col("goals") - lag, lag, 100.0).alias("growth_pct"),
        A.ratio_of_sums(F.col("goals"), F.sum("goals").over(Window.partitionBy()), 100.0).alias("career_share_pct"))


# ------------------------------------------------------------------ discipline cube (C4)

def _disc_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_club(spark, sf_dir).select("club_key", "club_name")


def d4_goals_per_card(spark: SparkSession, sf_dir: str, season: str = SEASON, min_matches: int = 30,
                      n: int = 10) -> DataFrame:
    fa = _appearances(spark, sf_dir, season)
    g = M.evaluate(fa, ["club_key", "club_name"], ["total_cards", "goals_per_card", "m_distinct_matches"],
                   dims=[(_disc_clubs(spark, sf_dir), "club_key")])
    g = g.filter(F.col("m_distinct_matches") >= min_matches)
    g = g.select("club_key", "club_name", F.col("m_goals").alias("goals"), "total_cards", "goals_per_card")
    return W.top_n(g, n, [F.desc_nulls_last("goals_per_card"), F.asc("club_key")])


def d5_cards_drilldown(spark: SparkSession, sf_dir: str, confederation: str = "EUROPE",
                       season: str = SEASON) -> DataFrame:
    """Children (countries) of one confederation, ordered by cards per match."""
    from kickstar.plans import cube
    comp = star.dim_competition(spark, sf_dir).select("competition_key", "confederation", "country_name")
    out = cube.cube_drilldown(_appearances(spark, sf_dir, season), "confederation", confederation, "country_name",
                              ["total_cards", "cards_per_match"], "cards_per_match",
                              dims=[(comp, "competition_key")])
    return out.select("country_name", F.col("m_distinct_matches").alias("matches"), "total_cards",
                      "cards_per_match")


def d6_cards_by_round_type(spark: SparkSession, sf_dir: str, season: str = SEASON) -> DataFrame:
    m = star.dim_match(spark, sf_dir).select("match_key", "round_type")
    g = M.evaluate(_appearances(spark, sf_dir, season), ["round_type"], ["cards_per_match"], dims=[(m, "match_key")])
    return g.select("round_type", F.col("m_distinct_matches").alias("matches"), F.col("m_yellow").alias("yellows"),
                    F.col("m_red").alias("reds"), "cards_per_match")


def d7_minutes_per_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kickstar.plans import cube
    pl = cube.except_members(star.dim_player(spark, sf_dir), "position", EXCLUDED_POSITIONS) \
        .select("player_key", "position")
    g = M.evaluate(star.player_appearance(spark, sf_dir), ["position"], ["minutes_per_yellow"],
                   dims=[(pl, "player_key")])
    return g.select("position", F.col("m_minutes").alias("minutes"), F.col("m_yellow").alias("yellows"),
                    "minutes_per_yellow")


def d8_red_rate_referees(spark: SparkSession, sf_dir: str, min_matches: int = 50, n: int = 10) -> DataFrame:
    g = _referee_cards(star.player_appearance(spark, sf_dir), spark, sf_dir, ["red_per_match", "red_share"])
    g = g.filter(F.col("m_distinct_matches") >= min_matches)
    g = g.select("referee", F.col("m_distinct_matches").alias("matches"), F.col("m_red").alias("reds"),
                 "red_per_match", "red_share")
    return W.top_n(g, n, [F.desc_nulls_last("red_per_match"), F.asc("referee")])


# ------------------------------------------------------------------ market: valuations and transfers (Q 3-5, 8, 9; P3)

VALUE_YEAR = 2024           # the reports use 2024 and 2011-2014
NET_SPEND_SEASON = SEASON   # '2024/25'


def _mil(c: Column | str) -> Column:
    return _dbl(c) / F.lit(1_000_000.0)


def bq_value_by_age(spark: SparkSession, sf_dir: str, year_from: int = 2021, year_to: int = 2024) -> DataFrame:
    """Valuation level and growth per year × age bracket, with the bracket's share of the year's growth."""
    fv = star.player_valuation(spark, sf_dir)
    fv = fv.withColumn("valuation_year", (F.col("date_key") / 10000).cast("int")) \
        .filter(F.col("market_value_eur").isNotNull() & F.col("age_at_valuation").isNotNull()
                & F.col("valuation_year").between(year_from, year_to))
    chg = F.col("value_change_eur")
    g = fv.groupBy("valuation_year", X.age_bracket4(F.col("age_at_valuation")).alias("age_bracket")).agg(
        F.count_distinct("player_key").alias("unique_players_evaluated"),
        F.avg(_dbl("market_value_eur")).alias("__avg"),
        F.max("market_value_eur").alias("__peak"),
        F.sum(F.when(chg > 0, chg).otherwise(0)).alias("__inc"),
        F.sum(F.when(chg < 0, F.abs(chg)).otherwise(0)).alias("__dec"))
    g = W.share_of_partition(g, "__inc", ["valuation_year"], "share_of_annual_growth_pct")
    return g.select("valuation_year", "age_bracket", "unique_players_evaluated",
                    (F.col("__avg") / F.lit(1_000_000.0)).alias("avg_market_value_mil_eur"),
                    _mil("__peak").alias("peak_player_market_value_mil"),
                    _mil("__inc").alias("total_value_increase_mil_eur"),
                    _mil("__dec").alias("total_value_decrease_mil_eur"),
                    (_mil("__inc") - _mil("__dec")).alias("net_valuation_growth_mil"),
                    "share_of_annual_growth_pct")


def _transfers(spark: SparkSession, sf_dir: str, seasons: Sequence[str] | None = None) -> DataFrame:
    ft = star.transfer(spark, sf_dir, ship_range=star.season_span(seasons) if seasons else None)
    if seasons is not None:
        ft = ft.join(_seasons(spark, seasons).select("season_key"), "season_key", "left_semi")
    return ft


def bq_net_spend_premium(spark: SparkSession, sf_dir: str, seasons: Sequence[str] = SEASONS_3,
                         n: int = 15) -> DataFrame:
    """Buyers ⟗ sellers per (club, season); net spend, premium paid and a strategy label."""
    from kickstar.operators.joins import full_outer_role_merge
    ft = _transfers(spark, sf_dir, seasons).filter(F.col("transfer_fee_eur").isNotNull())
    buy = ft.filter(F.col("to_club_key") > 0).groupBy(F.col("to_club_key").alias("club_key"), "season_key").agg(
        A.count_rows().alias("bought_count"), F.sum("transfer_fee_eur").alias("__spent"),
        F.sum("fee_premium_eur").alias("__prem"))
    sell = ft.filter(F.col("from_club_key") > 0).groupBy(F.col("from_club_key").alias("club_key"), "season_key") \
        .agg(A.count_rows().alias("sold_count"), F.sum("transfer_fee_eur").alias("__income"))
    merged = full_outer_role_merge(buy, sell, ["club_key", "season_key"], {})
    merged = merged.join(_clubs(spark, sf_dir), "club_key") \
        .join(_seasons(spark, seasons).select("season_key", "season_label"), "season_key")
    spent = F.coalesce(_mil("__spent"), F.lit(0.0))
    income = F.coalesce(_mil("__income"), F.lit(0.0))
    prem = F.coalesce(_mil("__prem"), F.lit(0.0))
    out = merged.select(
        "season_label", "club_name", F.coalesce("bought_count", F.lit(0)).alias("bought_count"),
        spent.alias("spent_mil_eur"), F.coalesce("sold_count", F.lit(0)).alias("sold_count"),
        income.alias("income_mil_eur"), (spent - income).alias("net_spend_mil_eur"),
        prem.alias("fee_premium_paid_mil_eur"), X.strategy_label(prem).alias("strategy_label"))
    return W.top_n(out, n, [F.desc("net_spend_mil_eur"), F.asc("season_label"), F.asc("club_name")])


def bq_fee_matrix_cube(spark: SparkSession, sf_dir: str, seasons: Sequence[str] = SEASONS_2) -> DataFrame:
    """CUBE(season, fee status, fee band) minus the (band without status) sets; share of the
    season total. The fact is first summed per (season, transfer type): the cube's Expand
    then runs on at most seasons × 7 rows."""
    ft = _transfers(spark, sf_dir, seasons)
    per = ft.groupBy("season_key", "transfer_type_key").agg(
        A.count_rows().alias("n"), F.sum(F.coalesce("transfer_fee_eur", F.lit(0))).alias("fee"))
    per = per.join(F.broadcast(star.dim_transfer_type(spark)), "transfer_type_key") \
        .join(_seasons(spark, seasons).select("season_key", "season_label"), "season_key")
    c = per.cube("season_label", "fee_status", "fee_band").agg(
        F.grouping_id().alias("grouping_level"), F.grouping("season_label").alias("g_s"),
        F.grouping("fee_status").alias("g_st"), F.grouping("fee_band").alias("g_b"),
        F.sum("n").alias("total_transactions"), F.sum("fee").alias("__fee"))
    c = c.filter(~((F.col("g_st") == 1) & (F.col("g_b") == 0)))
    season_total = F.sum(F.when((F.col("g_st") == 1) & (F.col("g_b") == 1), F.col("total_transactions"))) \
        .over(Window.partitionBy("g_s", "season_label"))
    return c.select(
        F.when(F.col("g_s") == 1, F.lit(fixed.CUBE_ALL_SEASONS)).otherwise(F.col("season_label")).alias("season_label"),
        F.when(F.col("g_st") == 1, F.lit(fixed.CUBE_ALL_STATUSES)).otherwise(F.col("fee_status")).alias("fee_status"),
        F.when(F.col("g_b") == 1, F.lit(fixed.CUBE_ALL_BANDS)).otherwise(F.col("fee_band")).alias("fee_band"),
        F.col("grouping_level").cast("int").alias("grouping_level"), "total_transactions",
        _mil("__fee").alias("total_fee_volume_mil_eur"),
        (A.ratio_of_sums(F.col("__fee"), F.col("total_transactions")) / F.lit(1_000_000.0)).alias("avg_fee_mil_eur"),
        A.ratio_of_sums(F.col("total_transactions"), season_total, 100.0).alias("season_share_pct"))


def bq_market_grouping_sets(spark: SparkSession, sf_dir: str, season: str = SEASON) -> DataFrame:
    """GROUPING SETS ((buyer confederation), (position), ()) with each set's share."""
    ft = _transfers(spark, sf_dir, [season])
    per = ft.groupBy("to_club_key", "player_key").agg(
        A.count_rows().alias("n"), F.count("transfer_fee_eur").alias("n_fee"), F.sum("transfer_fee_eur").alias("fee"))
    clubs = star.dim_club(spark, sf_dir).select(F.col("club_key").alias("to_club_key"), "confederation")
    per = per.join(clubs, "to_club_key").join(_players(spark, sf_dir, "position"), "player_key")
    g = A.grouping_sets(per, [["confederation"], ["position"], []], ["confederation", "position"], {
        "gid": F.grouping_id(), "g_conf": F.grouping("confederation"), "g_pos": F.grouping("position"),
        "deals": F.sum("n"), "deals_with_fee": F.sum("n_fee"), "__fee": F.sum("fee")})
    share = A.ratio_of_sums(F.col("__fee"), F.sum("__fee").over(Window.partitionBy("gid")), 100.0)
    return g.select(
        F.when(F.col("gid") == 1, F.lit(fixed.GSETS_BY_REGION)).when(F.col("gid") == 2, F.lit(fixed.GSETS_BY_POSITION))
        .when(F.col("gid") == 3, F.lit(fixed.GSETS_TOTAL)).alias("grouping_set"),
        F.when(F.col("g_conf") == 1, F.lit(fixed.GSETS_ALL)).otherwise(F.col("confederation")).alias("buyer_region"),
        F.when(F.col("g_pos") == 1, F.lit(fixed.GSETS_ALL)).otherwise(F.col("position")).alias("position"),
        "deals", "deals_with_fee", _mil("__fee").alias("total_fee_mil_eur"), share.alias("share_in_set_pct"))


def _net_spend_by_club(spark: SparkSession, sf_dir: str, season: str) -> DataFrame:
    """Buy and sell sums per club for one season, clubs > 0 with any money moved."""
    from kickstar.operators.joins import full_outer_role_merge
    ft = _transfers(spark, sf_dir, [season])
    buy = ft.groupBy(F.col("to_club_key").alias("club_key")).agg(F.sum("transfer_fee_eur").alias("spent"))
    sell = ft.groupBy(F.col("from_club_key").alias("club_key")).agg(F.sum("transfer_fee_eur").alias("income"))
    m = full_outer_role_merge(buy, sell, ["club_key"], {})
    m = m.select("club_key", F.coalesce("spent", F.lit(0)).alias("spent"), F.coalesce("income", F.lit(0)).alias("income"))
    m = m.filter((F.col("club_key") > 0) & ((F.col("spent") > 0) | (F.col("income") > 0)))
    return m.withColumn("net", F.col("spent") - F.col("income"))


def bq_spend_quartiles(spark: SparkSession, sf_dir: str, season: str = SEASON, n: int = 10) -> DataFrame:
    """Top clubs by net spend with RANK, NTILE(4) group and the number of clubs considered.

    The top rows come from a distributed TakeOrdered; their rank and NTILE group are
    computed from their position and the total count (no global window)."""
    m = _net_spend_by_club(spark, sf_dir, season).join(_clubs(spark, sf_dir), "club_key")
    total = m.agg(A.count_rows().alias("clubs_considered"))
    top = W.top_n_ranked(m, n, [F.desc("net"), F.asc("club_key")], [F.desc("net")], "rank", position="__pos")
    top = top.crossJoin(F.broadcast(total))
    return top.select("rank", W.ntile_of_position(F.col("__pos"), F.col("clubs_considered"), 4).alias("spend_group"),
                      "club_name", _mil("spent").alias("spent_mil_eur"), _mil("income").alias("income_mil_eur"),
                      _mil("net").alias("net_spend_mil_eur"), "clubs_considered")


def bq_quartile_summary(spark: SparkSession, sf_dir: str, season: str = SEASON) -> DataFrame:
    """Per NTILE(4) spend group: clubs, net spend and share of all buying."""
    m = _net_spend_by_club(spark, sf_dir, season)
    q = W.with_ntile(m, [F.desc("net"), F.asc("club_key")], 4, "spend_group")
    g = q.groupBy("spend_group").agg(A.count_rows().alias("clubs"), F.sum("net").alias("__net"),
                                     F.sum("spent").alias("__spent"))
    g = W.share_of_partition(g, "__spent", [], "spent_share_pct")
    return g.select("spend_group", "clubs", _mil("__net").alias("net_spend_mil_eur"), "spent_share_pct")


def _valuations_in_year(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    return star.player_valuation(spark, sf_dir).filter(
        F.col("date_key").between(year * 10000 + 101, year * 10000 + 1231))


def m1_squad_value(spark: SparkSession, sf_dir: str, year: int = VALUE_YEAR, n: int = 5) -> DataFrame:
    """Squad value in a year: per (club, player) the last valuation, summed per club."""
    fv = _valuations_in_year(spark, sf_dir, year)
    sv = A.squad_value(fv, ["club_key"], "player_key", "date_key", "market_value_eur", "squad_value")
    sv = sv.join(_clubs(spark, sf_dir), "club_key")
    return W.top_n(sv.select("club_key", "club_name", "squad_value"), n,
                   [F.desc_nulls_last("squad_value"), F.asc("club_key")])


def m2_value_gain(spark: SparkSession, sf_dir: str, year: int = VALUE_YEAR, n: int = 5) -> DataFrame:
    fv = _valuations_in_year(spark, sf_dir, year)
    g = fv.groupBy("player_key").agg(F.sum("value_change_eur").alias("value_gain"))
    g = g.join(_players(spark, sf_dir, "full_name"), "player_key")
    return W.top_n(g.select("player_key", "full_name", "value_gain"), n,
                   [F.desc_nulls_last("value_gain"), F.asc("player_key")])


def m3_peak_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average value per position × age group."""
    fv = star.player_valuation(spark, sf_dir)
    label, _ = X.age_group6(F.col("age_at_valuation"))
    per = fv.join(_players(spark, sf_dir, "position"), "player_key")
    return per.groupBy("position", label.alias("age_group")).agg(F.avg(_dbl("market_value_eur")).alias("avg_value"))


def m3_position_avg_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    fv = star.player_valuation(spark, sf_dir)
    per = fv.groupBy("player_key").agg(F.sum("age_at_valuation").alias("s"), F.count("age_at_valuation").alias("c"))
    per = per.join(_players(spark, sf_dir, "position"), "player_key")
    g = per.groupBy("position").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
    return g.select("position", A.ratio_of_sums(F.col("s"), F.col("c")).alias("avg_age_at_valuation"))


def m4_net_spend(spark: SparkSession, sf_dir: str, season: str = SEASON, n: int = 5) -> DataFrame:
    """Spend, income and net per club where a deal matches a club in either role.

    The ``club IN (to, from)`` join is rewritten as a role unpivot + equi-join; a deal
    with to = from credits the club once as buyer and once as seller."""
    from kickstar.operators.joins import unpivot_roles
    ft = _transfers(spark, sf_dir, [season]).withColumn("fee0", F.coalesce("transfer_fee_eur", F.lit(0)))
    roles = unpivot_roles(ft, {"to": "to_club_key", "from": "from_club_key"}, ["fee0"])
    per = roles.groupBy("club_key").agg(A.conditional_sum(F.col("role") == "to", F.col("fee0")).alias("spend"),
                                        A.conditional_sum(F.col("role") == "from", F.col("fee0")).alias("income"))
    per = per.join(_clubs(spark, sf_dir), "club_key")
    out = per.select("club_key", "club_name", "spend", "income", (F.col("spend") - F.col("income")).alias("net_spend"))
    return W.top_n(out, n, [F.desc("net_spend"), F.asc("club_key")])


def m5_premium(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    ft = star.transfer(spark, sf_dir)
    per = ft.groupBy("to_club_key").agg(F.sum("transfer_fee_eur").alias("sf"), F.count("transfer_fee_eur").alias("cf"),
                                        F.sum("fee_premium_eur").alias("sp"), F.count("fee_premium_eur").alias("cp"))
    per = per.join(_clubs(spark, sf_dir).withColumnRenamed("club_key", "to_club_key"), "to_club_key")
    out = per.select(F.col("to_club_key").alias("club_key"), "club_name",
                     A.ratio_of_sums(F.col("sf"), F.col("cf")).alias("avg_fee"),
                     A.ratio_of_sums(F.col("sp"), F.col("cp")).alias("avg_premium"),
                     F.col("cp").alias("deals_with_premium"))
    return W.top_n(out, n, [F.desc("deals_with_premium"), F.asc("club_key")])


def m6_free_youth_rates(spark: SparkSession, sf_dir: str, seasons: Sequence[str] = SEASONS_3) -> DataFrame:
    ft = _transfers(spark, sf_dir, seasons)
    y = F.col("is_youth_transfer")
    per = ft.groupBy("season_key").agg(
        A.count_rows().alias("deals"), A.conditional_sum(F.col("transfer_type_key") == 2).alias("free"),
        A.conditional_sum(y == 1).alias("youth"), A.conditional_sum(y.isNotNull()).alias("known"),
        F.sum(F.when(y == 0, F.col("age_at_transfer"))).alias("pro_age"),
        F.count(F.when(y == 0, F.col("age_at_transfer"))).alias("pro_n"))
    per = per.join(_seasons(spark, seasons).select("season_key", "season_label"), "season_key")
    return per.select("season_label", "deals", A.ratio_of_sums(F.col("free"), F.col("deals")).alias("free_rate"),
                      A.ratio_of_sums(F.col("youth"), F.col("known")).alias("youth_rate"),
                      A.ratio_of_sums(F.col("pro_age"), F.col("pro_n")).alias("pro_avg_age"))


# ------------------------------------------------------------------ cube questions, KPIs (C1-C3, PBI, KPIs)

def _tm_dims(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str]]:
    return {
        "competition": (star.dim_competition(spark, sf_dir)
                        .select("competition_key", "competition_name", "confederation", "country_name"),
                        "competition_key"),
        "season": (F.broadcast(star.dim_season(spark).select("season_key", "season_label")), "season_key"),
        "club": (_clubs(spark, sf_dir), "club_key"),
        "manager": (star.dim_manager(spark, sf_dir), "manager_key"),
    }


def c_manager_win_rate50(spark: SparkSession, sf_dir: str, min_matches: int = 50) -> DataFrame:
    d = _tm_dims(spark, sf_dir)
    g = M.evaluate(star.team_match(spark, sf_dir, with_manager=True), ["manager_name"], ["m_matches", "win_rate"],
                   dims=[d["manager"]])
    g = g.filter(F.col("m_matches") >= min_matches)
    return g.select("manager_name", F.col("m_matches").alias("matches"), F.col("m_wins").alias("wins"), "win_rate")


def c_home_advantage_league(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _tm_dims(spark, sf_dir)
    g = M.evaluate(star.team_match(spark, sf_dir), ["competition_name"], ["home_win_rate", "away_win_rate"],
                   dims=[d["competition"]])
    return g.select("competition_name", F.col("m_home_matches").alias("home_matches"),
                    F.col("m_home_wins").alias("home_wins"), "home_win_rate", "away_win_rate")


def c_goals_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _tm_dims(spark, sf_dir)
    g = M.evaluate(star.team_match(spark, sf_dir), ["competition_name", "season_label"],
                   ["m_matches", "goals_per_match"], dims=[d["competition"], d["season"]])
    return g.select("competition_name", "season_label", F.col("m_matches").alias("team_matches"),
                    F.col("m_goals_for").alias("goals"), "goals_per_match")


def c_clean_sheets(spark: SparkSession, sf_dir: str, top: int = 3) -> DataFrame:
    """Clubs with the most clean sheets in each season (GENERATE(TOPCOUNT))."""
    from kickstar.plans import cube
    d = _tm_dims(spark, sf_dir)
    g = M.evaluate(star.team_match(spark, sf_dir), ["season_label", "club_key", "club_name"], ["m_clean_sheets"],
                   dims=[d["season"], d["club"]])
    r = cube.top_count_per_parent(g, ["season_label"], top, [F.desc("m_clean_sheets"), F.asc("club_key")])
    return r.select("season_label", "rank", "club_key", "club_name", F.col("m_clean_sheets").alias("clean_sheets"))


def c_squad_value_asof(spark: SparkSession, sf_dir: str, as_of: str = "2024-01-15") -> DataFrame:
    """Squad value as of a date: each player's last valuation on or before it, summed per club."""
    fv = star.player_valuation(spark, sf_dir).filter(F.col("valuation_date") <= F.to_date(F.lit(as_of)))
    sv = A.squad_value(fv, ["club_key"], "player_key", "valuation_date", "market_value_eur", "squad_value")
    return sv.join(_clubs(spark, sf_dir), "club_key").select("club_key", "club_name", "squad_value")


def c_market_value_last_non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The semi-additive market-value measure per club: values on the club's last date with data."""
    fv = star.player_valuation(spark, sf_dir)
    lne = A.last_non_empty(fv, ["club_key"], "valuation_date", "market_value_eur", "market_value")
    last = fv.groupBy("club_key").agg(F.max("valuation_date").alias("last_date"))
    return lne.join(last, "club_key").join(_clubs(spark, sf_dir), "club_key") \
        .select("club_key", "club_name", "last_date", "market_value")


def c_overview_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report cards: matches, appearances, deals, deals with a disclosed fee — one row."""
    from kickstar.operators.joins import one_row
    tm = star.team_match(spark, sf_dir).agg(F.count_distinct("match_key").alias("matches"))
    fa = star.player_appearance(spark, sf_dir).agg(F.sum("appearance_count").alias("appearances"))
    ft = star.transfer(spark, sf_dir).agg(A.count_rows().alias("deals"),
                                          F.count("transfer_fee_eur").alias("deals_with_fee"))
    return one_row(tm, fa, ft)


def c_matches_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _tm_dims(spark, sf_dir)
    g = star.team_match(spark, sf_dir).groupBy("season_key").agg(F.count_distinct("match_key").alias("matches"))
    return g.join(d["season"][0], "season_key").select("season_label", "matches")


def c_player_career_members(spark: SparkSession, sf_dir: str, player: str = CAREER_PLAYER) -> DataFrame:
    """The MDX form of the career view: PREVMEMBER / NEXTMEMBER / LASTPERIODS(3) / first:current
    walk the season *dimension*, so a gap season gives an empty neighbour."""
    from kickstar.plans import cube
    pl = star.dim_player(spark, sf_dir).filter(F.col("full_name") == player).select("player_key")
    fa = star.player_appearance(spark, sf_dir).join(pl, "player_key", "left_semi")
    per = fa.groupBy("season_key").agg(F.sum("goals").alias("goals"), F.sum("minutes_played").alias("minutes"))
    per = per.withColumn("__m", F.lit(1))
    n = cube.neighbours(per, ["__m"], "season_key", "goals", "goals_prev_member", "goals_next_member")
    n = cube.last_periods_avg(n, ["__m"], "season_key", "goals", 3, "goals_last3_avg")
    n = cube.cumulative_member(n, ["__m"], "season_key", "goals", "goals_cumulative")
    n = cube.share_of_all(n, "goals", "career_share")
    prev = F.col("goals_prev_member")
    growth = F.when(prev.isNull() | (prev == 0), F.lit(None).cast("double")) \
        .otherwise((_dbl("goals") - _dbl(prev)) / _dbl(prev))
    n = n.join(F.broadcast(star.dim_season(spark).select("season_key", "season_label")), "season_key")
    return n.select("season_label", "goals", "minutes", "goals_cumulative", "goals_last3_avg",
                    "goals_prev_member", "goals_next_member", growth.alias("growth"), "career_share")


def _kpi_table(df: DataFrame, kpi: str, members: list[str]) -> DataFrame:
    from kickstar.plans import kpi as K
    return K.evaluate_kpi(df, kpi, members)


def c_kpi_manager_win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _tm_dims(spark, sf_dir)
    g = M.evaluate(star.team_match(spark, sf_dir, with_manager=True), ["manager_name", "season_key"],
                   ["m_matches", "win_rate"], dims=[d["manager"]])
    return _kpi_table(g, "kpi_manager_win_rate", ["manager_name"]) \
        .select("manager_name", "season_key", F.col("m_matches").alias("matches"), "win_rate",
                "kpi_value", "kpi_goal", "kpi_status", "kpi_trend")


def c_kpi_striker_goals90(spark: SparkSession, sf_dir: str, position: str = "Attack") -> DataFrame:
    pl = star.dim_player(spark, sf_dir).filter(F.col("position") == position).select("player_key")
    fa = star.player_appearance(spark, sf_dir).join(pl, "player_key", "left_semi")
    g = M.evaluate(fa, ["player_key", "season_key"], ["goals_per_90"])
    return _kpi_table(g, "kpi_striker_goals90", ["player_key"]) \
        .select("player_key", "season_key", F.col("m_goals").alias("goals"), F.col("m_minutes").alias("minutes"),
                "kpi_value", "kpi_goal", "kpi_status", "kpi_trend")


def net_spend_by_club_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend (as buyer), income (LINKMEMBER: the same club as seller) and net per (club, season)."""
    from kickstar.plans import cube
    ft = star.transfer(spark, sf_dir)
    roles = cube.link_role(ft, {"to": "to_club_key", "from": "from_club_key"}, ["transfer_fee_eur", "season_key"])
    g = roles.groupBy("club_key", "season_key").agg(
        F.sum(F.when(F.col("role") == "to", F.col("transfer_fee_eur"))).alias("spend"),
        F.sum(F.when(F.col("role") == "from", F.col("transfer_fee_eur"))).alias("income"))
    return g.withColumn("net_spend", F.coalesce("spend", F.lit(0)) - F.coalesce("income", F.lit(0)))


def c_kpi_net_spend_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = net_spend_by_club_season(spark, sf_dir)
    return _kpi_table(g, "kpi_net_spend_budget", ["club_key"]) \
        .select("club_key", "season_key", "spend", "income", "net_spend", "kpi_value", "kpi_goal", "kpi_status",
                "kpi_trend")


def c_kpi_club_fair_play(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = M.evaluate(star.player_appearance(spark, sf_dir), ["club_key", "season_key"], ["cards_per_match"])
    return _kpi_table(g, "kpi_club_fair_play", ["club_key"]) \
        .select("club_key", "season_key", F.col("m_distinct_matches").alias("matches"), "cards_per_match",
                "kpi_value", "kpi_goal", "kpi_status", "kpi_trend")


def c_kpi_referee_strictness(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = star.dim_match(spark, sf_dir).select("match_key", "referee")
    g = M.evaluate(star.player_appearance(spark, sf_dir), ["referee", "season_key"], ["cards_per_match"],
                   dims=[(ref, "match_key")])
    return _kpi_table(g, "kpi_referee_strictness", ["referee"]) \
        .select("referee", "season_key", F.col("m_distinct_matches").alias("matches"), "cards_per_match",
                "kpi_value", "kpi_goal", "kpi_status", "kpi_trend")


# ------------------------------------------------------------------ cube layouts (pivot, hierarchy totals)

POSITION_MEMBERS = tuple(pos for _, pos in star.POSITIONS)


def p4_goals_by_position_pivot(spark: SparkSession, sf_dir: str, season: str = "1997/98",
                               competitions: Sequence[str] = FIVE_COMPETITIONS) -> DataFrame:
    """The cube layout of p4: competitions on rows, positions on columns (goals)."""
    from kickstar.plans import cube
    long = p4_goals_by_position(spark, sf_dir, season, competitions)
    return cube.cube_pivot(long, ["competition_name"], "position", POSITION_MEMBERS, "goals")


def cube_hierarchy_goals(spark: SparkSession, sf_dir: str, season: str = SEASON) -> DataFrame:
    """DESCENDANTS(All, competition, SELF_AND_BEFORE) on confederation → country →
    competition: every level with its subtotal, with the level depth (0 = All)."""
    from kickstar.plans import cube
    tm = star.team_match(spark, sf_dir, ship_range=star.season_span([season])) \
        .join(_seasons(spark, [season]).select("season_key"), "season_key", "left_semi")
    per = tm.groupBy("competition_key").agg(A.count_rows().alias("n"), F.sum("goals_for").alias("gf"))
    per = per.join(star.dim_competition(spark, sf_dir), "competition_key")
    h = cube.cube_hierarchy_totals(per, ["confederation", "country_name", "competition_name"],
                                   {"team_matches": F.sum("n"), "goals": F.sum("gf")})
    return h.select("confederation", "country_name", "competition_name", F.col("depth").cast("int").alias("depth"),
                    "team_matches", "goals",
                    A.ratio_of_sums(F.col("goals"), F.col("team_matches")).alias("goals_per_team_match"))
