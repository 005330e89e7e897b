"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Names are the SURVEY §2 ids with the ``q_`` prefix. Only the queries listed here are
claimed; each reads the driver tables through ``kickstar.plans.star`` (or the
staging/warehouse plans derived from them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kickstar.plans import checks as C
from kickstar.plans import cube_queries as CQ
from kickstar.plans import dim_loads as D
from kickstar.plans import questions as Q
from kickstar.plans import staged as S
from kickstar.plans import store_queries as M
from kickstar.session import configure, size_shuffles
from kickstar.sources.driver import input_bytes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "q_t1_league_table": Q.t1_league_table,
    "q_t2_most_wins": Q.t2_most_wins,
    "q_t3_best_attack": Q.t3_best_attack,
    "q_t4_best_defence": Q.t4_best_defence,
    "q_t5_home_away_split": Q.t5_home_away_split,
    "q_t6_season_form": Q.t6_season_form,
    "q_t7_club_managers": Q.t7_club_managers,
    "q_t8_vs_strong_opponents": Q.t8_vs_strong_opponents,
    "q_bq_home_advantage": Q.bq_home_advantage,
    "q_bq_manager_ppm": Q.bq_manager_ppm,
    "q_bq_goals_rollup": Q.bq_goals_rollup,
    "q_bq_mv_standings": Q.bq_mv_standings,
    "q_bq_mv_season_rates": Q.bq_mv_season_rates,
    "q_bq_top_scorers": Q.bq_top_scorers,
    "q_p1_scorers": Q.p1_scorers,
    "q_p2_striker_efficiency": Q.p2_striker_efficiency,
    "q_p3_most_used": Q.p3_most_used,
    "q_p4_goals_by_position": Q.p4_goals_by_position,
    "q_p4_goals_by_position_pivot": Q.p4_goals_by_position_pivot,
    "q_cube_hierarchy_totals": Q.cube_hierarchy_goals,
    "q_p5_strict_referees": Q.p5_strict_referees,
    "q_p6_young_minutes": Q.p6_young_minutes,
    "q_bq_strict_referees": Q.bq_strict_referees,
    "q_bq_cards_by_position": Q.bq_cards_by_position,
    "q_bq_fair_play": Q.bq_fair_play,
    "q_bq_player_career": Q.bq_player_career,
    "q_d4_goals_per_card": Q.d4_goals_per_card,
    "q_d5_cards_drilldown": Q.d5_cards_drilldown,
    "q_d6_cards_by_round_type": Q.d6_cards_by_round_type,
    "q_d7_minutes_per_yellow": Q.d7_minutes_per_yellow,
    "q_d8_red_rate_referees": Q.d8_red_rate_referees,
    "q_bq_value_by_age": Q.bq_value_by_age,
    "q_bq_net_spend_premium": Q.bq_net_spend_premium,
    "q_bq_fee_matrix_cube": Q.bq_fee_matrix_cube,
    "q_bq_market_grouping_sets": Q.bq_market_grouping_sets,
    "q_bq_spend_quartiles": Q.bq_spend_quartiles,
    "q_bq_quartile_summary": Q.bq_quartile_summary,
    "q_m1_squad_value": Q.m1_squad_value,
    "q_m2_value_gain": Q.m2_value_gain,
    "q_m3_peak_age": Q.m3_peak_age,
    "q_m3_position_avg_age": Q.m3_position_avg_age,
    "q_m4_net_spend": Q.m4_net_spend,
    "q_m5_premium": Q.m5_premium,
    "q_m6_free_youth_rates": Q.m6_free_youth_rates,
    "q_c_manager_win_rate50": Q.c_manager_win_rate50,
    "q_c_home_advantage_league": Q.c_home_advantage_league,
    "q_c_goals_trend": Q.c_goals_trend,
    "q_c_clean_sheets": Q.c_clean_sheets,
    "q_c_squad_value_asof": Q.c_squad_value_asof,
    "q_c_market_value_last_non_empty": Q.c_market_value_last_non_empty,
    "q_c_overview_cards": Q.c_overview_cards,
    "q_c_matches_by_season": Q.c_matches_by_season,
    "q_c_player_career_members": Q.c_player_career_members,
    "q_c_kpi_manager_win_rate": Q.c_kpi_manager_win_rate,
    "q_c_kpi_striker_goals90": Q.c_kpi_striker_goals90,
    "q_c_kpi_net_spend_budget": Q.c_kpi_net_spend_budget,
    "q_c_kpi_club_fair_play": Q.c_kpi_club_fair_play,
    "q_c_kpi_referee_strictness": Q.c_kpi_referee_strictness,
    "q_dq_row_counts": C.dq_row_counts,
    "q_dq_window_max": C.dq_window_max,
    "q_dq_batch_delta": C.dq_batch_delta,
    "q_dq_integrity": C.dq_integrity,
    "q_dq_formula": C.dq_formula,
    "q_dq_domain": C.dq_domain,
    "q_dq_segment_profile": C.dq_segment_profile,
    "q_dq_league_table": C.dq_league_table,
    "q_dq_top_scorers": C.dq_top_scorers,
    "q_dq_reject_summary": S.dq_reject_summary,
    "q_gen_dim_date": C.gen_dim_date_span,
    "q_gen_dim_age": C.gen_dim_age,
    "q_surrogate_key": C.surrogate_key_players,
    "q_load_fact_player_valuation": S.load_fact_player_valuation,
    "q_load_fact_transfer": S.load_fact_transfer,
    "q_load_fact_team_match": S.load_fact_team_match,
    "q_load_fact_player_appearance": S.load_fact_player_appearance,
    "q_scd_merge_club": S.scd_merge_club,
    "q_asof_version_join": S.asof_club_version,
    "q_load_dim_competition": D.load_dim_competition,
    "q_load_dim_match": D.load_dim_match,
    "q_load_dim_player": D.load_dim_player,
    "q_load_dim_manager": D.load_dim_manager,
    "q_inferred_clubs": D.inferred_clubs,
    "q_load_fact_transfer_rerun": D.load_fact_transfer_rerun,
    "q_load_transfer_rejects": D.transfer_rejects,
    "q_standing_rollup_maintenance": D.standing_rollup_maintenance,
    "q_load_csv_team_match": S.csv_team_match,
    "q_load_fact_team_match_rerun": M.load_fact_team_match_rerun,
    "q_load_fact_player_appearance_rerun": M.load_fact_player_appearance_rerun,
    "q_mv_read": M.mv_read,
    "q_mv_reaggregate": M.mv_reaggregate,
    "q_scd_merge_club_buckets": M.scd_merge_club_buckets,
    "q_scd2_init_prototype": M.scd2_init,
    "q_measures_valuation": CQ.measures_valuation,
    "q_measures_transfer": CQ.measures_transfer,
    "q_measures_performance": CQ.measures_performance,
    "q_cube_slice_dice": CQ.slice_dice,
    "q_existing_scope_sets": CQ.overlapping_sets,
}


def _configured(fn: Query) -> Query:
    """Fill unset session settings (AQE, skew joins, checkpoint folder, shuffles by the size of
    the input) before planning."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        size_shuffles(spark, input_bytes(spark, sf_dir))
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    return {k: _configured(v) for k, v in QUERIES.items()}
