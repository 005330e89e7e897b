"""Measure registry: base measures, calculated members and the plan that evaluates them.

A *base measure* is an aggregate over one fact column (sum, count, distinct count).
A *calculated member* is arithmetic on base measures at the asked level, with a
NULL guard on every division (IIF(den = 0 OR ISEMPTY(den), NULL, …)). Ratios are
always recomputed from the stored sums, never averaged.

``evaluate`` compiles (fact, dimension joins, level, measures) to one plan:

1. group the fact by the dimension keys the level needs (plus the distinct-count
   columns, de-duplicated here) — partial aggregation, before any dimension join;
2. join those (much smaller) rows to the dimensions;
3. group by the level attributes: additive measures re-sum, distinct counts count
   the pre-deduplicated values;
4. add the calculated members.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Base:
    name: str
    kind: str            # "sum" | "count" | "distinct"
    column: str | None = None
    expr: Callable[[], Column] | None = None   # row-level expression summed instead of a column

    def row_value(self) -> Column:
        if self.expr is not None:
            return self.expr()
        return F.col(self.column) if self.column else F.lit(1)


@dataclass(frozen=True)
class Calc:
    name: str
    needs: tuple[str, ...]
    fn: Callable[..., Column] = field(compare=False)


def div(num: Column, den: Column, scale: float = 1.0) -> Column:
    """IIF(den = 0 OR ISEMPTY(den), NULL, num / den) as a double."""
    n = num.cast("double") * F.lit(float(scale)) if scale != 1.0 else num.cast("double")
    return F.try_divide(n, den.cast("double"))


def _b(name, kind, column=None, expr=None) -> Base:
    return Base(name, kind, column, expr)


BASES: dict[str, Base] = {b.name: b for b in [
    # team performance
    _b("m_matches", "count"),
    _b("m_goals_for", "sum", "goals_for"),
    _b("m_goals_against", "sum", "goals_against"),
    _b("m_goal_diff", "sum", "goal_difference"),
    _b("m_wins", "sum", "is_win"),
    _b("m_draws", "sum", "is_draw"),
    _b("m_losses", "sum", "is_loss"),
    _b("m_clean_sheets", "sum", "is_clean_sheet"),
    _b("m_points", "sum", "points"),
    _b("m_home_matches", "sum", "is_home"),
    _b("m_home_wins", "sum", expr=lambda: F.col("is_win") * F.col("is_home")),
    # player performance / discipline
    _b("m_minutes", "sum", "minutes_played"),
    _b("m_goals", "sum", "goals"),
    _b("m_assists", "sum", "assists"),
    _b("m_yellow", "sum", "yellow_cards"),
    _b("m_red", "sum", "red_cards"),
    _b("m_appearances", "sum", "appearance_count"),
    _b("m_distinct_matches", "distinct", "match_key"),
    _b("m_distinct_players", "distinct", "player_key"),
    # valuation
    _b("m_total_value", "sum", "market_value_eur"),
    _b("m_value_change", "sum", "value_change_eur"),
    _b("m_age_sum", "sum", "age_at_valuation"),
    _b("m_has_age", "sum", expr=lambda: F.when(F.col("age_at_valuation").isNotNull(), 1).otherwise(0)),
    _b("m_valuations", "sum", "valuation_count"),
    # transfer
    _b("m_fee", "sum", "transfer_fee_eur"),
    _b("m_fee_disclosed", "sum", expr=lambda: F.when(F.col("transfer_fee_eur").isNotNull(), 1).otherwise(0)),
    _b("m_value_at_transfer", "sum", "market_value_eur"),
    _b("m_premium", "sum", "fee_premium_eur"),
    _b("m_has_premium", "sum", expr=lambda: F.when(F.col("fee_premium_eur").isNotNull(), 1).otherwise(0)),
    _b("m_deals", "sum", "transfer_count"),
    _b("m_free_deals", "sum", expr=lambda: F.when(F.col("transfer_fee_eur") == 0, 1).otherwise(0)),
    _b("m_youth_deals", "sum", expr=lambda: F.coalesce(F.col("is_youth_transfer"), F.lit(0))),
    _b("m_pro_age_sum", "sum",
       expr=lambda: F.when(F.col("is_youth_transfer") == 0, F.col("age_at_transfer")).otherwise(0)),
    _b("m_pro_deals", "sum", expr=lambda: F.when(F.col("is_youth_transfer") == 0, 1).otherwise(0)),
]}


def _c(name: str, needs: tuple[str, ...], fn: Callable[..., Column]) -> Calc:
    return Calc(name, needs, fn)


C = F.col
CALCS: dict[str, Calc] = {c.name: c for c in [
    _c("win_rate", ("m_wins", "m_matches"), lambda: div(C("m_wins"), C("m_matches"))),
    _c("goals_per_match", ("m_goals_for", "m_matches"), lambda: div(C("m_goals_for"), C("m_matches"))),
    _c("home_win_rate", ("m_home_wins", "m_home_matches"), lambda: div(C("m_home_wins"), C("m_home_matches"))),
    _c("points_per_match", ("m_points", "m_matches"), lambda: div(C("m_points"), C("m_matches"))),
    _c("away_win_rate", ("m_wins", "m_home_wins", "m_matches", "m_home_matches"),
       lambda: div(C("m_wins") - C("m_home_wins"), C("m_matches") - C("m_home_matches"))),
    _c("goals_per_90", ("m_goals", "m_minutes"), lambda: div(C("m_goals"), C("m_minutes"), 90.0)),
    _c("goals_assists_per_90", ("m_goals", "m_assists", "m_minutes"),
       lambda: div(C("m_goals") + C("m_assists"), C("m_minutes"), 90.0)),
    _c("minutes_per_goal", ("m_minutes", "m_goals"), lambda: div(C("m_minutes"), C("m_goals"))),
    _c("goal_contributions", ("m_goals", "m_assists"), lambda: C("m_goals") + C("m_assists")),
    _c("total_cards", ("m_yellow", "m_red"), lambda: C("m_yellow") + C("m_red")),
    _c("fair_play_points", ("m_yellow", "m_red"), lambda: C("m_yellow") + C("m_red") * 3),
    _c("cards_per_match", ("m_yellow", "m_red", "m_distinct_matches"),
       lambda: div(C("m_yellow") + C("m_red"), C("m_distinct_matches"))),
    _c("yellow_per_match", ("m_yellow", "m_distinct_matches"), lambda: div(C("m_yellow"), C("m_distinct_matches"))),
    _c("red_per_match", ("m_red", "m_distinct_matches"), lambda: div(C("m_red"), C("m_distinct_matches"))),
    _c("fair_play_per_match", ("m_yellow", "m_red", "m_distinct_matches"),
       lambda: div(C("m_yellow") + C("m_red") * 3, C("m_distinct_matches"))),
    _c("minutes_per_yellow", ("m_minutes", "m_yellow"), lambda: div(C("m_minutes"), C("m_yellow"))),
    _c("red_share", ("m_red", "m_yellow"), lambda: div(C("m_red"), C("m_yellow") + C("m_red"))),
    _c("goals_per_card", ("m_goals", "m_yellow", "m_red"), lambda: div(C("m_goals"), C("m_yellow") + C("m_red"))),
    _c("cards_per_player", ("m_yellow", "m_red", "m_distinct_players"),
       lambda: div(C("m_yellow") + C("m_red"), C("m_distinct_players"))),
    # valuation: NULL values add 0 to the sum but are counted (differs from SQL AVG)
    _c("avg_value", ("m_total_value", "m_valuations"), lambda: div(C("m_total_value"), C("m_valuations"))),
    _c("avg_age_at_valuation", ("m_age_sum", "m_has_age"), lambda: div(C("m_age_sum"), C("m_has_age"))),
    # transfer
    _c("fee_m", ("m_fee",), lambda: div(C("m_fee"), F.lit(1_000_000))),
    _c("avg_fee", ("m_fee", "m_fee_disclosed"), lambda: div(C("m_fee"), C("m_fee_disclosed"))),
    _c("avg_premium", ("m_premium", "m_has_premium"), lambda: div(C("m_premium"), C("m_has_premium"))),
    _c("free_rate", ("m_free_deals", "m_deals"), lambda: div(C("m_free_deals"), C("m_deals"))),
    _c("youth_rate", ("m_youth_deals", "m_pro_deals"),
       lambda: div(C("m_youth_deals"), C("m_youth_deals") + C("m_pro_deals"))),
    _c("avg_pro_age", ("m_pro_age_sum", "m_pro_deals"), lambda: div(C("m_pro_age_sum"), C("m_pro_deals"))),
]}


def base_aggregate(b: Base) -> Column:
    if b.kind == "count":
        return F.count(F.lit(1))
    if b.kind == "sum":
        return F.sum(b.row_value())
    raise ValueError(b.kind)


def needed_bases(measures: Sequence[str]) -> list[str]:
    out: list[str] = []
    for m in measures:
        for n in (CALCS[m].needs if m in CALCS else (m,)):
            if n not in BASES:
                raise KeyError(f"unknown measure {n}")
            if n not in out:
                out.append(n)
    return out


def evaluate(fact: DataFrame, level: Sequence[str], measures: Sequence[str],
             dims: Sequence[tuple[DataFrame, str]] = ()) -> DataFrame:
    """Measures at ``level`` (dimension attributes or fact columns)."""
    bases = [BASES[n] for n in needed_bases(measures)]
    additive = [b for b in bases if b.kind in ("sum", "count")]
    distinct = [b for b in bases if b.kind == "distinct"]
    dim_keys = [k for _, k in dims]
    fact_level = [c for c in level if c in fact.columns and c not in dim_keys]
    keys = list(dict.fromkeys(dim_keys + fact_level + [b.column for b in distinct]))
    # 1. pre-aggregate on keys (+ distinct columns) before any join
    pre = fact.groupBy(*keys).agg(*[base_aggregate(b).alias(b.name) for b in additive]) if additive \
        else fact.select(*keys).distinct()
    # 2. dimension attributes
    for dim, key in dims:
        wanted = [c for c in level if c in dim.columns and c != key]
        pre = pre.join(dim.select(key, *wanted), key)
    # 3. final level; with one distinct column and the level of the fact alone, step 1 left each value once
    once = len(distinct) == 1 and set(keys) == {*level, distinct[0].column}
    out = pre.groupBy(*level).agg(
        *[F.sum(b.name).alias(b.name) for b in additive],
        *[(F.count if once else F.count_distinct)(b.column).alias(b.name) for b in distinct])
    # 4. calculated members
    calcs = [CALCS[m] for m in measures if m in CALCS]
    if calcs:
        out = out.select("*", *[c.fn().alias(c.name) for c in calcs])
    return out
