"""KPIs: (value, goal, status ∈ {1, 0, -1}, trend ∈ {1, 0, -1}).

Status cuts follow the cube definitions; an empty value compares as 0 (MDX empty
cell semantics). Trend compares with the previous *season member* (season_key - 1,
an equi-join, so a gap season gives 0) and is 0 when the previous value is empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickstar import fixed


@dataclass(frozen=True)
class Kpi:
    name: str
    value: str                # column holding the KPI value
    goal: float
    status_hi: float          # cut for status 1
    status_mid: float         # cut for status 0
    higher_is_better: bool    # direction of the status cuts
    trend_up_is_good: bool    # +1 when the value rises (False: +1 when it falls)


KPIS = {k.name: k for k in [
    Kpi("kpi_manager_win_rate", "win_rate", 0.5, 0.5, 0.4, True, True),
    Kpi("kpi_striker_goals90", "goals_per_90", 0.5, 0.5, 0.3, True, True),
    Kpi("kpi_net_spend_budget", "net_spend", float(fixed.BUDGET_EUR), float(fixed.BUDGET_EUR),
        1.5 * fixed.BUDGET_EUR, False, True),
    Kpi("kpi_club_fair_play", "cards_per_match", 3.0, 3.0, 4.0, False, False),
    Kpi("kpi_referee_strictness", "cards_per_match", 4.0, 5.0, 3.5, True, True),
]}


def status(k: Kpi, value: Column) -> Column:
    v = F.coalesce(value.cast("double"), F.lit(0.0))
    if k.higher_is_better:
        return F.when(v >= k.status_hi, 1).when(v >= k.status_mid, 0).otherwise(-1)
    return F.when(v <= k.status_hi, 1).when(v <= k.status_mid, 0).otherwise(-1)


def trend(k: Kpi, value: Column, prev: Column) -> Column:
    v = F.coalesce(value.cast("double"), F.lit(0.0))
    p = prev.cast("double")
    up, down = (1, -1) if k.trend_up_is_good else (-1, 1)
    return F.when(p.isNull(), 0).when(v > p, up).when(v < p, down).otherwise(0)


def evaluate_kpi(df: DataFrame, kpi_name: str, member_keys: list[str], season: str = "season_key") -> DataFrame:
    """Add kpi_value, kpi_goal, kpi_status, kpi_trend to a (member, season) measure table."""
    k = KPIS[kpi_name]
    prev = df.select(*member_keys, (F.col(season) + 1).alias(season), F.col(k.value).alias("__prev"))
    out = df.join(prev, member_keys + [season], "left")
    return out.select(
        *df.columns,
        F.col(k.value).alias("kpi_value"),
        F.lit(k.goal).alias("kpi_goal"),
        status(k, F.col(k.value)).alias("kpi_status"),
        trend(k, F.col(k.value), F.col("__prev")).alias("kpi_trend"),
    )
