"""Cube operators (the MDX constructs of the reports, re-aimed as DataFrame operators).

Inputs are "flat cubes": a fact already joined to the dimension attributes the
question needs, or the output of ``measures.evaluate``. Each operator is one or two
DataFrame steps; none materialises a member × member product.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kickstar.operators import keys as K
from kickstar.operators import windows as W
from kickstar.plans import measures as M


def cube_slice(df: DataFrame, **members) -> DataFrame:
    """WHERE (dim.member): fix one member per attribute."""
    cond = F.lit(True)
    for attr, value in members.items():
        cond = cond & (F.col(attr) == F.lit(value))
    return df.filter(cond)


def cube_dice(df: DataFrame, sets: Mapping[str, Sequence]) -> DataFrame:
    """Restrict several attributes to member sets."""
    cond = F.lit(True)
    for attr, values in sets.items():
        cond = cond & F.col(attr).isin(*values)
    return df.filter(cond)


def except_members(df: DataFrame, attr: str, values: Sequence) -> DataFrame:
    """EXCEPT(set, {members}); NULL members are kept (they are not in the list)."""
    return df.filter(~F.col(attr).isin(*values) | F.col(attr).isNull())


def filter_members(df: DataFrame, predicate: Column) -> DataFrame:
    """FILTER(set, measure condition) — applied after aggregation."""
    return df.filter(predicate)


def non_empty(df: DataFrame, measure: str) -> DataFrame:
    """NON EMPTY: drop members whose measure is empty (no fact rows)."""
    return df.filter(F.col(measure).isNotNull() & (F.col(measure) != 0))


def cube_drilldown(fact: DataFrame, parent_attr: str, parent_value, child_attr: str, measures: Sequence[str],
                   sort_measure: str, dims: Sequence[tuple[DataFrame, str]] = ()) -> DataFrame:
    """parent.CHILDREN ordered BDESC by a measure: slice the parent, evaluate at the child level."""
    if dims:
        dims = list(dims)
        d0, k0 = dims[0]
        dims[0] = (d0.filter(F.col(parent_attr) == parent_value), k0)
        out = M.evaluate(fact, [child_attr], measures, dims)
    else:
        out = M.evaluate(fact.filter(F.col(parent_attr) == parent_value), [child_attr], measures)
    return out.orderBy(F.desc_nulls_last(sort_measure), F.asc(child_attr))


def cube_hierarchy_totals(df: DataFrame, levels: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """DESCENDANTS(All, leaf, SELF_AND_BEFORE): every level with subtotals, parents first."""
    r = df.rollup(*levels).agg(F.grouping_id().alias("grouping_level"), *[c.alias(n) for n, c in aggs.items()])
    depth = sum((F.col("grouping_level").bitwiseAND(1 << i) == 0).cast("int") for i in range(len(levels)))
    return r.withColumn("depth", depth).orderBy(*[F.asc_nulls_first(c) for c in levels], "depth")


def cube_pivot(df: DataFrame, rows: Sequence[str], column_attr: str, members: Sequence, measure: str) -> DataFrame:
    """Swap an attribute onto the columns: one column per member (given, so no distinct pass)."""
    return df.groupBy(*rows).pivot(column_attr, list(members)).agg(F.sum(measure))


def top_count(df: DataFrame, n: int, measure: str, tie: Sequence[str]) -> DataFrame:
    """TOPCOUNT(set, n, measure) with a total tie-break."""
    return W.top_n(df, n, [F.desc_nulls_last(measure)] + [F.asc(c) for c in tie])


def top_count_per_parent(df: DataFrame, parent: Sequence[str], n: int, order: Sequence[Column | str],
                         name: str = "rank") -> DataFrame:
    """GENERATE(parents, TOPCOUNT(children, n, measure))."""
    return W.top_per_group(df, parent, order, n, name=name, kind="row_number")


def custom_group_member(df: DataFrame, bucket: Column, name: str) -> DataFrame:
    """AGGREGATE(FILTER(members, cond)) members: a derived bucket column to group by."""
    return df.withColumn(name, bucket)


def share_of_all(df: DataFrame, measure: str, name: str, partition: Sequence[str] = ()) -> DataFrame:
    """measure / (measure, [All]) — the total over the other members of the set."""
    return W.share_of_partition(df, measure, list(partition), name, scale=1.0)


def neighbours(df: DataFrame, member_keys: Sequence[str], period: str, measure: str,
               prev_name: str = "prev", next_name: str = "next") -> DataFrame:
    """PREVMEMBER / NEXTMEMBER: the value at period ± 1 of the *dimension*, not the previous
    row with data — equi-joins on (member, period ± 1), so a gap season yields NULL."""
    base = df.select(*member_keys, period, measure)
    prev = base.select(*member_keys, (F.col(period) + 1).alias(period), F.col(measure).alias(prev_name))
    nxt = base.select(*member_keys, (F.col(period) - 1).alias(period), F.col(measure).alias(next_name))
    keys = list(member_keys) + [period]
    return df.join(prev, keys, "left").join(nxt, keys, "left")


def last_periods_avg(df: DataFrame, member_keys: Sequence[str], period: str, measure: str, n: int,
                     name: str) -> DataFrame:
    """AVG(LASTPERIODS(n, current), measure): average over periods current-n+1 … current of the
    dimension, ignoring empty cells (a gap season uses up one of the n periods)."""
    base = df.select(*member_keys, period, F.col(measure).alias("__v"))
    shifted = base.select(*member_keys, F.explode(F.sequence(F.col(period), F.col(period) + (n - 1))).alias(period),
                          "__v")
    avg = shifted.groupBy(*member_keys, period).agg(F.avg(F.col("__v").cast("double")).alias(name))
    return df.join(avg, list(member_keys) + [period], "left")


def cumulative_member(df: DataFrame, member_keys: Sequence[str], period: str, measure: str, name: str) -> DataFrame:
    """SUM({first : current}, measure) along the period of each member."""
    return W.running(df, member_keys, [period], measure, name)


def rank_in_set(df: DataFrame, measure: str, name_rank: str, name_position: str, tie: Sequence[str]) -> DataFrame:
    """RANK(member, set, measure) (ties share) and RANK(member, set) (position) over a set
    of any size: distributed rank and two-pass positions, no single-partition window."""
    ranked = K.global_rank(df, [measure], name_rank, ascending=[False])
    return K.global_positions(ranked, [F.desc(measure), *[F.asc(c) for c in tie]], name_position)


def link_role(fact: DataFrame, roles: Mapping[str, str], values: Sequence[str], key_name: str = "club_key") -> DataFrame:
    """LINKMEMBER: read the same member in another role — unpivot the role keys once."""
    from kickstar.operators.joins import unpivot_roles
    return unpivot_roles(fact, dict(roles), values, key_name=key_name)


def evaluate_sets(fact: DataFrame, dim: DataFrame, key: str, sets: Mapping[str, Column], measures: Sequence[str]) -> DataFrame:
    """Additive measures of several member sets, which may overlap: (member_set, measures).

    Each member gets a bit mask of the sets it is in; the fact is aggregated once, by member, and
    every set sums the members that have its bit. (EXISTING scopes and custom group members.)"""
    if len(sets) > 62:
        raise ValueError("a mask holds 62 sets")
    mask = F.lit(0).cast("long")
    for i, condition in enumerate(sets.values()):
        mask = mask + F.when(condition, F.lit(1 << i)).otherwise(F.lit(0))
    members = dim.select(key, mask.alias("__mask"))
    per_member = M.evaluate(fact, [key], measures).join(members, key)
    names = M.needed_bases(measures)
    sums = [F.sum(F.when(F.col("__mask").bitwiseAND(1 << i) != 0, F.col(n))).alias(f"s{i}_{n}") for i in range(len(sets)) for n in names]
    structs = [F.struct(F.lit(name).alias("member_set"), *[F.col(f"s{i}_{n}").alias(n) for n in names]) for i, name in enumerate(sets)]
    return per_member.agg(*sums).select(F.explode(F.array(*structs)).alias("__s")).select("__s.*")
