"""Join operators: star joins, lookups, special-member keys, anti-joins, role unpivot, as-of.

Broadcast policy: ``bounded_broadcast`` is applied only to inputs whose row count is
fixed by definition (literal lookups, calendar dims, the 25-nation geography).
Everything else, members picked by name included, is left to the planner: Catalyst
broadcasts by size statistics under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans at runtime from the
real shuffle sizes, splitting skewed partitions of sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast hint for a side whose size is bounded by construction (not by data)."""
    return F.broadcast(df)


def star_join(fact: DataFrame, *dims: tuple[DataFrame, str | Sequence[str]], how: str = "inner") -> DataFrame:
    """fact ⋈ dim on the surrogate key(s) of each dim."""
    out = fact
    for dim, key in dims:
        out = out.join(dim, on=key if isinstance(key, str) else list(key), how=how)
    return out


def role_join(fact: DataFrame, dim: DataFrame, dim_key: str, role_key: str, prefix: str,
              columns: Iterable[str], how: str = "inner") -> DataFrame:
    """Join one role of a role-playing dimension; its columns get ``prefix``."""
    cols = [F.col(dim_key).alias(f"{prefix}__k")] + [F.col(c).alias(f"{prefix}{c}") for c in columns]
    role = dim.select(*cols)
    return fact.join(role, fact[role_key] == role[f"{prefix}__k"], how).drop(f"{prefix}__k")


def dedup_dim_on_key(dim: DataFrame, natural_key: str | Sequence[str], surrogate: str) -> DataFrame:
    """One row per natural key (highest surrogate), so a lookup can never fan out."""
    keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    return dim.groupBy(*keys).agg(F.max(surrogate).alias(surrogate))


def lookup_key(df: DataFrame, dim: DataFrame, left_on: str | Sequence[str], natural_key: str | Sequence[str],
               surrogate: str, out: str | None = None) -> DataFrame:
    """Left lookup natural key -> surrogate key; a miss leaves NULL."""
    lk = [left_on] if isinstance(left_on, str) else list(left_on)
    nk = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    ref = dedup_dim_on_key(dim, nk, surrogate)
    ref = ref.select(*[F.col(k).alias(f"__lk{i}") for i, k in enumerate(nk)], F.col(surrogate).alias(out or surrogate))
    cond = [df[a] == ref[f"__lk{i}"] for i, a in enumerate(lk)]
    joined = df.join(ref, cond, "left")
    return joined.drop(*[f"__lk{i}" for i in range(len(nk))])


def unknown_key(df: DataFrame, *keys: str, code: int = -1) -> DataFrame:
    """Unresolved surrogate keys -> the unknown member."""
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(code)) for k in keys})


def lookup_enrich(df: DataFrame, ref: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    return df.join(ref, on=on if isinstance(on, str) else list(on), how=how)


def lookup_match_split(df: DataFrame, dim: DataFrame, on: str | Sequence[str],
                       old_prefix: str = "old_") -> tuple[DataFrame, DataFrame]:
    """(rows whose key exists in ``dim`` with the old attribute values, rows that are new)."""
    keys = [on] if isinstance(on, str) else list(on)
    old_cols = [old_prefix + c for c in dim.columns if c not in keys]
    old = dim.select(*keys, *[F.col(c).alias(old_prefix + c) for c in dim.columns if c not in keys],
                     F.lit(True).alias("__hit"))
    joined = df.join(old, keys, "left")          # one join, split by two filters
    matched = joined.filter(F.col("__hit").isNotNull()).drop("__hit")
    new = joined.filter(F.col("__hit").isNull()).drop("__hit", *old_cols)
    return matched, new


def anti_join(df: DataFrame, existing: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``existing`` (NOT EXISTS)."""
    return df.join(existing, on=on if isinstance(on, str) else list(on), how="left_anti")


def semi_join(df: DataFrame, keep: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keep, on=on if isinstance(on, str) else list(on), how="left_semi")


def full_outer_role_merge(a: DataFrame, b: DataFrame, keys: Sequence[str], fill: dict[str, object]) -> DataFrame:
    """a ⟗ b on keys, COALESCE the keys, NULL measures -> the given defaults."""
    ra = a.select(*[F.col(k).alias(f"__a_{k}") for k in keys], *[c for c in a.columns if c not in keys])
    rb = b.select(*[F.col(k).alias(f"__b_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = [ra[f"__a_{k}"] == rb[f"__b_{k}"] for k in keys]
    j = ra.join(rb, cond, "full_outer")
    key_cols = [F.coalesce(F.col(f"__a_{k}"), F.col(f"__b_{k}")).alias(k) for k in keys]
    rest = [c for c in j.columns if not c.startswith("__a_") and not c.startswith("__b_")]
    out = j.select(*key_cols, *rest)
    return out.fillna(fill) if fill else out


def unpivot_roles(df: DataFrame, roles: dict[str, str], value_cols: Sequence[str],
                  key_name: str = "club_key", role_name: str = "role") -> DataFrame:
    """One row per (row, role): turns ``key IN (role_a, role_b)`` joins into an equi-join.

    A row whose role keys are equal still yields one row per role, so a club that
    both buys and sells in the same deal is credited once on each side.
    """
    structs = [F.struct(F.lit(role).alias(role_name), F.col(col).alias(key_name),
                        *[F.col(v).alias(v) for v in value_cols]) for role, col in roles.items()]
    return df.select(F.explode(F.array(*structs)).alias("__r")).select("__r.*")


def values_join(df: DataFrame, values: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join a literal lookup table (bounded: it is written in the code)."""
    return df.join(bounded_broadcast(values), on=on if isinstance(on, str) else list(on), how=how)


def one_row(*frames: DataFrame) -> DataFrame:
    """Place several one-row aggregates side by side (scalar sub-selects in one row)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.crossJoin(bounded_broadcast(f))
    return out


def version_segments(dim: DataFrame, natural_key: str, surrogate: str, valid_from: str = "effective_date",
                     valid_to: str = "expiry_date") -> DataFrame:
    """Non-overlapping validity segments per member with the winning version of each.

    Boundaries are every version start and every end + 1; between two boundaries a
    version either covers the whole segment or none of it. The winner of a segment is
    the covering version with the latest start (then the highest key). Work is bounded
    by the versions of one member, never by the fact."""
    open_end = F.to_date(F.lit("9999-12-31"))
    v = dim.select(F.col(natural_key).alias("__nk"), F.col(valid_from).alias("__vf"),
                   F.col(valid_to).alias("__vt"), F.col(surrogate).alias("__sk")).filter(F.col("__vf") <= F.col("__vt"))
    starts = v.select("__nk", F.col("__vf").alias("__b"))
    ends = v.filter(F.col("__vt") < open_end).select("__nk", F.date_add("__vt", 1).alias("__b"))
    w = Window.partitionBy("__nk").orderBy("__b")
    segs = starts.unionByName(ends).distinct().withColumn(
        "__e", F.coalesce(F.date_sub(F.lead("__b").over(w), 1), open_end))
    cover = segs.join(v, "__nk").filter((F.col("__vf") <= F.col("__b")) & (F.col("__vt") >= F.col("__e")))
    return cover.groupBy("__nk", "__b", "__e").agg(F.max_by("__sk", F.struct("__vf", "__sk")).alias("__win"))


def asof_version_join(df: DataFrame, dim: DataFrame, natural_key: str, event_date: str, surrogate: str,
                      valid_from: str = "effective_date", valid_to: str = "expiry_date",
                      out: str | None = None) -> DataFrame:
    """Attach the SCD2 version valid on the event date; a miss gets -1.

    One left join of the facts to the member's validity segments (equi-join on the
    natural key, the date range as a join condition — never a nested loop); overlapping
    versions were resolved on the dimension side, so each fact row matches at most one
    segment and no per-row regrouping of the fact is needed."""
    seg = version_segments(dim, natural_key, surrogate, valid_from, valid_to)
    cond = (df[natural_key] == seg["__nk"]) & df[event_date].between(seg["__b"], seg["__e"])
    name = out or surrogate
    return df.join(seg, cond, "left").withColumn(name, F.coalesce(F.col("__win"), F.lit(-1))) \
        .drop("__nk", "__b", "__e", "__win")


def key_filter(dim: DataFrame, condition: Column, key: str) -> DataFrame:
    """Keys of the dimension members that satisfy ``condition`` (for a semi-join on the fact)."""
    return dim.filter(condition).select(key).distinct()
