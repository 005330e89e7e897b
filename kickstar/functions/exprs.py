"""Column functions: cleaning, casting, bands, dates, outcomes, labels.

Every function maps Columns to a Column built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen. Thresholds come from ``kickstar.fixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kickstar import fixed

ColumnOrName = Column | str
NBSP = "\u00a0"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- cleaning (2.2)

def clean_text(c: ColumnOrName) -> Column:
    """NBSP -> space, trim, empty -> NULL."""
    return F.nullif(F.trim(F.replace(_c(c), F.lit(NBSP), F.lit(" "))), F.lit(""))


def clean_text_null_tokens(c: ColumnOrName) -> Column:
    """``clean_text`` plus the textual null tokens (nan/None/null/NULL) -> NULL."""
    t = clean_text(c)
    return F.when(t.isin(*fixed.NULL_TOKENS), F.lit(None).cast("string")).otherwise(t)


def clean_date_text(c: ColumnOrName) -> Column:
    """Trim, keep the first 10 characters (yyyy-MM-dd), empty -> NULL."""
    return F.nullif(F.substring(F.trim(_c(c)), 1, 10), F.lit(""))


def fold_ligatures(c: ColumnOrName) -> Column:
    out = _c(c)
    for src, dst in fixed.LIGATURES:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def sentinel_to_null(c: ColumnOrName, sentinels: Sequence[str] = ("-1",)) -> Column:
    t = clean_text(c)
    return F.when(t.isin(*sentinels), F.lit(None).cast("string")).otherwise(t)


def remap_club_code(c: ColumnOrName) -> Column:
    """Source club id -> id with special members: not-applicable clubs -> -2, unknown -> -1."""
    as_int = _c(c).try_cast("int")
    return (
        F.when(as_int.isin(*fixed.NOT_APPLICABLE_CLUB_IDS), F.lit("-2"))
        .when(as_int.isin(*fixed.UNKNOWN_CLUB_IDS), F.lit("-1"))
        .otherwise(_c(c).cast("string"))
    )


def blank_to_code(c: ColumnOrName, code: str = "-2") -> Column:
    """Blank (after NBSP removal) -> ``code``; e.g. a valuation without a domestic league."""
    t = F.nullif(F.trim(F.replace(_c(c), F.lit(NBSP), F.lit(""))), F.lit(""))
    return F.coalesce(t, F.lit(code))


def is_excluded_code(c: ColumnOrName) -> Column:
    """True for the remapped club ids (used to skip them when harvesting clubs)."""
    codes = fixed.NOT_APPLICABLE_CLUB_IDS + fixed.UNKNOWN_CLUB_IDS
    return F.coalesce(_c(c).try_cast("int"), F.lit(0)).isin(*codes)


def safe_numeric(c: ColumnOrName, dtype: str = "double") -> Column:
    return _c(c).try_cast(dtype)


def safe_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(clean_date_text(c), fmt) if fmt else clean_date_text(c).try_cast("date")


def default_label(c: ColumnOrName, label: str = fixed.UNKNOWN) -> Column:
    return F.coalesce(_c(c), F.lit(label))


def default_name(c: ColumnOrName, prefix: str, key: ColumnOrName) -> Column:
    """NULL name -> prefix + id (``"CLB 12"``, ``"Cầu thủ 7"``)."""
    return F.coalesce(_c(c), F.concat(F.lit(prefix), F.coalesce(_c(key).cast("string"), F.lit(""))))


def null_safe_changed(new: ColumnOrName, old: ColumnOrName) -> Column:
    """True when two values differ, treating NULL = NULL as equal."""
    return ~_c(new).eqNullSafe(_c(old))


# ---------------------------------------------------------------- bands (2.7)

def band(c: ColumnOrName, cuts: Sequence[float], labels: Sequence[str], *, upper_inclusive: bool = False,
         unknown: str = fixed.UNKNOWN, valid: Column | None = None) -> Column:
    """Bucket a numeric column: labels[i] when x < cuts[i] (or <= if upper_inclusive).

    ``len(labels) == len(cuts) + 1``; NULL (or ``valid`` false) -> ``unknown``.
    """
    x = _c(c)
    expr = None
    for cut, label in zip(cuts, labels):
        cond = x <= cut if upper_inclusive else x < cut
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.otherwise(F.lit(labels[-1]))
    guard = x.isNull() if valid is None else (x.isNull() | ~valid)
    return F.when(guard, F.lit(unknown)).otherwise(expr)


def stadium_band(seats: ColumnOrName) -> Column:
    x = _c(seats)
    return band(x, (20000, 40000, 60000), fixed.STADIUM_BANDS, valid=x > 0)


def attendance_band(att: ColumnOrName) -> Column:
    return band(att, (10000, 30000, 60000), fixed.ATTENDANCE_BANDS)


def height_band(cm: ColumnOrName) -> Column:
    x = _c(cm)
    return band(x, (170, 180, 190), fixed.HEIGHT_BANDS, valid=x.between(150, 220))


def caps_band(caps: ColumnOrName) -> Column:
    x = _c(caps)
    return F.when(x.isNull(), F.lit(fixed.UNKNOWN)).when(x == 0, F.lit(fixed.CAPS_BANDS[0])) \
        .when(x <= 10, F.lit(fixed.CAPS_BANDS[1])).when(x <= 50, F.lit(fixed.CAPS_BANDS[2])) \
        .otherwise(F.lit(fixed.CAPS_BANDS[3]))


def fee_status(fee: ColumnOrName) -> Column:
    x = _c(fee)
    return F.when(x.isNull(), F.lit(fixed.FEE_UNDISCLOSED)).when(x == 0, F.lit(fixed.FEE_FREE)) \
        .otherwise(F.lit(fixed.FEE_PAID))


def fee_band(fee: ColumnOrName) -> Column:
    x = _c(fee)
    b = fixed.FEE_BANDS
    return F.when(x.isNull() | (x == 0), F.lit(fixed.FEE_BAND_NA)).when(x < 1_000_000, F.lit(b[0])) \
        .when(x <= 10_000_000, F.lit(b[1])).when(x <= 50_000_000, F.lit(b[2])).otherwise(F.lit(b[3]))


def fee_band_order(band_col: ColumnOrName) -> Column:
    x = _c(band_col)
    out = F.when(x == fixed.FEE_BANDS[0], 1)
    for i, label in enumerate(fixed.FEE_BANDS[1:], start=2):
        out = out.when(x == label, i)
    return out.when(x == fixed.FEE_BAND_NA, 0).otherwise(9)


def transfer_type_key(fee: ColumnOrName) -> Column:
    """Key of the (fee_status, fee_band) junk dimension, computed from the fee itself."""
    x = _c(fee)
    return F.when(x.isNull(), 1).when(x == 0, 2).when(x < 1_000_000, 3).when(x <= 10_000_000, 4) \
        .when(x <= 50_000_000, 5).otherwise(6)


def fee_premium(fee: ColumnOrName, market_value: ColumnOrName) -> Column:
    return _c(fee) - _c(market_value)   # NULL if either side is NULL


def age_group6(age: ColumnOrName) -> tuple[Column, Column]:
    """(age_group, age_group_order); NULL or 0 age -> unknown (order 9)."""
    x = _c(age)
    labels = fixed.AGE_GROUPS
    label = F.when(x.isNull() | (x == 0), F.lit(fixed.UNKNOWN_SHORT)).when(x < 18, F.lit(labels[0][0])) \
        .when(x <= 21, F.lit(labels[1][0])).when(x <= 24, F.lit(labels[2][0])) \
        .when(x <= 28, F.lit(labels[3][0])).when(x <= 31, F.lit(labels[4][0])).otherwise(F.lit(labels[5][0]))
    order = F.when(x.isNull() | (x == 0), 9).when(x < 18, 1).when(x <= 21, 2).when(x <= 24, 3) \
        .when(x <= 28, 4).when(x <= 31, 5).otherwise(6)
    return label, order


def age_bracket4(age: ColumnOrName) -> Column:
    x = _c(age)
    b = fixed.AGE_BRACKETS
    return F.when(x < 21, F.lit(b[0])).when(x.between(21, 25), F.lit(b[1])) \
        .when(x.between(26, 29), F.lit(b[2])).when(x >= 30, F.lit(b[3])).otherwise(F.lit(fixed.UNKNOWN))


def round_type(rnd: ColumnOrName) -> Column:
    x = _c(rnd)
    return F.when(x.isNull(), F.lit(fixed.UNKNOWN)).when(F.instr(x, "Matchday") > 0, F.lit("Matchday")) \
        .when(F.instr(x, "Group") > 0, F.lit("Group stage")).when(x == "Final", F.lit("Final")) \
        .otherwise(F.lit("Knockout"))


def normalize_confederation(c: ColumnOrName) -> Column:
    up = F.upper(F.coalesce(_c(c), F.lit("")))
    out = None
    for target, aliases in fixed.CONFEDERATION_ALIASES:
        cond = up.isin(*aliases)
        out = F.when(cond, F.lit(target)) if out is None else out.when(cond, F.lit(target))
    return out.otherwise(F.lit(fixed.UNKNOWN))


def country_fallback(country_id: ColumnOrName, country_name: ColumnOrName, ref_name: ColumnOrName) -> Column:
    """International (-1) or missing country -> referenced name, else 'International'."""
    use_ref = (F.coalesce(_c(country_id), F.lit("")) == "-1") | _c(country_name).isNull()
    return F.when(use_ref, F.coalesce(F.trim(_c(ref_name)), F.lit(fixed.INTERNATIONAL))).otherwise(_c(country_name))


def strategy_label(premium_m: ColumnOrName) -> Column:
    x = F.coalesce(_c(premium_m), F.lit(0))
    return F.when(x > 20, F.lit(fixed.STRATEGY_LABELS[0])).when(x < -10, F.lit(fixed.STRATEGY_LABELS[1])) \
        .otherwise(F.lit(fixed.STRATEGY_LABELS[2]))


def scale_millions(c: ColumnOrName) -> Column:
    return _c(c).cast("double") / F.lit(1_000_000.0)


# ---------------------------------------------------------------- dates and ages

def date_key(d: ColumnOrName) -> Column:
    """date -> yyyyMMdd int; NULL stays NULL."""
    x = _c(d)
    return (F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)).cast("int")


def date_key_or_unknown(d: ColumnOrName) -> Column:
    return F.coalesce(date_key(d), F.lit(-1))


def season_label(start_year: ColumnOrName) -> Column:
    """2024 -> '2024/25'."""
    y = _c(start_year)
    return F.format_string("%d/%02d", y, (y + 1) % 100)


def season_short(start_year: ColumnOrName) -> Column:
    """2024 -> '24/25'."""
    y = _c(start_year)
    return F.format_string("%02d/%02d", y % 100, (y + 1) % 100)


def month_label(d: ColumnOrName) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def quarter_label(d: ColumnOrName) -> Column:
    return F.format_string("Q%d %d", F.quarter(_c(d)), F.year(_c(d)))


def date_label(d: ColumnOrName) -> Column:
    return F.date_format(_c(d), "dd/MM/yyyy")


def day_of_week_monday1(d: ColumnOrName) -> Column:
    return F.weekday(_c(d)) + 1


def calendar_age(dob: ColumnOrName, on: ColumnOrName) -> Column:
    """Whole years; one less before the birthday (month*100+day comparison)."""
    b, d = _c(dob), _c(on)
    before = (F.month(d) * 100 + F.dayofmonth(d)) < (F.month(b) * 100 + F.dayofmonth(b))
    return (F.year(d) - F.year(b) - F.when(before, 1).otherwise(0)).cast("int")


def age_in_range(dob: ColumnOrName, on: ColumnOrName, lo: int, hi: int) -> Column:
    """Calendar age, NULL when a date is missing or the age is outside [lo, hi]."""
    a = calendar_age(dob, on)
    return F.when(a.between(lo, hi), a)


def youth_flag(dob: ColumnOrName, on: ColumnOrName) -> Column:
    """NULL when a date is missing, else 1 for age < 18 (raw age, no range check)."""
    a = calendar_age(dob, on)
    return F.when(a.isNotNull(), F.when(a < 18, 1).otherwise(0))


def age_days365(dob: ColumnOrName, on: ColumnOrName) -> Column:
    return F.floor(F.datediff(_c(on), _c(dob)) / 365).cast("int")


def season_age(start_year: ColumnOrName, dob: ColumnOrName) -> Column:
    return (_c(start_year) - F.year(_c(dob))).cast("int")


# ---------------------------------------------------------------- match outcome

def match_outcome(goals_for: ColumnOrName, goals_against: ColumnOrName) -> dict[str, Column]:
    gf, ga = _c(goals_for), _c(goals_against)
    return {
        "is_win": F.when(gf > ga, 1).otherwise(0),
        "is_draw": F.when(gf == ga, 1).otherwise(0),
        "is_loss": F.when(gf < ga, 1).otherwise(0),
        "is_clean_sheet": F.when(ga == 0, 1).otherwise(0),
        "points": F.when(gf > ga, 3).when(gf == ga, 1).otherwise(0),
        "goal_difference": (gf - ga).cast("int"),
    }


def is_home(hosting: ColumnOrName) -> Column:
    return F.when(_c(hosting) == "Home", 1).otherwise(0)


# ---------------------------------------------------------------- DSV flags

def flag_not_null(c: ColumnOrName) -> Column:
    return F.when(_c(c).isNotNull(), 1).otherwise(0)


def null_to_zero_key(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c).cast("int"), F.lit(0))


def is_free_or_loan(fee: ColumnOrName) -> Column:
    return F.when(_c(fee) == 0, 1).otherwise(0)


def pro_age(age: ColumnOrName, youth: ColumnOrName) -> Column:
    return F.when(_c(youth) == 0, _c(age)).otherwise(0)


def pro_count(youth: ColumnOrName) -> Column:
    return F.when(_c(youth) == 0, 1).otherwise(0)


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: float = 1.0) -> Column:
    """num * scale / den as double; NULL when den is 0 or NULL (IIF-empty guard)."""
    n = _c(num).cast("double")
    if scale != 1.0:
        n = n * F.lit(float(scale))
    return F.try_divide(n, _c(den).cast("double"))
