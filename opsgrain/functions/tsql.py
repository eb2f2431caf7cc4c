"""Column expressions that reproduce the source system's SQL / DAX semantics
where Spark's defaults differ (SURVEY §1.5, D1-D15).  All are built-in
``pyspark.sql.functions`` compositions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The clock-text pattern the time(7) cast accepts (h:mm[:ss[.fffffff]]).
CLOCK_PATTERN = r"^([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]{1,7})?)?$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# CONCAT treats NULL as an empty string and stringifies numbers.
def concat_text(*parts) -> Column:
    return F.concat_ws("", *[col_(p).cast("string") if not isinstance(p, str) else F.col(p).cast("string") for p in parts])


def lit_text(s: str) -> Column:
    return F.lit(s)


# D3: DATEDIFF counts unit boundaries, not elapsed units.
def ms_between(start, end) -> Column:
    return F.unix_millis(col_(end)) - F.unix_millis(col_(start))


def seconds_between(start, end) -> Column:
    return F.unix_seconds(col_(end)) - F.unix_seconds(col_(start))


# FORMAT(x,'N<d>') rounds half away from zero, then groups thousands.
def format_n(x, decimals: int) -> Column:
    return F.format_number(F.round(col_(x), decimals), decimals)


# FORMAT(ts, 'h tt') -> '1 PM'.
def hour_label(ts) -> Column:
    return F.date_format(col_(ts), "h a")


# JSON_VALUE returns scalars only.
def json_value(js, path: str) -> Column:
    v = F.get_json_object(col_(js), path)
    return F.when(v.startswith("{") | v.startswith("["), F.lit(None).cast("string")).otherwise(v)


# DIVIDE(a, b) -> NULL (blank) on zero / NULL denominators.
def divide(a, b) -> Column:
    return F.try_divide(col_(a), col_(b))


# WEEKNUM(d, 1): weeks start on Sunday, week 1 holds January 1.
def weeknum_sunday(d) -> Column:
    d = col_(d)
    return F.ceil((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 1) / 7).cast("bigint")


# Clock text (time(7)) -> milliseconds since midnight, NULL if malformed.
def clock_ms(txt) -> Column:
    t = col_(txt)
    ok = t.rlike(CLOCK_PATTERN)
    hh = F.split_part(t, F.lit(":"), F.lit(1)).cast("bigint")
    mm = F.split_part(t, F.lit(":"), F.lit(2)).cast("bigint")
    sec_txt = F.split_part(t, F.lit(":"), F.lit(3))
    ss = F.when(sec_txt == "", F.lit(0)).otherwise(F.split_part(sec_txt, F.lit("."), F.lit(1)).cast("bigint"))
    frac = F.rpad(F.split_part(sec_txt, F.lit("."), F.lit(2)), 7, "0")
    ms_part = F.substring(frac, 1, 3).cast("bigint")
    return F.when(ok, hh * 3600000 + mm * 60000 + ss * 1000 + ms_part)


def clock_seconds_whole(txt) -> Column:
    """v1 form: DATEDIFF(second, '00:00:00', time) floors to whole seconds."""
    return F.floor(clock_ms(txt) / 1000).cast("bigint")


def ms_to_seconds(ms) -> Column:
    """Milliseconds (bigint) -> decimal(19,3) seconds, exact."""
    return (col_(ms).cast("decimal(19,0)") * F.lit(0.001).cast("decimal(4,3)")).cast("decimal(19,3)")


def round_div_units(ms, unit_divisor: int) -> Column:
    """round_half_up(ms / unit_divisor) for non-negative integers, in integer arithmetic."""
    return F.expr(f"(({col_name(ms)}) * 2 + {unit_divisor}) div {2 * unit_divisor}")


def col_name(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("round_div_units expects a column name")


def ms_to_dec4(ms, unit_ms: int) -> Column:
    """CAST(ms / unit_ms AS decimal(19,4)) with half-up rounding, exact.

    unit_ms = 3_600_000 for hours, 60_000 for minutes."""
    units = round_div_units(ms, unit_ms // 10000)
    return (units.cast("decimal(19,0)") * F.lit(0.0001).cast("decimal(5,4)")).cast("decimal(19,4)")


def dec4_units(dec) -> Column:
    """decimal(19,4) -> integer count of 1e-4 units (exact)."""
    return (col_(dec) * 10000).cast("bigint")


def trimmed(c) -> Column:
    """LTRIM(RTRIM(x)): spaces only."""
    return F.btrim(col_(c), F.lit(" "))


def nullif_blank(c) -> Column:
    t = trimmed(c)
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)
