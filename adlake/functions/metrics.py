"""Scalar and aggregate metric builders.

Every builder yields built-in Spark expressions (no UDF), so it stays inside
whole-stage codegen: row-level builders as SQL expression text (and Columns
made from it), aggregate builders as Columns.  Two rate families exist on
purpose:

* row-level *guarded* rates (silver): a zero or missing denominator gives ``0``;
* aggregate *ratio of sums* (KPI layer): a zero denominator gives ``null``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "MICROS_PER_UNIT",
    "guarded_ratio",
    "guarded_pct",
    "micros",
    "pct",
    "lost_pct",
    "cpm_cost",
    "day_part",
    "criterion_id",
    "url_host",
    "trailing_id",
    "age_label",
    "weekday_name",
    "ratio_of_sums",
    "money_sum",
    "ctr",
    "cpc",
    "cvr",
    "cpa",
    "roas",
    "guarded_ratio_sql",
    "guarded_pct_sql",
    "micros_sql",
    "pct_sql",
    "lost_pct_sql",
    "cpm_cost_sql",
    "day_part_sql",
    "criterion_id_sql",
    "url_host_sql",
    "trailing_id_sql",
    "age_label_sql",
    "weekday_name_sql",
    "ratio_of_sums_sql",
    "ctr_sql",
    "cpc_sql",
    "cvr_sql",
    "cpa_sql",
    "roas_sql",
]

# Fixed values that must equal the reference's: currency micros, day-part hour
# bounds, regex patterns and weekday names.
MICROS_PER_UNIT = 1000000
DAY_PARTS = (("Morning", 6, 11), ("Afternoon", 12, 17), ("Evening", 18, 23))
DAY_PART_ELSE = "Night"
CRITERION_ID_PATTERN = r"adGroupCriteria/\d+~(\d+)"
URL_HOST_PATTERN = r"https?://([^/]+)"
TRAILING_ID_PATTERN = r"/(\d+)$"
AGE_PREFIX = "AGE_RANGE_"
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit(s: str) -> str:
    """SQL string literal (backslashes and quotes escaped for Spark's parser)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


# ---------------------------------------------------------------- row level
#
# Row-level builders take column names (or SQL expressions) and return SQL
# text (``*_sql``) or the same as a Column.  As text they go into one
# ``selectExpr`` per projection: a single driver->JVM call for a whole spec.


def guarded_ratio_sql(num: str, den: str, scale: float | int | None = None) -> str:
    """SC-2: ``num / den`` (times ``scale``) when ``den > 0``, else ``0``."""
    r = f"({num} / {den})" + (f" * {scale}" if scale is not None else "")
    return f"CASE WHEN {den} > 0 THEN {r} ELSE 0 END"


def guarded_pct_sql(num: str, den: str) -> str:
    """SC-1: guarded ratio as a percentage (CTR, CVR in silver)."""
    return guarded_ratio_sql(num, den, 100)


def micros_sql(c: str) -> str:
    """SC-3: micro-units to currency units (bigint -> double)."""
    return f"({c} / {MICROS_PER_UNIT})"


def pct_sql(c: str) -> str:
    """SC-4: fraction to percentage."""
    return f"({c} * 100)"


def lost_pct_sql(c: str) -> str:
    """SC-5: complement of a share, as a percentage."""
    return f"((1 - {c}) * 100)"


def cpm_cost_sql(impressions: str, cpm: str) -> str:
    """SC-6: cost from a CPM price: (impressions / 1000) * cpm."""
    return f"(({impressions} / 1000) * {cpm})"


def day_part_sql(hour: str) -> str:
    """SC-7: hour of day to a day part; anything else (incl. 0-5 and null) is Night."""
    whens = " ".join(f"WHEN {hour} >= {lo} AND {hour} <= {hi} THEN {_lit(label)}" for label, lo, hi in DAY_PARTS)
    return f"CASE {whens} ELSE {_lit(DAY_PART_ELSE)} END"


def criterion_id_sql(c: str) -> str:
    """SC-8: criterion id after the tilde of an ad-group-criterion resource name."""
    return f"regexp_extract({c}, {_lit(CRITERION_ID_PATTERN)}, 1)"


def url_host_sql(c: str) -> str:
    """SC-9: host of the first http(s) URL in the text ('' when none)."""
    return f"regexp_extract({c}, {_lit(URL_HOST_PATTERN)}, 1)"


def trailing_id_sql(c: str) -> str:
    """SC-10: trailing numeric id of a resource path ('' when none)."""
    return f"regexp_extract({c}, {_lit(TRAILING_ID_PATTERN)}, 1)"


def age_label_sql(c: str) -> str:
    """SC-11: AGE_RANGE_18_24 -> 18-24."""
    return f"translate(regexp_replace({c}, {_lit(AGE_PREFIX)}, ''), '_', '-')"


def weekday_name_sql(dow: str) -> str:
    """SC-12: day-of-week number (1 = Sunday) to its name; no else branch."""
    whens = " ".join(f"WHEN {i} THEN {_lit(n)}" for i, n in enumerate(WEEKDAYS, start=1))
    return f"CASE {dow} {whens} END"


def _expr(sql_builder, *args, **kwargs) -> Column:
    """Column from a text builder; only names / SQL text are accepted as inputs."""
    bad = [a for a in args if not isinstance(a, str)]
    if bad:
        raise TypeError(f"{sql_builder.__name__} takes column names or SQL text, got {bad!r}")
    return F.expr(sql_builder(*args, **kwargs))


def guarded_ratio(num: str, den: str, scale: float | int | None = None) -> Column:
    return _expr(guarded_ratio_sql, num, den, scale=scale)


def guarded_pct(num: str, den: str) -> Column:
    return _expr(guarded_pct_sql, num, den)


def micros(c: str) -> Column:
    return _expr(micros_sql, c)


def pct(c: str) -> Column:
    return _expr(pct_sql, c)


def lost_pct(c: str) -> Column:
    return _expr(lost_pct_sql, c)


def cpm_cost(impressions: str, cpm: str) -> Column:
    return _expr(cpm_cost_sql, impressions, cpm)


def day_part(hour: str) -> Column:
    return _expr(day_part_sql, hour)


def criterion_id(c: str) -> Column:
    return _expr(criterion_id_sql, c)


def url_host(c: str) -> Column:
    return _expr(url_host_sql, c)


def trailing_id(c: str) -> Column:
    return _expr(trailing_id_sql, c)


def age_label(c: str) -> Column:
    return _expr(age_label_sql, c)


def weekday_name(dow: str) -> Column:
    return _expr(weekday_name_sql, dow)


# ---------------------------------------------------------------- aggregate level


def ratio_of_sums(num: Column, den: Column, scale: float | int | None = None, digits: int | None = 2) -> Column:
    """AGG-2: ``round(num / nullif(den, 0) * scale, digits)``; null on a zero denominator."""
    r = num / F.nullif(den, F.lit(0))
    if scale is not None:
        r = r * scale
    return F.round(r, digits) if digits is not None else r


def money_sum(c: str | Column) -> Column:
    """Exact, order-independent sum of a currency column.

    Currency values come from micros / 1e6, so a decimal(20,6) sum is exact; the
    result is returned as double like the reference's sum over doubles.
    """
    return F.sum(_c(c).cast("decimal(20,6)")).cast("double")


def ratio_of_sums_sql(num: str, den: str, scale: float | int | None = None, digits: int | None = 2) -> str:
    """AGG-2 as SQL text over already aggregated columns / expressions."""
    r = f"({num} / nullif({den}, 0))"
    if scale is not None:
        r = f"({r} * {scale})"
    return f"round({r}, {digits})" if digits is not None else r


def ctr_sql(clicks: str, impressions: str) -> str:
    return ratio_of_sums_sql(clicks, impressions, 100)


def cpc_sql(cost: str, clicks: str) -> str:
    return ratio_of_sums_sql(cost, clicks)


def cvr_sql(conversions: str, clicks: str) -> str:
    return ratio_of_sums_sql(conversions, clicks, 100)


def cpa_sql(cost: str, conversions: str) -> str:
    return ratio_of_sums_sql(cost, conversions)


def roas_sql(revenue: str, cost: str) -> str:
    return ratio_of_sums_sql(revenue, cost)


# MET-1: weighted metrics over sums (formulas of the reference's metric notes).
def ctr(clicks: Column, impressions: Column, digits: int | None = 2) -> Column:
    return ratio_of_sums(clicks, impressions, 100, digits)


def cpc(cost: Column, clicks: Column, digits: int | None = 2) -> Column:
    return ratio_of_sums(cost, clicks, None, digits)


def cvr(conversions: Column, clicks: Column, digits: int | None = 2) -> Column:
    return ratio_of_sums(conversions, clicks, 100, digits)


def cpa(cost: Column, conversions: Column, digits: int | None = 2) -> Column:
    return ratio_of_sums(cost, conversions, None, digits)


def roas(revenue: Column, cost: Column, digits: int | None = 2) -> Column:
    return ratio_of_sums(revenue, cost, None, digits)
