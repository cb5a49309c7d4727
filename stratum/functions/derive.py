"""Derived columns: date parts, bands, ranges, durations, grades.

Band tables are data (see ``vocab``); ``band`` turns a table into one
``CASE WHEN`` chain.  Nothing here is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum.functions import vocab as V
from stratum.functions.clean import col


def _cmp(c: Column, op: str, cut) -> Column:
    if op == "between":
        lo, hi = cut
        return c.between(lo, hi)
    if op == "<":
        return c < cut
    if op == "<=":
        return c <= cut
    if op == ">":
        return c > cut
    if op == ">=":
        return c >= cut
    if op == "==":
        return c == cut
    if op == "!=":
        return c != cut
    raise ValueError(f"unknown band operator {op!r}")


def band(c: str | Column, cuts: Sequence[tuple], else_label: str,
         null_label: str | None = None) -> Column:
    """Label a numeric value from an ordered cut table (first match wins).

    ``null_label`` (when given) is returned for NULL input; otherwise a NULL
    value matches no row and falls through to ``else_label``.
    """
    c = col(c)
    expr = F.when(c.isNull(), F.lit(null_label)) if null_label is not None else None
    for op, cut, label in cuts:
        cond = _cmp(c, op, cut)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(else_label) if expr is None else expr.otherwise(F.lit(else_label))


def bp_category(systolic: str | Column, diastolic: str | Column,
                rules: Sequence[tuple] = V.BP_RULES, else_label: str = V.BP_ELSE,
                null_label: str = V.VITALS_UNKNOWN) -> Column:
    """Two-variable banding of a blood-pressure reading (ordered rules)."""
    s, d = col(systolic), col(diastolic)
    expr = F.when(s.isNull() | d.isNull(), F.lit(null_label))
    for s_op, s_cut, how, d_op, d_cut, label in rules:
        a, b = _cmp(s, s_op, s_cut), _cmp(d, d_op, d_cut)
        expr = expr.when((a & b) if how == "and" else (a | b), F.lit(label))
    return expr.otherwise(F.lit(else_label))


# ---- date parts -----------------------------------------------------------

DATE_PART_FORMATS = {
    "date_month": "dd MMMM",     # day + month name, e.g. "05 March"
    "month": "yyyy-MM",
    "year_str": "yyyy",
    "day_of_week": "EEEE",
    "iso": "yyyy-MM-dd",
}


def year_str(c: str | Column) -> Column:
    return F.year(col(c)).cast("string")


def quarter_label(c: str | Column) -> Column:
    """``<year>-Q<quarter>``, e.g. ``2024-Q1``."""
    c = col(c)
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def date_part(c: str | Column, part: str) -> Column:
    if part == "year":
        return year_str(c)
    if part == "quarter":
        return quarter_label(c)
    return F.date_format(col(c), DATE_PART_FORMATS[part])


def date_parts(c: str, names: Mapping[str, str]) -> dict[str, Column]:
    """Bundle of date parts: ``{output column: part}`` -> column dict.

    Parts: ``date_month`` (dd MMMM), ``month`` (yyyy-MM), ``year_str``
    (date_format yyyy), ``year`` (year cast to string), ``quarter``
    (yyyy-Qn), ``day_of_week`` (EEEE), ``iso`` (yyyy-MM-dd).
    """
    return {out: date_part(c, part) for out, part in names.items()}


def shift_code(ts: str | Column) -> Column:
    return band(F.hour(col(ts)), V.SHIFT_BANDS, V.SHIFT_ELSE)


# ---- ranges ---------------------------------------------------------------

def parse_range(c: str | Column, sep: str = "-") -> tuple[Column, Column]:
    """Split ``"lo<sep>hi"`` into (lower, upper) doubles, NULL when absent
    or not a number (``<80`` -> (NULL, NULL), ``-5-80`` -> (NULL, 5.0))."""
    parts = F.split(col(c), sep)
    return (F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double"))


def classify_range(v: str | Column, lo: str | Column, hi: str | Column,
                   low: str = "LOW", high: str = "HIGH", normal: str = "NORMAL") -> Column:
    """LOW below ``lo``, HIGH above ``hi``, else NORMAL (NULL bound -> NORMAL)."""
    v = col(v)
    return F.when(v < col(lo), F.lit(low)).when(v > col(hi), F.lit(high)).otherwise(F.lit(normal))


def flag(pred: Column) -> Column:
    """Boolean flag: true when ``pred`` is true, false when false or NULL."""
    return F.when(pred, F.lit(True)).otherwise(F.lit(False))


def invalid_flag(pred: Column) -> Column:
    """Flag rows whose value fails a rule (``pred`` true); NULL -> false."""
    return flag(pred)


def mismatch_flag(a: str | Column, b: str | Column) -> Column:
    return flag(col(a) != col(b))


# ---- quantities and durations --------------------------------------------

def loss(inp: str | Column, out: str | Column, scale: int = 2) -> tuple[Column, Column]:
    """(loss quantity, loss percent of input); NULL when an input is NULL,
    percent NULL unless input > 0."""
    i, o = col(inp), col(out)
    both = i.isNotNull() & o.isNotNull()
    qty = F.when(both, i - o)
    pct = F.when(both & (i > 0), F.round(F.try_divide(i - o, i) * F.lit(100), scale))
    return qty, pct


def variance(actual: str | Column, plan: str | Column, scale: int = 2) -> tuple[Column, Column]:
    """(round(actual - plan), round(variance / plan * 100)); NULL on plan 0."""
    var = F.round(col(actual) - col(plan), scale)
    pct = F.round(F.try_divide(var, col(plan)) * F.lit(100), scale)
    return var, pct


def fulfillment(actual: str | Column, plan: str | Column) -> Column:
    a, p = col(actual), col(plan)
    return (F.when(a > p, F.lit("OK"))
            .when(a < p, F.lit("UNDER PRODUCTION"))
            .otherwise(F.lit("ON TARGET")))


def days_between(start: str | Column, end: str | Column) -> Column:
    """Whole days from ``start`` to ``end`` (NULL if either is NULL)."""
    return F.datediff(col(end), col(start))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Minutes from ``start`` to ``end``, at whole-second precision."""
    return (F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))) / F.lit(60)


def sla_days(severity: str | Column, table: Mapping[str, int] = V.SLA_DAYS,
             default: int = V.SLA_DEFAULT) -> Column:
    s = col(severity)
    expr = None
    for sev, days in table.items():
        cond = s == F.lit(sev)
        expr = F.when(cond, F.lit(days)) if expr is None else expr.when(cond, F.lit(days))
    return expr.otherwise(F.lit(default))


def flag_any(thresholds: Iterable[tuple[str | Column, float]]) -> Column:
    """True when any ``column > threshold`` holds (NULL comparisons -> false)."""
    pred = None
    for c, thr in thresholds:
        p = col(c) > F.lit(thr)
        pred = p if pred is None else (pred | p)
    return flag(pred)


def grade(rules: Sequence[tuple], else_label: str) -> Column:
    """Ordered grading over already-computed measures (first match wins)."""
    expr = None
    for measure, op, thr, label in rules:
        cond = _cmp(col(measure), op, thr)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(else_label))


def stamp() -> Column:
    """Audit timestamp (processing time)."""
    return F.current_timestamp()
