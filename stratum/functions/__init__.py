"""Column-level building blocks."""

from stratum.functions.clean import decode, fill_label, fill_or_trim, normalize, require, whitelist
from stratum.functions.derive import (band, bp_category, classify_range, date_parts, days_between,
                                      flag, flag_any, fulfillment, grade, invalid_flag, loss, minutes_between,
                                      mismatch_flag, parse_range, quarter_label, shift_code,
                                      sla_days, variance, year_str)
from stratum.functions.rollup import complement_pct, count_where, mean, rate_pct, rmax, rmin, rsum

__all__ = [
    "band", "bp_category", "classify_range", "complement_pct", "count_where", "date_parts",
    "days_between", "decode", "fill_label", "fill_or_trim", "flag", "flag_any", "fulfillment",
    "grade", "invalid_flag", "loss", "mean", "minutes_between", "mismatch_flag", "normalize", "parse_range",
    "quarter_label", "rate_pct", "require", "rmax", "rmin", "rsum", "shift_code", "sla_days",
    "variance", "whitelist", "year_str",
]
