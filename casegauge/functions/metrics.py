"""Scalar metric expressions. Every function takes and returns Spark columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

UNREACHABLE = 10000


def as_col(value) -> Column:
    """A column from a column or a column name."""
    return value if isinstance(value, Column) else F.col(value)


def excess_over(value, target) -> Column:
    """Deficit of a high-is-bad metric: max(value - target, 0); a null gives 0."""
    return F.greatest(as_col(value) - as_col(target), F.lit(0))


def shortfall(value, target) -> Column:
    """Deficit of a low-is-bad metric: max(target - value, 0); a null gives 0."""
    return F.greatest(as_col(target) - as_col(value), F.lit(0))


def complement_pct(value) -> Column:
    """100 - x, e.g. out-of-country from in-country."""
    return F.lit(100) - as_col(value)


def guarded_ratio(num, den, scale=1.0, digits=None, default=0.0) -> Column:
    """scale * num / den where den > 0, else the default (None gives null)."""
    num, den = as_col(num).cast("double"), as_col(den).cast("double")
    ratio = F.try_divide(F.lit(float(scale)) * num, den)
    if digits is not None:
        ratio = F.round(ratio, digits)
    return F.when(den > 0, ratio).otherwise(F.lit(default).cast("double"))


def sanitize_numeric(value, scale=1) -> Column:
    """Infinity, NaN and null become -1; then scale and truncate to an integer."""
    value = as_col(value).cast("double")
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(math.inf))
    return (F.when(bad, F.lit(-1.0)).otherwise(value) * F.lit(float(scale))).cast("int")


def pct_change(now, before) -> Column:
    """Whole-percent change against `before`, 0 where `before` is not positive."""
    now, before = as_col(now).cast("double"), as_col(before).cast("double")
    change = F.round(F.try_divide(now - before, before) * 100.0, 0)
    return F.when(before > 0, change).otherwise(F.lit(0.0)).cast("int")


def change_label(now, before) -> Column:
    """The report form `value (p%)`."""
    return F.concat(as_col(now).cast("string"), F.lit(" ("), pct_change(now, before).cast("string"), F.lit("%)"))


def target_ratio(value, target, cap=10.0) -> Column:
    """value / target, rounded to 2 places and capped; null where the target is 0."""
    ratio = F.try_divide(as_col(value).cast("double"), as_col(target).cast("double"))
    return F.when(ratio.isNotNull(), F.least(F.lit(float(cap)), F.round(ratio, 2)))


def severity_index(value) -> Column:
    """1 - exp(-x ln2 / 100): 0 without deficit, 0.5 at a deficit of 100 percent."""
    return F.lit(1.0) - F.exp(as_col(value).cast("double") * F.lit(-math.log(2) / 100))


def class_map(value, mapping: dict, default) -> Column:
    """A literal code table as a CASE expression."""
    out = None
    for key, code in mapping.items():
        out = F.when(as_col(value) == F.lit(key), F.lit(code)) if out is None else out.when(
            as_col(value) == F.lit(key), F.lit(code))
    return out.otherwise(F.lit(default))


def split_by_class(value, cls, code) -> Column:
    """The value where the class matches, else 0."""
    value = as_col(value)
    return F.when(as_col(cls) == F.lit(code), value).otherwise(F.lit(0).cast("double"))


def remap(value, old, new) -> Column:
    return F.when(as_col(value) == F.lit(old), F.lit(new)).otherwise(as_col(value))


def is_even(score) -> Column:
    """Measured by ping: the score is even."""
    return (F.pmod(as_col(score), F.lit(2)) == 0).cast("int")


def is_local(score) -> Column:
    """Local assignment: the second lowest bit of the score is set."""
    return (F.pmod(as_col(score), F.lit(4)) >= 2).cast("int")


def is_continent_fallback(max_score, max_rank) -> Column:
    """Continent fallback: score and rank both above their largest regular values."""
    return ((as_col(max_score) > 65533) & (as_col(max_rank) > 253)).cast("int")


def peak_flag(hour, utc_offset) -> Column:
    """1 from 18:00 local time on; an unknown offset counts as off-peak."""
    local = F.pmod(as_col(hour) + as_col(utc_offset), F.lit(24))
    return F.coalesce((local >= 18).cast("int"), F.lit(0))


def utc_offset_hours(zone, at="2015-04-20 12:00:00") -> Column:
    """Whole-hour UTC offset of a zone at a reference time (fractions truncated)."""
    ref = F.lit(at).cast("timestamp")
    seconds = F.unix_timestamp(F.from_utc_timestamp(ref, as_col(zone))) - F.unix_timestamp(ref)
    return (seconds / 3600).cast("int")


def entropy(share) -> Column:
    """Aggregate: -sum(p ln p) with 0 for p = 0; p is taken as given, not normalised."""
    p = as_col(share)
    return -F.sum(F.when(p > 0, p * F.ln(p)).otherwise(F.lit(0.0)))
