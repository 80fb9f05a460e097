"""Comparisons of time columns with epoch seconds that reach the scan."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

DAY = 86400
_EPOCH = datetime.datetime(1970, 1, 1)


def at_least(df: DataFrame, column: str, seconds: int, strict: bool = False) -> Column:
    """The column's time is not before (with `strict`, is after) a second.

    Numbers are compared as they are. A date or timestamp column is compared with a literal of its own type, not
    converted: partitions are pruned by it, and files are skipped. A date stands for its midnight, UTC."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, DateType):
        return c >= _day(seconds) if not strict and seconds % DAY == 0 else c > _day(seconds)
    bound = _bound(kind, seconds)
    return c > bound if strict else c >= bound


def before(df: DataFrame, column: str, seconds: int, strict: bool = True) -> Column:
    """The column's time is before (without `strict`, is not after) a second, as in `at_least`."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, DateType):
        return c < _day(seconds) if strict and seconds % DAY == 0 else c <= _day(seconds)
    bound = _bound(kind, seconds)
    return c < bound if strict else c <= bound


def _day(seconds: int) -> Column:
    return F.lit((_EPOCH + datetime.timedelta(days=seconds // DAY)).date())


def _bound(kind, seconds: int) -> Column:
    if isinstance(kind, TimestampType):
        return F.timestamp_seconds(F.lit(seconds))
    if isinstance(kind, TimestampNTZType):
        return F.lit((_EPOCH + datetime.timedelta(seconds=seconds)).isoformat(" ")).cast("timestamp_ntz")
    return F.lit(seconds)
