"""Column functions on time: buckets for directory layout and run windows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

# The granularities a table may be partitioned by.
GRANULARITIES = {"HOUR": "hour", "DAY": "day"}


def bucket(column: Column, granularity: str) -> Column:
    """Start of the hour or day a timestamp falls in."""
    return F.date_trunc(GRANULARITIES[granularity], column)


def instant(value: datetime | str, kind: DataType) -> Column:
    """A constant of the same timestamp type as a column.

    Comparing like with like leaves the column bare, so the comparison reaches the
    Parquet scan; a cast around the column would not.
    """
    target = "timestamp_ntz" if isinstance(kind, TimestampNTZType) else "timestamp"
    return F.lit(str(value)).cast(target)


def lookback_start(now: datetime | str, hours: float) -> datetime:
    """The inclusive lower bound of a lookback ending now."""
    moment = datetime.fromisoformat(now) if isinstance(now, str) else now
    return moment - timedelta(hours=hours)


def start_of_hour(moment: datetime) -> datetime:
    return moment.replace(minute=0, second=0, microsecond=0)
