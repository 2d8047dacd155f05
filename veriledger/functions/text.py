"""Column functions on text: number look-alikes, closed domains, timestamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of timestamps in the feeds.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


# The texts that Spark casts to the double NaN: signed only in this very spelling.
NAN_TEXT = r"^[\x00-\x20]*([+-]?NaN|(?i:nan))[\x00-\x20]*$"


def reads_as_nan(column: Column) -> Column:
    """True only for text that casts to the number NaN; NULL and other text give false.

    Matching the text gives the same answer as ``isnan(try_cast(... as double))`` without
    the failed number parse, which raises an exception inside for every ordinary id.
    """
    return F.coalesce(column.rlike(NAN_TEXT), F.lit(False))


def within_domain(column: Column, domain: Sequence[str], otherwise: str) -> Column:
    """The value itself if it belongs to a closed domain, else a stand-in (also for NULL)."""
    return F.when(column.isin(*domain), column).otherwise(F.lit(otherwise))


def parse_timestamp(column: Column, pattern: str = TIMESTAMP_FORMAT) -> Column:
    """Text to timestamp in the session zone; malformed text becomes NULL."""
    return F.try_to_timestamp(column, F.lit(pattern))
