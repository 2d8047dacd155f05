"""Stateful streaming operators whose state a watermark bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veriledger.operators.marts import by_upload_window


def _as_instant(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a timestamp with a zone; zone-less ones are read in the session zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def dedup_stream(
    stream: DataFrame, key: str, time_column: str, delay: str, salts: int = 8
) -> DataFrame:
    """One row per key among copies that arrive within ``delay`` of each other.

    Copies are first removed within ``salts`` random shares of each key, and only one row
    per share goes on to the removal by key: a key that holds much of the stream does not
    sit in one task.  The seed makes the share of a row the same when a task is repeated.
    With ``salts=1`` there is one removal, by key.

    Rows older than the watermark, ``delay`` behind the newest time seen, are dropped;
    ``late_rows`` counts them.
    """
    timed = _as_instant(stream, time_column).withWatermark(time_column, delay)
    if salts > 1:
        share = F.floor(F.rand(seed=1) * salts).cast("int")
        timed = timed.withColumn("__share", share).dropDuplicatesWithinWatermark([key, "__share"])
        timed = timed.drop("__share")
    return timed.dropDuplicatesWithinWatermark([key])


def window_totals(valid: DataFrame, delay: str, hours: int = 6) -> DataFrame:
    """Totals per upload window of a stream; a window comes out once it is complete.

    Rows that come after their window is complete are dropped; ``late_rows`` counts them.
    """
    timed = _as_instant(valid, "upload_time").withWatermark("upload_time", delay)
    return by_upload_window(timed, hours)


def late_rows(query: StreamingQuery) -> int:
    """How many rows the operators of a stream have dropped as late, over its recent batches."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
