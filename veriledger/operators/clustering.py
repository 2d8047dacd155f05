"""Rows in an order that keeps neighbours in several columns together.

Each column is cut at boundaries into ranges of about equally many rows.  The numbers of a row's
ranges, with their bits interleaved, are its place on a curve through all columns.  Files
written in that order hold few values of each of the columns, so the statistics of files,
row groups and pages rule out most of a table for a condition on any one of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TIMES = "spark.sql.parquet.outputTimestampType"
# Rows, about, from which boundaries are learned, and columns that 62 bits are shared by.
SAMPLE, MOST_COLUMNS = 65_536, 6


def boundaries(df: DataFrame, columns: Sequence[str], bits: int, sample: int = SAMPLE) -> DataFrame:
    """One row: for each column ``2 ** bits - 1`` sorted values that cut a sample into ranges of like size.

    Columns without a value have no boundaries, and all of their rows are in range 0.  A value
    of many rows is a boundary many times, so that it takes its share of the ranges.
    """
    rows = df.count()
    few = df.select(*columns)
    if rows > sample:
        few = few.sample(sample / rows, seed=7)

    def cut(column: str) -> Column:
        values = F.sort_array(F.collect_list(column))
        places = F.sequence(F.lit(1), F.lit((1 << bits) - 1))
        at = F.transform(places, lambda i: F.element_at(values, (F.floor(i * F.size(values) / (1 << bits)) + 1).cast("int")))
        return F.when(F.size(values) > 0, at).alias(column)

    return few.agg(*[cut(c) for c in columns])


def range_number(value: Column, bounds: Column, bits: int) -> Column:
    """How many of the sorted boundaries are at most the value, by halving; NULL counts as least."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.element_at(bounds, at + step) <= value, step).otherwise(0)
    )
    return F.when(value.isNull() | bounds.isNull(), 0).otherwise(found)


def interleaved(numbers: Sequence[Column], bits: int) -> Column:
    """The bits of some numbers by turns, highest first, as one bigint."""
    total = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, number in enumerate(numbers):
            one = F.shiftright(number.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            total = total + F.shiftleft(one, bit * len(numbers) + len(numbers) - 1 - place)
    return total


def clustered(df: DataFrame, columns: Sequence[str], leading: Sequence[str] = (), bits: int = 8) -> DataFrame:
    """The same rows, dealt and sorted by ``leading`` columns and then along the curve through ``columns``.

    Reads ``df`` three times (count and sample, ranges of the curve, rows), so it should be a
    written table.  Rows of one place on the curve are told apart by a hash of the whole row:
    a value that a third of all rows have is spread over its ranges of the other columns, and
    any place, however full, over several tasks.  AQE merges ranges that come out small.
    """
    if not 0 < len(columns) <= MOST_COLUMNS or bits * len(columns) > 62 or bits < 1:
        raise ValueError(f"one to {MOST_COLUMNS} columns share at most 62 bits")
    found = boundaries(df, columns, bits).first()
    numbers = []
    for column in columns:
        bounds = F.lit(None) if found[column] is None else F.lit(found[column])
        bounds = bounds.cast(f"array<{df.schema[column].dataType.simpleString()}>")
        numbers.append(range_number(F.col(column), bounds, bits))
    plain = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    order = {"__place": interleaved(numbers, bits), "__tie": F.xxhash64(*plain)}
    dealt = df.withColumns(order).repartitionByRange(*leading, *order)
    return dealt.sortWithinPartitions(*leading, "__place", *columns).drop(*order)


@contextmanager
def searchable_times(spark: SparkSession) -> Iterator[None]:
    """Writes within store timestamps in a form that has statistics, which the default form has not."""
    before = spark.conf.get(_TIMES)
    spark.conf.set(_TIMES, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(_TIMES, before)
