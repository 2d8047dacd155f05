"""Bitmaps of ids: which ids are surely not among those seen.

An id sets one bit of a fixed number of them.  Bitmaps of several runs are merged by OR; an
id whose bit is not set has not been seen, one whose bit is set may have been.  A bitmap comes
as rows of 4 KiB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_DDL = "bitmap_row int, bitmap binary"
_ROW_BITS = 1 << 15


def _bit(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def bitmap_of(ids: DataFrame, key: str, bits: int) -> DataFrame:
    """``bitmap_row, bitmap`` of the non-NULL ids; partial bitmaps are made in the map tasks."""
    if bits < _ROW_BITS or bits % _ROW_BITS:
        raise ValueError(f"the bits of a bitmap are a multiple of {_ROW_BITS}")
    at = ids.where(F.col(key).isNotNull()).select(_bit(key, bits).alias("bit"))
    return at.groupBy((F.col("bit") / _ROW_BITS).cast("int").alias("bitmap_row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") % _ROW_BITS + 1)).alias("bitmap")
    )


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One bitmap from several of the same size."""
    return bitmaps.groupBy("bitmap_row").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def possibly_in(ids: DataFrame, key: str, bitmap: DataFrame, bits: int) -> DataFrame:
    """The rows whose id may be among those of the bitmap.

    The bitmap is broadcast: an eighth of ``bits`` in bytes, whatever the number of ids.
    """
    bit = _bit(key, bits)
    byte = F.substring("__bitmap", (bit % _ROW_BITS / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    rows = F.broadcast(bitmap.select(F.col("bitmap_row").alias("__row"), F.col("bitmap").alias("__bitmap")))
    found = ids.join(rows, (bit / _ROW_BITS).cast("int") == F.col("__row"))
    is_set = F.call_function("shiftright", value, (bit % 8).cast("int")).bitwiseAND(1) == 1
    return found.where(is_set).select(*ids.columns)
