"""One row per key, within a batch and across runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_per_key(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    """The first row of each key under an order.

    Spark turns ``row_number() = 1`` into a group limit that also runs before the shuffle:
    each map task passes on one row per key, however many copies it holds.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__number", number).where("__number = 1").drop("__number")


def keep_smallest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One whole row per key: the smallest by the remaining columns, NULLs first.

    NULL keys count as one key.  The choice is a property of the data, so re-runs and
    recomputed tasks agree.
    """
    payload = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    return _first_per_key(df, keys, payload) if payload else df.distinct()


def keep_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One whole row per key: the largest by ``latest_by``, ties by the other columns."""
    others = [c for c in df.columns if c not in keys and c not in latest_by]
    order = [F.col(c).desc_nulls_last() for c in [*latest_by, *others]]
    return _first_per_key(df, keys, order)


def drop_seen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not yet in ``seen``; rows with a NULL key are kept.

    ``df`` should hold each key once, as after the removal of duplicates by that key alone:
    the join then goes on in the partitions left by it, and no key can be hot.
    """
    return df.join(seen.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
