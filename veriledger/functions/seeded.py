"""Reproducible pseudo-random columns.

Values are hashes of (seed, row number, field name) and not ``rand()``: they do not
depend on how rows are split over partitions, so a recomputed task, another cluster
size or another reader of the same row number gives the same value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 1 << 53


def uniform(seed: int, row: Column, field: str) -> Column:
    """A double in [0, 1)."""
    return F.pmod(F.xxhash64(F.lit(seed), row, F.lit(field)), F.lit(_STEPS)) / F.lit(float(_STEPS))


def whole(seed: int, row: Column, field: str, low: int, high: int) -> Column:
    """An integer in [low, high]."""
    return (F.floor(uniform(seed, row, field) * (high - low + 1)) + low).cast("int")


def money(seed: int, row: Column, field: str, low: float, high: float) -> Column:
    """A value in [low, high] with two decimals."""
    return F.round(uniform(seed, row, field) * (high - low) + low, 2)


def choice(seed: int, row: Column, field: str, options: Sequence) -> Column:
    """One of a few literal options, all equally likely."""
    return F.element_at(
        F.array(*[F.lit(o) for o in options]), whole(seed, row, field, 1, len(options))
    )


def coin(seed: int, row: Column, field: str) -> Column:
    return uniform(seed, row, field) < 0.5


def happens(seed: int, row: Column, field: str, probability: float) -> Column:
    return uniform(seed, row, field) < probability


def uuid_text(seed: int, row: Column, field: str) -> Column:
    """An id in the text form of a random (version 4) UUID."""
    digest = F.md5(F.concat_ws("/", F.lit(str(seed)), row.cast("string"), F.lit(field)))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("4"), F.substring(digest, 14, 3)),
        F.concat(F.lit("a"), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
