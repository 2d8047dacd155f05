"""Sums of doubles that do not depend on the order of addition.

A double is a whole number of some power of two.  It is cut into digits of 24 bits at fixed
powers of two, digits are summed as whole numbers, and the sum is turned into the nearest
double at the end: the same bits however rows are partitioned, retried or merged.  NaN and
infinities are counted beside.

A total is a struct ``digits array<struct<place,value>>, nan, plus, minus, n``: it adds up with
others of its kind, and ``as_double`` says what it is worth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
_BASE = 1 << BITS
TOTAL = (
    "struct<digits:array<struct<place:int,value:decimal(38,0)>>,nan:bigint,plus:bigint,minus:bigint,n:bigint>"
)
_DIGITS = "array<struct<place:int,value:decimal(38,0)>>"
_VALUE = "decimal(38,0)"


def _power(places: Column) -> Column:
    """2 to the power of 24 times ``places``; halved on the way, as that may lie beyond a double."""
    return F.pow(F.lit(2.0), places * BITS)


def _in_pieces(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``__place`` and ``__d0`` to ``__d3``, the digits that hold a finite double whole; null for others.

    The place is guessed by a logarithm.  Should that be one off, the first digit is a bit
    longer or nought, and the digits together hold the same number.  Step by step, so that
    each is a column that generated code works out once.
    """
    size, place = F.abs(F.col(value)), F.col("__place")
    found = rows.withColumn(
        "__place", F.when(_finite(F.col(value)), F.when(size > 0, F.floor(F.log2(size) / BITS)).otherwise(0)).cast("int")
    )
    # Small numbers are lifted first: their power of two alone may be too small for a double.
    low = place < -36
    lifted = F.when(low, size * F.pow(F.lit(2.0), F.lit(20 * BITS))).otherwise(size)
    found = found.withColumn("__u", lifted / _power(F.when(low, place + 20).otherwise(place)))
    for i in range(4):
        found = found.withColumn(f"__d{i}", F.floor("__u").cast("double"))
        if i < 3:
            found = found.withColumn("__u", (F.col("__u") - F.col(f"__d{i}")) * float(_BASE))
    sign = F.when(F.col(value) < 0, F.lit(-1)).otherwise(F.lit(1))
    return found.withColumns({f"__d{i}": F.when(place.isNotNull(), F.col(f"__d{i}").cast("bigint") * sign) for i in range(4)})


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < float("inf"))


def exact_totals(rows: DataFrame, keys: Sequence[str], value: str, total: str, *more: Column) -> DataFrame:
    """One row per ``keys`` with the ``total`` of a column of doubles, and ``more`` sums or counts, summed too.

    First by key and size of the numbers, which have a few sizes a key, so hot keys collapse
    in the map tasks; then by key.  Up to 2^37 rows of a key in a task cannot overflow.
    """
    given = F.col(value).cast("double")
    names = [f"__m{i}" for i in range(len(more))]
    first = _in_pieces(rows.withColumn("__v", given), "__v").groupBy(*keys, "__place").agg(
        *[F.sum(f"__d{i}").cast(_VALUE).alias(f"__d{i}") for i in range(4)],
        F.count_if(F.isnan("__v")).alias("__nan"),
        F.count_if(F.col("__v") == float("inf")).alias("__plus"),
        F.count_if(F.col("__v") == float("-inf")).alias("__minus"),
        F.count("__v").alias("__n"),
        *[m.alias(n) for m, n in zip(more, names, strict=True)],
    )
    held = [
        F.struct((F.col("__place") - i).alias("place"), F.col(f"__d{i}").alias("value")) for i in range(4)
    ]
    digits = F.when(F.col("__place").isNull(), F.array().cast(_DIGITS)).otherwise(F.array(*held))
    # A number has at most 90 places, so has a list.
    joined = first.groupBy(*keys).agg(
        F.flatten(F.collect_list(digits)).alias("__digits"),
        *[F.sum(f"__{c}").alias(f"__{c}") for c in ("nan", "plus", "minus", "n")],
        *[F.sum(n).alias(n) for n in names],
    )
    return joined.select(
        *keys,
        F.struct(
            canonical(F.col("__digits")).alias("digits"), *[F.col(f"__{c}").alias(c) for c in ("nan", "plus", "minus", "n")]
        ).cast(TOTAL).alias(total),
        *names,
    )


def _swept(digits: Column) -> Column:
    """``out, carry``: one value a place, from 0 to 2^24 - 1 and from the lowest place up; what is left over is 0 or -1."""
    zero = F.lit(0).cast(_VALUE)
    base = F.lit(_BASE).cast(_VALUE)
    places = F.transform(digits, lambda d: d["place"])

    def step(state: Column, place: Column) -> Column:
        here = F.aggregate(F.filter(digits, lambda d: d["place"] == place), state["carry"], lambda a, d: (a + d["value"]).cast(_VALUE))
        # Lets, so that each is worked out once.
        parts = F.transform(F.array(here), lambda v: F.struct(v.alias("v"), F.pmod(v, base).cast(_VALUE).alias("m")))
        return F.transform(
            parts,
            lambda p: F.struct(
                F.concat(state["out"], F.array(F.struct(place.cast("int").alias("place"), p["m"].alias("value")))).alias("out"),
                ((p["v"] - p["m"]) / base).cast(_VALUE).alias("carry"),
            ),
        )[0]

    start = F.struct(F.array().cast(_DIGITS).alias("out"), zero.alias("carry"))
    # Digits of 62 bits reach three places further up.
    return F.aggregate(F.sequence(F.array_min(places), F.array_max(places) + 3), start, step)


def _negated(digits: Column) -> Column:
    return F.transform(digits, lambda d: F.struct(d["place"].alias("place"), (-d["value"]).cast(_VALUE).alias("value")))


def negated(total: str) -> Column:
    """A total that takes away what the given one adds, its counts included."""
    counts = [(-F.col(f"{total}.{c}")).alias(c) for c in ("nan", "plus", "minus", "n")]
    return F.struct(_negated(F.col(f"{total}.digits")).alias("digits"), *counts).cast(TOTAL)


def canonical(digits: Column) -> Column:
    """The same number with one value a place, none of them 0, all of its sign and below 2^24 in size.

    There is just one such form, so equal sums are equal columns.
    """
    none = F.array().cast(_DIGITS)

    def signed(swept: Column) -> Column:
        return F.when(swept["carry"] < 0, _negated(_swept(_negated(digits))["out"])).otherwise(swept["out"])

    found = F.transform(F.array(_swept(digits)), signed)[0]
    return F.when(F.size(digits) == 0, none).otherwise(F.filter(found, lambda d: d["value"] != 0))


def merged_totals(rows: DataFrame, keys: Sequence[str], total: str, *more: Column) -> DataFrame:
    """One row per ``keys``: the sum of the ``total`` of several rows, and ``more`` aggregates."""
    names = [f"__m{i}" for i in range(len(more))]
    taken = rows.select(
        *keys, F.col(f"{total}.*"), *[c for c in rows.columns if c not in keys and c != total],
    )
    sums = taken.groupBy(*keys).agg(
        F.flatten(F.collect_list("digits")).alias("__digits"),
        *[F.sum(c).alias(f"__{c}") for c in ("nan", "plus", "minus", "n")],
        *[m.alias(n) for m, n in zip(more, names, strict=True)],
    )
    return sums.select(
        *keys,
        F.struct(
            canonical(F.col("__digits")).alias("digits"), *[F.col(f"__{c}").alias(c) for c in ("nan", "plus", "minus", "n")]
        ).cast(TOTAL).alias(total),
        *names,
    )


def as_double(total: str | Column) -> Column:
    """The double nearest to a total; null for none, NaN and infinities as addition gives them."""
    total = F.col(total) if isinstance(total, str) else total
    # A let: the digits are worked out once.
    value = F.transform(F.array(total["digits"]), _nearest)[0]
    return (
        F.when(total["n"] == 0, F.lit(None).cast("double"))
        .when((total["nan"] > 0) | ((total["plus"] > 0) & (total["minus"] > 0)), F.lit(float("nan")))
        .when(total["plus"] > 0, F.lit(float("inf")))
        .when(total["minus"] > 0, F.lit(float("-inf")))
        .otherwise(value)
    )


def _nearest(digits: Column) -> Column:
    """The double nearest to canonical digits."""
    top = F.element_at(digits, -1)["place"]
    minus = F.element_at(digits, -1)["value"] < 0

    def at(back: int) -> Column:
        found = F.filter(digits, lambda d: d["place"] == top - back)
        return F.coalesce(F.abs(F.get(found, F.lit(0))["value"]), F.lit(0).cast(_VALUE))

    head = at(0)
    for back in (1, 2, 3):
        head = (head * F.lit(_BASE).cast("decimal(9,0)") + at(back)).cast(_VALUE)
    rest = F.exists(digits, lambda d: d["place"] < top - 3)  # anything below decides ties
    whole = (head * F.lit(2).cast("decimal(1,0)") + F.when(rest, F.lit(1)).otherwise(F.lit(0))).cast(_VALUE)
    # In two steps, as the power alone may lie beyond a double.
    power = (top - 3) * BITS - 1
    half = F.floor(power / 2)
    size = whole.cast("string").cast("double") * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)
    return F.when(F.size(digits) == 0, F.lit(0.0)).otherwise(F.when(minus, -size).otherwise(size))
