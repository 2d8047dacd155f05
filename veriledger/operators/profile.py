"""Profiles of judged rows by sketches, which add up over runs.

Per verdict: the number of rows, a HyperLogLog sketch of the customers, a KLL sketch of the
amounts and the frequent items of the merchants.  A sketch has some kilobytes whatever it
covers, is made in the map tasks, and that of several runs is merged from theirs without
reading a row again.  NULL and NaN amounts are no part of the quantiles, NULL customers not
of their number; NULL is a merchant like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Standard error of the number of customers: 1.04 / sqrt(2^12), 1.6 %.
HLL_BITS = 12
# Ranks of amounts are off by some 1.3 % at most, in 99 of 100 cases.
KLL_SIZE = 200
# A merchant with more than some 0.5 % of the rows of a verdict is among the items tracked.
ITEMS = 1000

PROFILE_DDL = (
    "verdict string, num_rows bigint, customers binary, amounts binary, "
    "merchants struct<sketch:binary,maxItemsTracked:int,itemDataType:string,itemDataTypeDDL:string>"
)


def profile_of(judged: DataFrame) -> DataFrame:
    """The profile of each verdict."""
    return judged.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.hll_sketch_agg("customer_id", HLL_BITS).alias("customers"),
        F.kll_sketch_agg_double(F.col("amount").cast("double"), KLL_SIZE).alias("amounts"),
        F.expr(f"approx_top_k_accumulate(merchant_id, {ITEMS})").alias("merchants"),
    )


def merged_profiles(profiles: DataFrame, *by: str) -> DataFrame:
    """The profile of each verdict over several runs, or of each group of them ``by`` further columns."""
    return profiles.groupBy(*by, "verdict").agg(
        F.sum("num_rows").alias("num_rows"),
        F.hll_union_agg("customers").alias("customers"),
        F.kll_merge_agg_double("amounts").alias("amounts"),
        F.expr("approx_top_k_combine(merchants)").alias("merchants"),
    )


def quantile(amounts: str | Column, share: float) -> Column:
    """The amount below which a share of the amounts lies; NULL if there are none."""
    known = F.kll_sketch_get_n_double(amounts) > 0
    return F.when(known, F.kll_sketch_get_quantile_double(amounts, F.lit(float(share))))


def rank(amounts: str | Column, value: Column) -> Column:
    """The share of the amounts up to a value, to a hundredth; NULL if there are none.

    A sketch tells the rank of constants only, so the value is looked up among its percentiles.
    """
    shares = F.array(*[F.lit(i / 100) for i in range(1, 101)])
    known = (F.kll_sketch_get_n_double(amounts) > 0) & value.isNotNull()
    percentiles = F.kll_sketch_get_quantile_double(amounts, shares)
    return F.when(known, F.size(F.filter(percentiles, lambda p: p <= value)) / 100)


def described(profiles: DataFrame, quantiles: Sequence[float] = (0.01, 0.25, 0.5, 0.75, 0.99), top: int = 10) -> DataFrame:
    """Profiles in figures: customers, quantiles of amounts, and the most frequent merchants with their counts."""
    return profiles.withColumns(
        {
            "customers": F.hll_sketch_estimate("customers"),
            "amounts": F.array(*[quantile("amounts", q) for q in quantiles]),
            "merchants": F.expr(f"approx_top_k_estimate(merchants, {top})"),
        }
    )


def compared(now: DataFrame, before: DataFrame) -> DataFrame:
    """Each verdict of a run beside what came before: its share of the rows, and where its median amount lay then.

    A ``median_rank_before`` far from 0.5 says that amounts have moved.  Verdicts that only one
    side has are there too.
    """

    def part(profiles: DataFrame, suffix: str) -> DataFrame:
        total = profiles.agg(F.sum("num_rows")).scalar()
        return profiles.select(
            "verdict",
            F.col("num_rows").alias(f"num_rows{suffix}"),
            (F.col("num_rows") / total).alias(f"share{suffix}"),
            F.hll_sketch_estimate("customers").alias(f"customers{suffix}"),
            quantile("amounts", 0.5).alias(f"median{suffix}"),
            F.col("amounts").alias(f"__amounts{suffix}"),
        )

    both = part(now, "").join(part(before, "_before"), "verdict", "full_outer")
    return both.withColumn("median_rank_before", rank("__amounts_before", F.col("median"))).drop("__amounts", "__amounts_before")
