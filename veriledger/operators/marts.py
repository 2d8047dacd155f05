"""The summaries of valid transactions, and how summaries of several runs add up.

``num_transactions`` counts non-NULL ids, while sums and averages run over non-NULL
amounts, whatever the status or currency.  All are partial aggregates, so a customer or
merchant holding much of the data collapses in the map tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriledger.operators.exact_sums import as_double, exact_totals, merged_totals


def _count_ids() -> Column:
    return F.count("transaction_id").alias("num_transactions")


def transactions_per_customer(valid: DataFrame) -> DataFrame:
    return valid.groupBy("customer_id").agg(
        _count_ids(),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("average_transaction_amount"),
    )


def transactions_per_merchant(valid: DataFrame) -> DataFrame:
    """NULL merchants form a group of their own."""
    return valid.groupBy("merchant_id").agg(_count_ids(), F.sum("amount").alias("total_sales"))


def monthly_transactions(valid: DataFrame) -> DataFrame:
    """By month number: the same month of different years is one group."""
    return valid.groupBy(F.month("timestamp").alias("transaction_month")).agg(
        _count_ids(), F.sum("amount").alias("total_amount")
    )


def monthly_transactions_by_year(valid: DataFrame) -> DataFrame:
    """By calendar month."""
    return valid.groupBy(F.date_trunc("month", "timestamp").alias("month_start")).agg(
        _count_ids(), F.sum("amount").alias("total_amount")
    )


def by_upload_window(valid: DataFrame, hours: int = 6) -> DataFrame:
    """Totals per fixed upload window; works on batches and on streams.

    Unlike a lookback from "now", fixed windows neither overlap nor leave gaps, however
    late or often a run is started.
    """
    return (
        valid.groupBy(F.window("upload_time", f"{hours} hours"))
        .agg(_count_ids(), F.sum("amount").alias("total_amount"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "num_transactions",
            "total_amount",
        )
    )


def customer_partials(valid: DataFrame, *by: str) -> DataFrame:
    """The customer mart plus the number of amounts, which merging averages needs.

    Valid rows may lack an id, so ``num_transactions`` is not that number.  Further columns
    ``by`` keep partials apart, say those of several runs in one pass.
    """
    return valid.groupBy(*by, "customer_id").agg(
        _count_ids(),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("average_transaction_amount"),
        F.count("amount").alias("num_amounts"),
    )


def merge_customer_partials(partials: DataFrame, partial: bool = False) -> DataFrame:
    """One row per customer over the partial marts of several runs.

    With ``partial`` the number of amounts stays, so that the result can be merged again.
    """
    total, amounts = F.sum("total_amount"), F.sum("num_amounts")
    return partials.groupBy("customer_id").agg(
        F.sum("num_transactions").alias("num_transactions"),
        total.alias("total_amount"),
        F.when(amounts > 0, total / amounts).alias("average_transaction_amount"),
        *([amounts.alias("num_amounts")] if partial else []),
    )


def merge_totals(partials: DataFrame, key: str, total: str) -> DataFrame:
    """One row per key over partial marts that hold a count and a sum."""
    return partials.groupBy(key).agg(
        F.sum("num_transactions").alias("num_transactions"), F.sum(total).alias(total)
    )


def amount_totals(valid: DataFrame, *keys: str) -> DataFrame:
    """``num_transactions`` and the ``amounts`` of each key, as a total that is the same in any order of addition."""
    totals = exact_totals(valid, keys, "amount", "amounts", F.count("transaction_id"))
    return totals.withColumnRenamed("__m0", "num_transactions")


def merge_amount_totals(totals: DataFrame, *keys: str) -> DataFrame:
    """One row per key over the totals of several runs, as if made of all their rows."""
    merged = merged_totals(totals.select(*keys, "num_transactions", "amounts"), keys, "amounts", F.sum("num_transactions"))
    return merged.withColumnRenamed("__m0", "num_transactions")


def mart_of_totals(
    totals: DataFrame, key: str, total: str, average: str | None = None, keep: bool = False
) -> DataFrame:
    """A mart from totals: the doubles nearest to them, and the average over the amounts; ``keep`` leaves the totals beside."""
    worth = totals.select(key, "num_transactions", as_double("amounts").alias(total), "amounts")
    n = F.col("amounts.n")
    more = [F.when(n > 0, F.col(total) / n).alias(average)] if average else []
    return worth.select(key, "num_transactions", total, *more, *(["amounts"] if keep else []))
