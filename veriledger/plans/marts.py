"""The marts job: summaries of the valid rows of given runs, or of a lookback.

Each mart is a run table of partial results, one directory per run.  Reading a mart merges
the partials, so a key occurring in many runs comes out once, and a repeated run counts once.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.operators import marts
from veriledger.operators.cleaning import exact_amounts
from veriledger.operators.exact_sums import TOTAL
from veriledger.operators.rules import VALID
from veriledger.schemas import MONTHLY_DDL, PER_CUSTOMER_DDL, PER_MERCHANT_DDL, RUN_TABLE_DDL
from veriledger.session import pin_session
from veriledger.sources.run_tables import (
    attempts,
    manifests,
    read_attempts,
    read_lookback,
    read_runs,
    write_run,
)

log = logging.getLogger(__name__)

# The names of the three marts.
PER_CUSTOMER = "transactions_per_customer"
PER_MERCHANT = "transaction_per_merchant"
MONTHLY = "monthly_transactions"

_BUILDERS = {
    PER_CUSTOMER: marts.customer_partials,
    PER_MERCHANT: marts.transactions_per_merchant,
    MONTHLY: marts.monthly_transactions,
}
# Of each mart its key, how the key is made, and the names of its sum and average.
TOTALS = {
    PER_CUSTOMER: ("customer_id", "customer_id", "total_amount", "average_transaction_amount"),
    PER_MERCHANT: ("merchant_id", "merchant_id", "total_sales", None),
    MONTHLY: ("transaction_month", "month(timestamp)", "total_amount", None),
}
_MONEY = {"total_amount", "average_transaction_amount", "total_sales"}
_STORED = {
    PER_CUSTOMER: f"{PER_CUSTOMER_DDL}, num_amounts bigint, amounts {TOTAL}, run_id string",
    PER_MERCHANT: f"{PER_MERCHANT_DDL}, amounts {TOTAL}, run_id string",
    MONTHLY: f"{MONTHLY_DDL}, amounts {TOTAL}, run_id string",
}


def write_marts(
    valid: DataFrame, folder: str, run_id: str, exact: bool = False, source: str | None = None, reproducible: bool = False
) -> None:
    """The three marts of some valid rows, as one run; ``source`` names the attempt they sum up.

    With ``exact`` money is summed as decimals of cents, whatever the order of rows; NaN
    amounts are then left out instead of turning the sum to NaN.  With ``reproducible`` the
    partial results hold sums of doubles that do not depend on the order of addition, and
    so does what ``read_mart`` makes of them: the same bits however runs were partitioned
    and merged.

    Each is a scan of three or four columns of a Parquet table, cheaper than keeping the
    whole rows in memory for all of them.
    """
    if exact:
        valid = exact_amounts(valid)
    for name, build in _BUILDERS.items():
        mart = _reproducible(valid, name) if reproducible else build(valid)
        money = {c: F.col(c).cast("double") for c in mart.columns if c in _MONEY}
        path = write_run(mart.withColumns(money), f"{folder}/{name}", run_id, source=source)
        log.info("mart %s written to %s", name, path)


def _reproducible(valid: DataFrame, name: str) -> DataFrame:
    key, made, _, _ = TOTALS[name]
    totals = marts.amount_totals(valid.withColumn(key, F.expr(made)), key)
    return _with_totals(totals, name)


def _with_totals(totals: DataFrame, name: str) -> DataFrame:
    """The stored form of a mart: its doubles and what they were made of."""
    key, _, total, average = TOTALS[name]
    mart = marts.mart_of_totals(totals, key, total, average, keep=True)
    return mart.withColumn("num_amounts", F.col("amounts.n")) if name == PER_CUSTOMER else mart


def pending_runs(spark: SparkSession, table: str, folder: str) -> list[str]:
    """Finished runs of a judged table that are not in all three marts as they are now.

    A summary names the attempt it sums up, so a run that was written again is pending again.
    """
    pending = manifests(spark, table).select("run_id", "attempt")
    for name in _BUILDERS:
        done = manifests(spark, f"{folder}/{name}").select("run_id", F.col("source").alias("attempt"))
        done = done.withColumn(f"in_{name}", F.lit(True))
        pending = pending.join(done, ["run_id", "attempt"], "left")
    missing = " or ".join(f"in_{name} is null" for name in _BUILDERS)
    return sorted(r.run_id for r in pending.where(missing).select("run_id").collect())


def run_marts(
    spark: SparkSession,
    table: str,
    folder: str,
    run_ids: Sequence[str] | None = None,
    exact: bool = False,
    reproducible: bool = False,
) -> list[str]:
    """The marts of the named runs, or of all pending ones; one partial result per run.

    Whenever it is started, each run is summarised exactly once.  A run that is replaced
    while it is being summarised is summarised again.
    """
    pin_session(spark)
    if run_ids is None:
        run_ids = pending_runs(spark, table, folder)
    for run_id in run_ids:
        summarised = None
        while (found := attempts(spark, table, [run_id])) != summarised:
            if not found:
                raise ValueError(f"run {run_id} of {table} has not been written to its end")
            rows = read_attempts(spark, table, RUN_TABLE_DDL, found)
            write_marts(rows.where(F.col("verdict") == VALID), folder, run_id, exact, found[0][1], reproducible)
            summarised = found
    return list(run_ids)


def run_marts_lookback(
    spark: SparkSession,
    table: str,
    folder: str,
    run_id: str,
    now: datetime,
    hours: float = 6,
    exact: bool = False,
) -> None:
    """The marts of everything finished runs uploaded in the hours before ``now``.

    Overlapping lookbacks count rows twice and late ones miss rows; ``run_marts`` does not.
    """
    pin_session(spark)
    recent = read_lookback(spark, table, RUN_TABLE_DDL, now, hours)
    write_marts(recent.where(F.col("verdict") == VALID), folder, run_id, exact)


def compact_marts(spark: SparkSession, folder: str, into: str, reproducible: bool = False) -> None:
    """Merge the partial results of all runs into one run of each mart, in another folder.

    To go on from there: later runs are summarised beside it, and reading merges few partials.
    ``reproducible`` is for marts that were written so.
    """
    if into.rstrip("/") == folder.rstrip("/"):
        raise ValueError("marts cannot be compacted into themselves: they are read meanwhile")
    for name in _BUILDERS:
        mart = read_mart(spark, folder, name, partial=True, reproducible=reproducible)
        write_run(mart, f"{into}/{name}", "compacted")


def read_mart(
    spark: SparkSession, folder: str, name: str, partial: bool = False, reproducible: bool = False
) -> DataFrame:
    """A mart over all its runs, one row per key; ``partial`` keeps what a later merge needs.

    ``reproducible`` merges the totals of marts that were written so, and not their doubles.
    """
    partials = read_runs(spark, f"{folder}/{name}", _STORED[name])
    if reproducible:
        key, _, total, average = TOTALS[name]
        totals = marts.merge_amount_totals(partials, key)
        return _with_totals(totals, name) if partial else marts.mart_of_totals(totals, key, total, average)
    if name == PER_CUSTOMER:
        return marts.merge_customer_partials(partials, partial)
    if name == PER_MERCHANT:
        return marts.merge_totals(partials, "merchant_id", "total_sales")
    return marts.merge_totals(partials, "transaction_month", "total_amount")
