"""Cleaning of the two feeds before they are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.functions.text import within_domain
from veriledger.schemas import RAW_LINE

# The stand-in for missing text, the filled columns, the gender domain.
UNKNOWN = "unknown"
FILLED_IN_TRANSACTIONS = ["city"]
FILLED_IN_CUSTOMERS = ["job", "housing", "marital"]
GENDERS = ["male", "female", "other"]


def widen_amounts(transactions: DataFrame) -> DataFrame:
    """Money columns as double."""
    return transactions.withColumns(
        {c: F.col(c).cast("double") for c in ("amount", "total_amount")}
    )


def exact_amounts(transactions: DataFrame, places: int = 2) -> DataFrame:
    """Money columns as decimals, so that sums do not depend on the order of rows.

    Amounts are rounded to ``places`` places *before* they are summed: that undoes the
    artefacts of a float feed, in which 10.1 reads as 10.100000381, and is wrong for feeds
    with finer amounts.  NaN, infinite and amounts of over 10^28 have no such decimal and
    become NULL.
    """
    return transactions.withColumns(
        {c: F.col(c).try_cast(f"decimal({28 + places},{places})") for c in ("amount", "total_amount")}
    )


def fill_transactions(transactions: DataFrame) -> DataFrame:
    """NULL city becomes 'unknown'; empty text stays."""
    return transactions.fillna(UNKNOWN, subset=FILLED_IN_TRANSACTIONS)


def fill_customers(customers: DataFrame) -> DataFrame:
    """NULL job, housing and marital become 'unknown'; empty text stays."""
    return customers.fillna(UNKNOWN, subset=FILLED_IN_CUSTOMERS)


def normalize_gender(customers: DataFrame) -> DataFrame:
    """Anything outside the gender domain, NULL too, becomes 'unknown'."""
    return customers.withColumn("gender", within_domain(F.col("gender"), GENDERS, UNKNOWN))


def clean_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.transform(widen_amounts).transform(fill_transactions)


def clean_customers(customers: DataFrame) -> DataFrame:
    return customers.transform(fill_customers).transform(normalize_gender)


def mark_malformed(feed: DataFrame) -> DataFrame:
    """Keep the raw line only where nothing at all could be read from it.

    The reader also fills the raw line for a row with one badly typed field.  Such a row
    goes on with a NULL in that field.
    """
    fields = [F.col(c).cast("string") for c in feed.columns if c != RAW_LINE]
    return feed.withColumn(RAW_LINE, F.when(F.coalesce(*fields).isNull(), F.col(RAW_LINE)))
