"""Joins of the feed with customers and with reference tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriledger.schemas import RAW_LINE
from veriledger.session import shared_folder

# More than there are partitions.
_SHARES = 1 << 16


def keyed_join(
    left: DataFrame, right: DataFrame, key: str, how: str, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Equi-join on ``key`` that stays parallel when one key holds much of ``left``.

    ``right`` has usually just been reduced to one row per key, so it is already
    partitioned by the key and a plain join would reuse that.  AQE can split a hot
    partition only if both inputs are plain shuffles, so the reuse would put a hot key
    in one task.  A second equi-key, a hash of the first, asks for a fresh shuffle on
    both sides; AQE then splits hot partitions by their measured sizes.  A later
    grouping by the key pre-aggregates before its own shuffle.

    Rows of ``left`` with a NULL key match nothing, but outer and anti joins keep them;
    their hash is taken over ``spread_by`` instead, which scatters them over all
    partitions.  Neither side is broadcast by hint: Spark does so while the size it knows
    or has measured is below its threshold, and shuffles beyond.
    """
    def number(*columns: Column) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(_SHARES)).cast("int")

    one, other = left.alias("__one"), right.alias("__other")
    mine, theirs = F.col(f"__one.`{key}`"), F.col(f"__other.`{key}`")
    spread = number(mine)
    if spread_by:
        spread = F.when(mine.isNull(), number(*[F.col(f"__one.`{c}`") for c in spread_by])).otherwise(spread)
    # The number is a part of the condition and no column: it is worked out where rows are dealt, and not shuffled.
    joined = one.join(other, (mine == theirs) & (spread == number(theirs)), how)
    more = [] if how in ("left_semi", "left_anti") else [F.col(f"__other.`{c}`") for c in right.columns if c != key]
    return joined.select(mine, *[F.col(f"__one.`{c}`") for c in left.columns if c != key], *more)


def with_customers(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions with the columns of their customer; others drop out."""
    return keyed_join(transactions, customers, "customer_id", "inner")


def _identity(transactions: DataFrame) -> list[str]:
    """What tells transactions apart, unreadable lines included."""
    return [c for c in ("transaction_id", RAW_LINE) if c in transactions.columns]


def with_known_customers(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """All transactions, with the columns of their customer where there is one."""
    return keyed_join(transactions, customers, "customer_id", "left", _identity(transactions))


def orphans(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions whose customer is NULL or not known.

    The ids that are not known are found and written first, without the rows that have them.  Spark
    broadcasts them while they are few, and the transactions are not shuffled; else it joins as usual.
    """
    spark = transactions.sparkSession
    asked = transactions.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
    path = shared_folder(spark, "unknown-customers")
    keyed_join(asked, customers.select("customer_id"), "customer_id", "left_anti").write.parquet(path)
    unknown = spark.read.schema(asked.schema).parquet(path).withColumn("__unknown", F.lit(True))
    marked = keyed_join(transactions, unknown, "customer_id", "left", _identity(transactions))
    return marked.where(F.col("customer_id").isNull() | F.col("__unknown")).drop("__unknown")


def in_reference(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is one of the codes."""
    reference = codes.select(F.col(codes.columns[0]).alias(column)).distinct()
    return keyed_join(df, reference, column, "left_semi")


def flag_member(
    df: DataFrame,
    codes: DataFrame | Sequence[str],
    column: str,
    flag: str,
    spread_by: Sequence[str],
) -> DataFrame:
    """Add ``flag``: is ``column`` one of the codes, with the truth values of SQL ``IN``.

    An empty code list gives false for every row.  A NULL value gives NULL, and so does
    a value without match if the list itself holds a NULL.

    Codes given as a table are joined and never collected; a literal list is an ``IN``.
    """
    if not isinstance(codes, DataFrame):
        return df.withColumn(flag, F.col(column).isin(list(codes)))
    name = codes.columns[0]
    summary = codes.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col(name).isNull()).alias("nulls"))
    ).scalar()
    reference = (
        codes.where(F.col(name).isNotNull())
        .select(F.col(name).alias(column))
        .distinct()
        .withColumn("__member", F.lit(True))
    )
    undecided = F.col(column).isNull() | (F.col("__list").nulls > 0)
    return (
        keyed_join(df, reference, column, "left", spread_by)
        .withColumn("__list", summary)
        .withColumn(
            flag,
            F.when(F.col("__member"), True)
            .when(F.col("__list").n == 0, False)
            .when(undecided, F.lit(None).cast("boolean"))
            .otherwise(False),
        )
        .select(*df.columns, flag)
    )


def flag_currency(transactions: DataFrame, codes: DataFrame | Sequence[str]) -> DataFrame:
    """Add ``currency_ok`` for the currency rule."""
    return flag_member(transactions, codes, "currency", "currency_ok", _identity(transactions))
