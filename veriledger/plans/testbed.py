"""The canonical feeds derived from the star-schema test tables.

The test tables hold no NULLs, duplicates of customers or strangers, so the mappings put
them in arithmetically.  The text runs unchanged on Spark and on the oracle engine; both
read whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veriledger.session import pin_session

# The currencies of the tests.
CODES = ["GEL", "USD", "EUR"]

# Events as transactions: every event has a customer, ids are unique.
EVENT_TRANSACTIONS = """
    select cast(event_id as string) as transaction_id,
           cast(user_id as string) as customer_id,
           case when event_id % 50 = 0 then null
                when event_type = 'click' then 'GEL'
                when event_type = 'view' then 'EUR'
                when event_type = 'purchase' then 'USD'
                else event_type end as currency,
           case when event_id % 97 = 0 then null else value end as amount,
           value as total_amount,
           ts as upload_time
    from {events}
"""

EVENT_CUSTOMERS = """
    select cast(c_custkey as string) as customer_id,
           case when c_custkey % 41 = 0 then null else cast(c_custkey % 110 as int) end as age,
           c_mktsegment as job
    from {customer}
"""

# Order lines as transactions, all 13 columns: a quarter of the ids occur more than once.
LINE_TRANSACTIONS = """
    select case when l.l_partkey % 50 = 0 then null
                when l.l_returnflag = 'A' then 'GEL'
                when l.l_returnflag = 'N' then 'EUR'
                when l.l_linestatus = 'F' then 'USD'
                else 'ZZZ' end as currency,
           case when l.l_partkey % 211 = 0 then null
                when l.l_partkey % 223 = 0 then 'NaN'
                else concat(cast(l.l_orderkey as string), '-',
                            cast(l.l_linenumber as string)) end as transaction_id,
           case when l.l_partkey % 193 = 0 then null else l.l_shipdate end as timestamp,
           case when l.l_partkey % 97 = 0 then null
                when l.l_partkey % 89 = 0 then cast(0.25 as double)
                else l.l_extendedprice end as amount,
           l.l_extendedprice + l.l_quantity as total_amount,
           case when o.o_orderstatus = 'F' then 'completed'
                when o.o_orderstatus = 'O' then 'pending'
                else 'failed' end as status,
           case when o.o_custkey % 31 = 0 then null
                when o.o_custkey % 37 = 0 then 'NaN'
                when o.o_custkey % 29 = 0 then concat('gone-', cast(o.o_custkey as string))
                else cast(o.o_custkey as string) end as customer_id,
           case when l.l_suppkey % 37 = 0 then null
                else cast(l.l_suppkey as string) end as merchant_id,
           case when l.l_partkey % 5 = 0 then null
                when l.l_partkey % 7 = 0 then ''
                else concat('city-', cast(l.l_suppkey % 10 as string)) end as city,
           case when l.l_linenumber % 3 = 0 then 'card'
                when l.l_linenumber % 3 = 1 then 'bank_transfer'
                else 'cash' end as deposit_method,
           l.l_linenumber % 2 = 0 as installment,
           case when l.l_linenumber % 2 = 0 then l.l_quantity
                else cast(0 as double) end as installment_amount,
           case when l.l_linenumber % 2 = 0 then l.l_discount
                else cast(0 as double) end as bank_interest
    from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
"""

# Customers with all 15 columns, each of them twice with different balances; some without a
# usable id.
LINE_CUSTOMERS = """
    select case when c_custkey % 37 = 0 then 'NaN'
                else cast(c_custkey as string) end as customer_id,
           case when c_custkey % 41 = 0 then null else cast(c_custkey % 110 as int) end as age,
           c_name as fullname,
           case when c_custkey % 6 = 0 then null
                when c_custkey % 7 = 0 then ''
                else c_mktsegment end as job,
           case when c_custkey % 4 = 0 then null
                when c_custkey % 4 = 1 then 'single'
                when c_custkey % 4 = 2 then 'married'
                else 'divorced' end as marital,
           c_acctbal + copy_no as balance,
           case when c_custkey % 3 = 0 then null
                when c_custkey % 3 = 1 then 'yes'
                else 'no' end as housing,
           c_custkey % 2 = 0 as loan,
           concat('tel-', cast(c_custkey as string)) as contact,
           case when c_custkey % 5 = 0 then 'male'
                when c_custkey % 5 = 1 then 'female'
                when c_custkey % 5 = 2 then 'other'
                when c_custkey % 5 = 3 then 'Male'
                else null end as gender,
           cast(300 + c_custkey % 551 as int) as credit_score,
           cast(c_nationkey as string) as geography,
           cast(1 + c_custkey % 5 as int) as number_of_products,
           cast(1 + c_custkey % 10 as int) as tenure,
           cast(c_custkey % 4 as int) as loan_number
    from (select *, 0 as copy_no from {customer}
          union all
          select *, 1 as copy_no from {customer}) c
"""

# Shipping times as text, some of it malformed.
SHIP_TEXTS = """
    select l_orderkey, l_linenumber,
           case when l_partkey % 13 = 0 then 'bad ts'
                when l_partkey % 17 = 0 then null
                when l_partkey % 19 = 0 then '1999-13-01 00:00:00'
                else cast(l_shipdate as string) end as text
    from {lineitem}
"""

# The same with a NaN among the amounts here and there.
DIRTY_TRANSACTIONS = LINE_TRANSACTIONS.replace(
    "else l.l_extendedprice end as amount",
    "when l.l_partkey % 181 = 0 then cast('NaN' as double) else l.l_extendedprice end as amount",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return pin_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    """One of the mappings above over the tables of a folder."""
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(spark, sf_dir, EVENT_TRANSACTIONS, "events")


def event_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(spark, sf_dir, EVENT_CUSTOMERS, "customer")


def line_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(spark, sf_dir, LINE_TRANSACTIONS, "lineitem", "orders")


def line_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(spark, sf_dir, LINE_CUSTOMERS, "customer")


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(spark, sf_dir, DIRTY_TRANSACTIONS, "lineitem", "orders")


def code_table(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{c}')" for c in CODES)
    return spark.sql(f"select * from values {rows} as codes(currency_code)")
