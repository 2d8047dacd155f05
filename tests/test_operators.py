import pytest
from pyspark.sql import functions as F

from veriledger.functions.text import parse_timestamp
from veriledger.operators import cleaning, dedup, dimension, joins, marts

TX = "transaction_id string, customer_id string, amount double, city string"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("partitions", [1, 4, 200])
def test_one_row_per_key_whatever_the_partitioning(spark, partitions):
    data = [("a", "x", 2.0, None), ("a", "x", 1.0, "q"), ("a", "x", 1.0, None), ("b", "y", None, "c"),
            ("b", "y", 0.0, "a"), (None, "z", 5.0, "s"), (None, "z", 4.0, "s")]
    frame = spark.createDataFrame(data * 3, TX).repartition(partitions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = rows(dedup.keep_smallest(frame, ["transaction_id"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == sorted(
        [("a", "x", 1.0, None), ("b", "y", None, "c"), (None, "z", 4.0, "s")], key=str
    )


def test_survivor_is_a_whole_row(spark):
    frame = spark.createDataFrame([("a", "z", 1.0, "p"), ("a", "b", 2.0, "q")], TX)
    assert rows(dedup.keep_smallest(frame, ["transaction_id"])) == [("a", "b", 2.0, "q")]


def test_distinct_when_all_columns_are_keys(spark):
    frame = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert dedup.keep_smallest(frame, ["k"]).count() == 2


def test_keep_latest(spark):
    frame = spark.sql(
        "select * from values ('a', 1, 'old'), ('a', 2, 'new'), ('a', 2, null), ('b', null, 'x')"
        " as t(k, v, w)"
    )
    assert rows(dedup.keep_latest(frame, ["k"], ["v"])) == [("a", 2, "new"), ("b", None, "x")]


def test_drop_seen_keeps_null_keys(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 3)], "k string, n int")
    seen = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(dedup.drop_seen(frame, seen, "k")) == [("b", 2), (None, 3), (None, 3)]


def test_join_collapses_key_and_drops_strangers(spark):
    tx = spark.createDataFrame([("t1", "a", 1.0, ""), ("t2", "q", 1.0, ""), ("t3", None, 1.0, "")], TX)
    cu = spark.createDataFrame([("a", 30), (None, 40)], "customer_id string, age int")
    joined = joins.with_customers(tx, cu)
    assert joined.columns == ["customer_id", "transaction_id", "amount", "city", "age"]
    assert [r.transaction_id for r in joined.collect()] == ["t1"]
    assert {r.transaction_id for r in joins.orphans(tx, cu).collect()} == {"t2", "t3"}
    everyone = joins.with_known_customers(tx, cu)
    assert {r.transaction_id: r.age for r in everyone.collect()} == {"t1": 30, "t2": None, "t3": None}


def test_reference_semi_join(spark):
    frame = spark.createDataFrame([("GEL",), ("GEL",), ("ZZZ",), (None,)], "currency string")
    codes = spark.createDataFrame([("GEL",), ("GEL",), (None,)], "currency_code string")
    assert rows(joins.in_reference(frame, codes, "currency")) == [("GEL",), ("GEL",)]


def test_cleaning(spark):
    cu = spark.createDataFrame(
        [(None, "", None, "Male"), ("j", "h", "m", "female"), ("j", "h", "m", None)],
        "job string, housing string, marital string, gender string",
    )
    assert rows(cleaning.clean_customers(cu)) == sorted(
        [("unknown", "", "unknown", "unknown"), ("j", "h", "m", "female"), ("j", "h", "m", "unknown")]
    )
    tx = spark.createDataFrame(
        [(10.1, None, None), (None, 2.0, "")], "amount float, total_amount float, city string"
    )
    cleaned = cleaning.clean_transactions(tx)
    assert dict(cleaned.dtypes)["amount"] == "double"
    assert rows(cleaned) == sorted(
        [(10.100000381469727, None, "unknown"), (None, 2.0, "")], key=str
    )
    exact = cleaning.exact_amounts(cleaned).agg(F.sum("amount").cast("string")).first()[0]
    assert exact == "10.10"


def test_parse_timestamp(spark):
    texts = [("2024-03-01 10:00:00",), ("bad ts",), ("2024-13-01 00:00:00",), (None,)]
    frame = spark.createDataFrame(texts, "t string")
    got = [r.p for r in frame.select(parse_timestamp(F.col("t")).alias("p")).collect()]
    assert str(got[0]) == "2024-03-01 10:00:00" and got[1:] == [None, None, None]


VALID = """
    select * from values
      ('t1', 'a', 'm', timestamp'2023-12-31 23:59:59', 1.0D),
      ('t2', 'a', 'm', timestamp'2024-01-01 00:00:00', 2.0D),
      (null, 'a', null, timestamp'2023-01-31 23:59:59', 4.0D),
      ('t4', 'b', null, timestamp'2023-02-01 00:00:00', 8.0D),
      ('t5', 'b', 'n', null, 16.0D)
    as t(transaction_id, customer_id, merchant_id, timestamp, amount)
"""


def test_marts(spark):
    valid = spark.sql(VALID)
    assert rows(marts.transactions_per_customer(valid)) == [("a", 2, 7.0, 7 / 3), ("b", 2, 24.0, 12.0)]
    assert rows(marts.transactions_per_merchant(valid)) == [("m", 2, 3.0), ("n", 1, 16.0), (None, 1, 12.0)]
    assert rows(marts.monthly_transactions(valid)) == [(1, 1, 6.0), (12, 1, 1.0), (2, 1, 8.0), (None, 1, 16.0)]
    by_year = {str(r.month_start): r.total_amount for r in marts.monthly_transactions_by_year(valid).collect()}
    assert by_year["2024-01-01 00:00:00"] == 2.0 and by_year["2023-01-01 00:00:00"] == 4.0


def test_nan_amount_spreads_and_null_is_skipped(spark):
    valid = spark.sql(
        "select * from values ('t1', 'a', double('NaN')), ('t2', 'a', 1D), ('t3', 'b', 1D), ('t4', 'b', null)"
        " as t(transaction_id, customer_id, amount)"
    )
    got = {r.customer_id: tuple(r)[1:] for r in marts.transactions_per_customer(valid).collect()}
    assert str(got["a"]) == "(2, nan, nan)" and got["b"] == (2, 1.0, 1.0)


def test_merged_marts_equal_the_mart_of_the_whole(spark):
    valid = spark.sql(VALID)
    halves = [valid.where("amount < 3"), valid.where("amount >= 3")]
    merged = marts.merge_customer_partials(
        marts.customer_partials(halves[0]).union(marts.customer_partials(halves[1]))
    )
    assert rows(merged) == rows(marts.transactions_per_customer(valid))
    partials = [marts.transactions_per_merchant(h) for h in halves]
    merged = marts.merge_totals(partials[0].union(partials[1]), "merchant_id", "total_sales")
    assert rows(merged) == rows(marts.transactions_per_merchant(valid))


def test_upload_windows(spark):
    frame = spark.sql(
        "select * from values ('a', 1D, timestamp'2024-01-01 05:59:59'), ('b', 2D, timestamp'2024-01-01 06:00:00')"
        " as t(transaction_id, amount, upload_time)"
    )
    got = [(str(a), str(b), n, s) for a, b, n, s in rows(marts.by_upload_window(frame))]
    assert got == [
        ("2024-01-01 00:00:00", "2024-01-01 06:00:00", 1, 1.0),
        ("2024-01-01 06:00:00", "2024-01-01 12:00:00", 1, 2.0),
    ]


def test_dimension_keeps_the_newest_version(spark):
    first = spark.createDataFrame([("a", 1), ("b", 2), (None, 9)], "customer_id string, age int")
    second = spark.createDataFrame([("a", 3)], "customer_id string, age int")
    versions = dimension.as_versions(first, "2024-01-01 00:00:00").union(
        dimension.as_versions(second, "2024-01-02 00:00:00")
    )
    assert rows(dimension.latest_customers(versions)) == [("a", 3), ("b", 2)]
