"""Every registered query against its SQL oracle, and the contract of the entry file."""

import pytest

from oracle_check import compare, connect, entry

from veriledger.plans.oracles import ORACLES
from veriledger.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    same, note = compare(spark, duck, SF, name)
    assert same, note


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == [
        "customer_id", "num_transactions", "total_amount", "average_transaction_amount",
    ]
    assert not frame.isEmpty()


@pytest.mark.parametrize("partitions", [1, 4, 200])
def test_same_answer_at_any_number_of_partitions(spark, duck, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        same, note = compare(spark, duck, SF, "transactions_per_customer")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert same, note
