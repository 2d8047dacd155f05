import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fixtures import BASE, write_lines
from veriledger.schemas import CUSTOMER_COLUMNS, RAW_LINE, TRANSACTION_COLUMNS
from veriledger.sources.feeds import (
    read_currencies,
    read_customers,
    read_feed,
    read_transactions,
    read_transactions_with_raw,
    write_feed,
)


def test_reads_all_depths_under_declared_schema(spark, tmp_path):
    write_lines(tmp_path / "tx", [{**BASE, "transaction_id": "a"}])
    write_lines(tmp_path / "tx" / "2024" / "03", [{**BASE, "transaction_id": "b"}])
    frame = read_transactions(spark, str(tmp_path / "tx"))
    assert frame.columns == TRANSACTION_COLUMNS
    assert all(field.nullable for field in frame.schema)
    assert {r.transaction_id for r in frame.collect()} == {"a", "b"}


def test_prefix_takes_in_sibling_folders(spark, tmp_path):
    write_lines(tmp_path / "customers", [{"customer_id": "a"}])
    write_lines(tmp_path / "customers_2", [{"customer_id": "b"}])
    path = str(tmp_path / "customers")
    assert read_customers(spark, path).count() == 1
    assert read_customers(spark, path, prefix=True).count() == 2
    assert read_customers(spark, path + "/", prefix=True).count() == 1


@pytest.mark.parametrize("exists", [True, False])
def test_no_files_is_an_empty_frame(spark, tmp_path, exists):
    folder = tmp_path / "none"
    if exists:
        folder.mkdir()
    frame = read_customers(spark, str(folder))
    assert frame.columns == CUSTOMER_COLUMNS
    assert frame.isEmpty()
    assert read_customers(spark, str(folder), prefix=True).isEmpty()


def test_other_read_errors_are_raised(spark, tmp_path):
    path = write_lines(tmp_path / "tx", [{"a": "x"}])
    with pytest.raises(AnalysisException):
        read_feed(spark, path, "a string, a string").collect()


def test_values_that_do_not_fit_become_null(spark, tmp_path):
    rows = [
        {**BASE, "transaction_id": "quoted", "amount": "12.5"},
        {**BASE, "transaction_id": "nan", "amount": "NaN"},
        {**BASE, "transaction_id": "time", "timestamp": "bad ts"},
        {**BASE, "transaction_id": "ok", "amount": 10.1},
    ]
    path = write_lines(tmp_path / "tx", rows)
    got = {r.transaction_id: r for r in read_transactions(spark, path).collect()}
    assert got["quoted"].amount is None and got["quoted"].currency == "GEL"
    assert math.isnan(got["nan"].amount)
    assert got["time"].timestamp is None and got["time"].amount == 10.0
    assert str(got["ok"].timestamp) == "2024-03-01 10:00:00"


def test_only_unreadable_lines_keep_their_raw_text(spark, tmp_path):
    rows = [{**BASE, "transaction_id": "quoted", "amount": "12.5"}]
    path = write_lines(tmp_path / "tx", rows, ["{broken", "{broken too"])
    frame = read_transactions_with_raw(spark, path)
    raw = {r.transaction_id: r[RAW_LINE] for r in frame.where("transaction_id is not null").collect()}
    assert raw == {"quoted": None}
    lines = frame.where(F.col(RAW_LINE).isNotNull()).collect()
    assert {r[RAW_LINE] for r in lines} == {"{broken", "{broken too"}


def test_currency_table_by_path_and_by_name(spark, tmp_path):
    codes = spark.sql("select * from values ('GEL', 1), ('USD', 2) as t(currency_code, rank)")
    codes.write.parquet(str(tmp_path / "codes"))
    codes.createOrReplaceTempView("codes_view")
    for source in (str(tmp_path / "codes"), "codes_view"):
        frame = read_currencies(spark, source)
        assert frame.columns == ["currency_code"]
        assert {r.currency_code for r in frame.collect()} == {"GEL", "USD"}


def test_written_feed_reads_back(spark, tmp_path):
    rows = [{**BASE, "transaction_id": "a"}, {**BASE, "transaction_id": None, "amount": None}]
    frame = read_transactions(spark, write_lines(tmp_path / "in", rows))
    write_feed(frame, str(tmp_path / "out"))
    again = read_transactions(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, frame.collect()))
