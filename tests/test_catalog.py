import pytest

from veriledger.sources.catalog import append_rows, ensure_namespace, ensure_table


def test_namespace(spark):
    assert ensure_namespace(spark, "ledger_ns") is False
    assert ensure_namespace(spark, "ledger_ns") is True


@pytest.mark.parametrize("granularity,column", [("HOUR", "upload_hour"), ("DAY", "upload_day")])
def test_time_partitioned_table(spark, granularity, column):
    ensure_namespace(spark, "ledger_t")
    name = f"ledger_t.by_{granularity.lower()}"
    ddl = "id string, upload_time timestamp"
    assert ensure_table(spark, name, ddl, "upload_time", granularity) is False
    assert ensure_table(spark, name, ddl, "upload_time", granularity) is True
    frame = spark.sql("select timestamp'2024-01-01 10:20:30' as upload_time, 'a' as id")
    append_rows(frame, name)
    append_rows(frame, name)
    stored = spark.table(name)
    assert stored.columns == ["id", "upload_time", column]
    start = {"HOUR": "2024-01-01 10:00:00", "DAY": "2024-01-01 00:00:00"}[granularity]
    assert [str(r[column]) for r in stored.collect()] == [start] * 2
    assert [r.partition for r in spark.sql(f"show partitions {name}").collect()] != []


def test_other_granularity_gives_a_plain_table(spark):
    ensure_namespace(spark, "ledger_t")
    ensure_table(spark, "ledger_t.plain", "id string, upload_time timestamp", "upload_time", "MONTH")
    append_rows(spark.sql("select timestamp'2024-01-01' as upload_time, 'a' as id"), "ledger_t.plain")
    assert spark.table("ledger_t.plain").columns == ["id", "upload_time"]
    assert spark.table("ledger_t.plain").count() == 1


def test_failed_append_is_raised(spark):
    ensure_namespace(spark, "ledger_t")
    ensure_table(spark, "ledger_t.strict", "id string, n int")
    with pytest.raises(Exception):
        append_rows(spark.sql("select 'a' as id"), "ledger_t.strict")
    with pytest.raises(Exception):
        append_rows(spark.sql("select 'a' as id"), "ledger_t.absent")
