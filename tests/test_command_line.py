import json

import pytest

from veriledger.__main__ import main
from veriledger.plans.mart_deltas import read_kept_mart
from veriledger.plans.marts import PER_CUSTOMER, read_mart


def test_generate_judge_summarise_delete(spark, tmp_path, capsys):
    def call(*argv):
        main([str(a) for a in argv])
        return json.loads(capsys.readouterr().out.splitlines()[-1])

    feed, table, marts = tmp_path / "feed", tmp_path / "judged", tmp_path / "marts"
    call("generate", "--out", feed, "--customers", 20, "--transactions", 300)
    etl = ["etl", "--customers", feed / "customers", "--transactions", feed / "transactions",
           "--table", table, "--run-time", "2024-05-06T13:00:00"]
    report = call(*etl, "--currencies", "GEL,EUR,USD")
    assert (report["run_id"], report["valid"]) == ("20240506T120000", 300)

    spark.sql("select * from values ('GEL') as t(currency_code)").write.parquet(str(tmp_path / "codes"))
    assert call(*etl, "--currencies", "GEL,EUR,USD")["valid"] == 0  # no new files
    report = call(*etl, "--currency-path", tmp_path / "codes", "--run-id", "only-gel")
    assert 0 < report["valid"] < 300 and report["valid"] + report["invalid"] == 300

    def total(folder):
        mart = read_mart(spark, str(folder), PER_CUSTOMER)
        return mart.selectExpr("sum(num_transactions)").first()[0]

    base = ["marts", "--table", table, "--marts"]
    assert call(*base, marts, "--run-id", "20240506T120000") == {"runs": ["20240506T120000"]}
    assert total(marts) == 300
    assert call(*base, marts) == {"runs": ["only-gel"]}
    assert total(marts) == 300 + report["valid"]
    assert call(*base, tmp_path / "kept", "--deltas") == {"runs": ["20240506T120000", "only-gel"]}
    kept = read_kept_mart(spark, str(tmp_path / "kept"), PER_CUSTOMER)
    assert kept.selectExpr("sum(num_transactions)").first()[0] == total(marts)
    with pytest.raises(SystemExit):
        call(*base, tmp_path / "kept", "--deltas", "--exact")
    look = tmp_path / "look"
    call(*base, look, "--run-time", "2024-05-06T14:00:00", "--lookback-hours", 6)
    assert total(look) == 300 + report["valid"]

    assert call(*etl, "--currencies", "GEL", "--run-id", "one-code")["valid"] == report["valid"]
    assert call(*base, tmp_path / "exact", "--exact", "--run-id", "one-code") == {"runs": ["one-code"]}

    # New files in the same slot: a run of its own over these alone.
    call("generate", "--out", feed, "--customers", 20, "--transactions", 100)
    other = call(*etl, "--currencies", "GEL,EUR,USD")
    assert (other["run_id"], other["valid"]) == ("20240506T120000-2", 100)

    call("compact", "--marts", marts, "--into", tmp_path / "compact")
    assert total(tmp_path / "compact") == total(marts)
    assert call("prune", "--table", table) == {"deleted": 0}

    call("generate", "--out", feed, "--customers", 20, "--transactions", 50)
    assert call("delete", "--feed", feed / "transactions", "--read-by", table)["deleted"] > 0
    last = call(*etl, "--currencies", "GEL,EUR,USD", "--dimension", tmp_path / "dim", "--run-id", "last")
    assert last["valid"] == 50
    again = call("orphans", "--table", table, "--dimension", tmp_path / "dim", "--currencies", "GEL")
    assert again["valid"] == again["orphan"] == 0
    call("compact", "--dimension", tmp_path / "dim", "--into", tmp_path / "small")

    assert call("delete", "--feed", feed / "trans") == {"deleted": 0}
    assert call("delete", "--prefix", feed / "trans") == {"deleted": 1}
    assert [p.name for p in feed.iterdir()] == ["customers"]
