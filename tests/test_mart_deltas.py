"""Marts kept by deltas: the bits of one sum over the rows that count, whatever was repeated."""

import json
import math
from datetime import datetime, timedelta

import pytest

from test_exact_sums import bits
from veriledger.plans.mart_deltas import _live, keep_marts, read_kept_mart
from veriledger.plans.marts import MONTHLY, PER_CUSTOMER, PER_MERCHANT
from veriledger.sources.run_tables import prune_attempts, write_run

COLUMNS = (
    "transaction_id string, customer_id string, merchant_id string, amount double, timestamp timestamp,"
    " verdict string, upload_hour timestamp"
)
HOUR = datetime(2024, 3, 1, 12)
# Of each mart its key as a number of a row's field, and whether it has an average.
MARTS = {PER_CUSTOMER: (1, True), PER_MERCHANT: (2, False), MONTHLY: (4, False)}


def row(number, customer, amount, merchant="m", month=1, verdict="valid"):
    return (f"t{number}", customer, merchant, amount, datetime(2024, month, 5), verdict, HOUR)


class Ledger:
    def __init__(self, spark, root):
        self.spark, self.table, self.folder, self.runs = spark, str(root / "judged"), str(root / "marts"), {}

    def write(self, run_id, rows):
        self.runs[run_id] = rows
        write_run(self.spark.createDataFrame(rows, COLUMNS), self.table, run_id, ["verdict", "upload_hour"])

    def keep(self, fan=2):
        return keep_marts(self.spark, self.table, self.folder, fan)

    def check(self):
        for name, (field, averaged) in MARTS.items():
            groups = {}
            for r in (r for rows in self.runs.values() for r in rows if r[5] == "valid"):
                key = r[4].month if name == MONTHLY else r[field]
                groups.setdefault(key, []).append(r)
            want = {}
            for key, rows in groups.items():
                amounts = [r[3] for r in rows if r[3] is not None]
                total = None if not amounts else math.nan if any(map(math.isnan, amounts)) else math.fsum(amounts)
                want[key] = (sum(r[0] is not None for r in rows), bits(total))
                if averaged:
                    want[key] += (bits(None if total is None else total / len(amounts)),)
            got = {}
            for r in read_kept_mart(self.spark, self.folder, name).collect():
                assert r[0] not in got
                got[r[0]] = (r[1], *map(bits, r[2:]))
            assert got == want, name


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, tmp_path)


def test_repeated_runs_leave_no_trace(ledger):
    ledger.write("a", [row(1, "x", 1e16), row(2, "x", 0.1), row(3, "gone", 5.0), row(4, None, 2.5, None, 2)])
    ledger.write("b", [row(5, "x", -1e16), row(6, "y", math.nan, month=3), row(7, "z", None), row(8, "x", 9.0, verdict="invalid")])
    assert ledger.keep() == ["a", "b"]
    ledger.check()
    assert ledger.keep() == []
    # After their deltas were merged: NaN, a large number and a customer go, others come.
    ledger.write("b", [row(5, "x", -0.3), row(6, "y", 1.5, month=3)])
    assert ledger.keep() == ["b"]
    ledger.check()
    ledger.write("a", [row(1, "x", 0.7, "other"), row(9, "new", 0.1)])
    ledger.write("c", [row(10, "y", 0.2)])
    assert ledger.keep() == ["a", "c"]
    ledger.check()
    ledger.write("a", [])
    ledger.keep()
    ledger.check()


def test_many_runs_are_few_deltas(spark, ledger):
    for number in range(7):
        ledger.write(f"r{number:02d}", [row(number, f"c{number % 3}", number + 0.1)])
    assert len(ledger.keep(fan=3)) == 7
    for name in MARTS:
        assert len(_live(spark, f"{ledger.folder}/{name}")[0]) < 3 * 2
    ledger.check()
    # What retractions need is kept when the rest is pruned.
    prune_attempts(spark, f"{ledger.folder}/{PER_CUSTOMER}", timedelta(0))
    ledger.check()
    ledger.write("r04", [row(4, "c9", 0.25)])
    ledger.keep(fan=3)
    ledger.check()


def test_a_merge_that_broke_off_counts_once(spark, ledger, tmp_path):
    ledger.write("a", [row(1, "x", 0.1)])
    ledger.write("b", [row(2, "x", 0.2)])
    ledger.keep()
    # As after a crash between the merged delta and the retirement of its members.
    for file in (tmp_path / "marts").glob("*/_manifests/run-*.json"):
        manifest = json.loads(file.read_text())
        if manifest["merged_into"]:
            file.write_text(json.dumps({**manifest, "merged_into": None}))
    ledger.check()
    assert ledger.keep() == []
    ledger.check()
    assert len(_live(spark, f"{ledger.folder}/{MONTHLY}")[0]) == 1


def test_no_runs_and_odd_fans(spark, ledger):
    assert ledger.keep() == []
    assert read_kept_mart(spark, ledger.folder, PER_CUSTOMER).collect() == []
    with pytest.raises(ValueError):
        ledger.keep(fan=1)
