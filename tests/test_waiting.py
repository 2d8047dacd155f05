"""Orphans that wait for their customer."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import BASE, RUN_TIME, write_lines
from veriledger.plans import etl
from veriledger.schemas import CUSTOMER_DDL, RUN_TABLE_DDL
from veriledger.sources import dimension_table
from veriledger.sources.run_tables import read_runs
from veriledger.streaming import incremental
from veriledger.streaming.bounded import late_rows
from veriledger.streaming.incremental import stream_customers, stream_orphans, stream_transactions


class Flow:
    """The three streams over folders of one test, with a clock that the test sets."""

    def __init__(self, spark, root):
        self.spark, self.root, self.now, self.files = spark, root, RUN_TIME, 0
        self.run = etl.EtlRun(
            run_id="", run_time=RUN_TIME, customers=None, transactions=str(root / "tx"), table=str(root / "judged"),
            currencies=["GEL"], dimension=str(root / "dim"),
        )

    def clock(self):
        return self.now

    def land(self, name, records):
        self.files += 1
        write_lines(self.root / name, records, name=f"{self.files}.json")

    def customers(self, *ids, age=30):
        if ids:
            self.land("cu", [{"customer_id": i, "age": age} for i in ids])
        self._finish(stream_customers(
            self.spark, str(self.root / "cu"), self.run.dimension, str(self.root / "cu-check"), clock=self.clock,
            arrivals=str(self.root / "arrivals"),
        ))

    def judge(self, *pairs):
        if pairs:
            self.land("tx", [{**BASE, "transaction_id": t, "customer_id": c} for t, c in pairs])
        self._finish(stream_transactions(
            self.spark, self.run, str(self.root / "tx-check"), clock=self.clock, waiting=str(self.root / "waiting")
        ))

    def look(self, **options):
        return self._finish(stream_orphans(
            self.spark, self.run, str(self.root / "waiting"), str(self.root / "arrivals"), str(self.root / "wait-check"),
            wait="2 hours", clock=self.clock, **options,
        ))

    def _finish(self, query):
        query.awaitTermination()
        assert query.exception() is None
        return query

    def rows(self):
        table = read_runs(self.spark, self.run.table, RUN_TABLE_DDL)
        return sorted((r.transaction_id, r.verdict) for r in table.select("transaction_id", "verdict").collect())

    def forget_commit(self, check, batch):
        (self.root / check / "commits" / str(batch)).unlink()
        (self.root / check / "commits" / f".{batch}.crc").unlink(missing_ok=True)


@pytest.fixture
def flow(spark, tmp_path):
    return Flow(spark, tmp_path)


def state_rows(query):
    (last, *_) = [p for p in reversed(query.recentProgress) if p["stateOperators"]]
    return sum(o["numRowsTotal"] for o in last["stateOperators"])


def test_a_customer_one_batch_late(flow):
    flow.customers("c0")
    flow.judge(("t0", "c0"), ("t1", "late"), ("t2", "late"), ("t3", "never"), ("t4", None))
    flow.look()
    first = [("t0", "valid"), ("t1", "orphan"), ("t2", "orphan"), ("t3", "orphan"), ("t4", "orphan")]
    assert flow.rows() == first
    flow.now += timedelta(minutes=30)
    flow.customers("late")
    flow.look()
    assert flow.rows() == sorted([*first, ("t1", "valid"), ("t2", "valid")])
    # Announced again, and looked for again: nothing is judged twice.
    flow.now += timedelta(minutes=30)
    flow.customers("late", age=5)
    flow.look()
    flow.look()
    assert flow.rows() == sorted([*first, ("t1", "valid"), ("t2", "valid")])


def test_a_customer_who_came_while_the_feed_was_judged(flow):
    flow.judge(("t1", "c1"))
    flow.now -= timedelta(minutes=30)
    flow.customers("c1")
    flow.look()
    assert flow.rows() == [("t1", "orphan"), ("t1", "valid")]


def test_state_is_dropped_after_the_time_and_the_last_look_is_at_the_dimension(flow):
    flow.judge(("t1", "old"), ("t2", "never"))
    # In the dimension, but without an announcement in time.
    flow.now -= timedelta(days=2)
    flow.customers("old")
    flow.now += timedelta(days=2)
    assert state_rows(flow.look()) > 0
    before = flow.rows()
    assert before == [("t1", "orphan"), ("t2", "orphan")]
    flow.now += timedelta(days=1)
    flow.judge(("t9", None))
    flow.judge(("t8", "other"))
    flow.customers("x")
    flow.look()
    assert ("t1", "valid") in flow.rows()
    assert [r for r in flow.rows() if r[0] == "t2"] == [("t2", "orphan")]
    # A day later all that is left are the rows of this day.
    flow.now += timedelta(days=1)
    flow.judge(("t7", "other"))
    flow.customers("y")
    shares = 8
    assert state_rows(flow.look()) <= 1 + shares + 2
    flow.customers("never")
    flow.look()
    assert [r for r in flow.rows() if r[0] == "t2"] == [("t2", "orphan")]


def test_batches_done_again_judge_nothing_twice(flow):
    flow.judge(("t1", "c1"), ("t2", "c2"))
    flow.customers("c1")
    # The batch is repeated after its orphans began to wait: it must not find c1 now.
    flow.forget_commit("tx-check", 0)
    flow.judge()
    flow.look()
    expected = [("t1", "orphan"), ("t1", "valid"), ("t2", "orphan")]
    assert flow.rows() == expected
    flow.forget_commit("wait-check", 0)
    flow.look()
    flow.forget_commit("cu-check", 0)
    flow.customers()
    flow.look()
    assert flow.rows() == expected


def test_a_repeat_before_the_orphans_wait_judges_anew(flow):
    flow.judge(("t1", "c1"))
    for file in (flow.root / "waiting").rglob("*"):
        if file.is_file():
            file.unlink()
    flow.customers("c1")
    flow.forget_commit("tx-check", 0)
    flow.judge()
    flow.look()
    assert flow.rows() == [("t1", "valid")]


def test_many_wait_for_one_customer_in_several_tasks(flow):
    flow.judge(*[(f"t{i:03d}", "hot") for i in range(400)])
    flow.look()
    flow.customers("hot")
    query = flow.look(salts=8)
    judged = read_runs(flow.spark, flow.run.table, RUN_TABLE_DDL).where("verdict = 'valid'")
    assert judged.select(F.count_distinct("transaction_id"), F.count("*")).first() == (400, 400)
    assert late_rows(query) == 0


def test_orphans_too_late_are_counted(flow):
    flow.judge(("t1", "a"))
    flow.customers("b")
    flow.look()
    flow.now += timedelta(days=3)
    flow.judge(("t2", "a"))
    flow.customers("c")
    flow.look()
    flow.now -= timedelta(days=3)
    flow.judge(("t0", "z"))
    assert late_rows(flow.look()) >= 1


def test_a_batch_that_is_larger_than_the_dimension_is_read_once(flow, monkeypatch):
    asked = []
    monkeypatch.setattr(incremental, "read_dimension", lambda *a: asked.append(a[2]) or dimension_table.read_dimension(*a))
    flow.customers(*[f"c{i}" for i in range(300)])
    flow.judge(("small", "c1"))
    flow.judge(*[(f"t{i}", f"c{i % 400}") for i in range(4000)])
    flow.customers(*[f"c{i}" for i in range(300, 350)])
    flow.look()
    assert asked[0] is not None and asked[1] is None
    rows = flow.rows()
    assert len(rows) == len(set(rows)) == 1 + 4000 + 500
    assert [rows.count(("t399", v)) for v in ("valid", "orphan")] == [0, 1]
    assert [rows.count(("t300", v)) for v in ("valid", "orphan")] == [1, 1]


def test_what_a_feed_asks_of_a_dimension(spark, tmp_path):
    customers = spark.range(2000).selectExpr("cast(id as string) customer_id", *[f"cast(null as {kind}) {name}" for name, kind in map(str.split, CUSTOMER_DDL.split(",")[1:])])
    folder = str(tmp_path / "dim")
    dimension_table.write_customer_versions(customers, folder, "one", RUN_TIME)
    for name, n in (("few", 1), ("many", 60_000)):
        spark.range(n).selectExpr("cast(id % 3000 as string) customer_id", "uuid() transaction_id").write.parquet(str(tmp_path / name))
    few, many = (spark.read.parquet(str(tmp_path / name)) for name in ("few", "many"))
    assert dimension_table.asked_of(spark, folder, many) is None
    assert [r.customer_id for r in dimension_table.asked_of(spark, folder, few).collect()] == ["0"]
    assert dimension_table.read_dimension(spark, folder, None).count() == 2000
