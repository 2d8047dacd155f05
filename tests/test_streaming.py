from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import BASE, CASES, CUSTOMERS, MALFORMED, RUN_TIME, transactions, write_lines
from veriledger.plans import etl
from veriledger.schemas import RUN_TABLE_DDL, TRANSACTION_DDL
from veriledger.sources.run_tables import read_runs
from veriledger.streaming.bounded import dedup_stream, late_rows, window_totals
from veriledger.streaming.incremental import stream_customers, stream_transactions
from veriledger.streaming.landing import _land_batch, land, read_landed, read_messages


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_landing_keeps_each_message_once(spark, tmp_path):
    out, check = str(tmp_path / "landing"), str(tmp_path / "check")
    queue = tmp_path / "queue"
    for wave in (1, 2):
        write_lines(queue, [{**BASE, "transaction_id": f"t{wave}"}], name=f"{wave}.txt")
        finish(land(read_messages(spark, path=str(queue)), out, check))
        finish(land(read_messages(spark, path=str(queue)), out, check))
        got = spark.read.schema(TRANSACTION_DDL).json(out)
        assert {r.transaction_id for r in got.collect()} == {f"t{w}" for w in range(1, wave + 1)}
        assert got.count() == wave


def forget_commit(check, batch):
    """As after a crash between the write and the commit of a batch."""
    (check / "commits" / str(batch)).unlink()
    (check / "commits" / f".{batch}.crc").unlink(missing_ok=True)


def test_a_landed_batch_done_again_adds_nothing(spark, feed, tmp_path):
    feed.land_customers(CUSTOMERS, "c.json")
    queue, landing, check = tmp_path / "queue", tmp_path / "tx", tmp_path / "land-check"

    def land_all():
        finish(land(read_messages(spark, path=str(queue)), str(landing), str(check)))

    write_lines(queue, [{**BASE, "transaction_id": "t1"}], name="1.txt")
    land_all()
    feed.judge()
    forget_commit(check, 0)
    land_all()
    feed.judge()
    assert outcome(feed.table()) == [("t1", "valid")]
    # Deleted by its reader, it does not come back either.
    (file,) = landing.glob("*.json")
    file.unlink()
    forget_commit(check, 0)
    land_all()
    assert list(landing.glob("*.json")) == []


def test_a_batch_that_broke_off_while_landing_is_completed(spark, tmp_path):
    landing, frame = str(tmp_path / "landing"), spark.createDataFrame([(str(i),) for i in range(40)], "value string").repartition(4)
    _land_batch(frame, landing, "s", 3)
    files = sorted((tmp_path / "landing").glob("*.json"))
    assert len(files) == 4 and sorted(spark.read.text(landing).toPandas().value) == sorted(str(i) for i in range(40))
    # Back to the moment when two of the files had been moved and one of them had been deleted.
    aside = tmp_path / "landing" / "_landing" / "stream-s-batch-000000003"
    aside.mkdir()
    (aside / "_SUCCESS").touch()
    (aside.parent / f"{aside.name}.done").unlink()
    for number, file in enumerate(files[2:], 2):
        file.rename(aside / f"part-{number:05d}-x.txt")
    files[0].unlink()
    _land_batch(spark.createDataFrame([("never written",)], "value string"), landing, "s", 3)
    assert sorted((tmp_path / "landing").glob("*.json")) == files[1:]
    assert "never written" not in spark.read.text(landing).toPandas().value.tolist()
    assert [p.name for p in aside.parent.glob("*.done")] == ["stream-s-batch-000000003.done"]


@pytest.fixture
def feed(spark, tmp_path):
    ticks = iter(RUN_TIME + timedelta(minutes=i) for i in range(1000))

    class Feed:
        run = etl.EtlRun(
            run_id="", run_time=RUN_TIME, customers=None, transactions=str(tmp_path / "tx"),
            table=str(tmp_path / "judged"), currencies=["GEL", "USD", "EUR"],
            dimension=str(tmp_path / "dim"),
        )

        def clock(self):
            return next(ticks)

        def land_customers(self, records, name):
            write_lines(tmp_path / "cu", records, name=name)
            finish(stream_customers(
                spark, str(tmp_path / "cu"), self.run.dimension, str(tmp_path / "cu-check"), clock=self.clock
            ))

        def judge(self, clean=None, files_per_batch=None):
            finish(stream_transactions(
                spark, self.run, str(tmp_path / "tx-check"), clean, files_per_batch, self.clock
            ))

        def table(self):
            return read_runs(spark, self.run.table, RUN_TABLE_DDL)

    return Feed()


def outcome(frame):
    raw = F.coalesce("transaction_id", "_corrupt_record")
    return sorted((str(r[0]), r[1]) for r in frame.select(raw, "verdict").collect())


def test_two_waves_equal_the_batch_answer(spark, feed, tmp_path):
    rows = transactions()
    feed.land_customers(CUSTOMERS, "c.json")
    write_lines(tmp_path / "tx", rows[:10], name="1.json")
    feed.judge()
    write_lines(tmp_path / "tx", rows[10:], MALFORMED, name="2.json")
    feed.judge()
    feed.judge()  # restarted without new files
    expected = [(str(n), v) for n, _, v in CASES] + [(m, "malformed") for m in MALFORMED]
    assert outcome(feed.table()) == sorted(expected)
    ids = sorted({r.run_id for r in feed.table().collect()})
    assert [i[-10:] for i in ids] == ["-000000000", "-000000001"]
    assert len({i[:-10] for i in ids}) == 1


def test_a_renewed_checkpoint_and_a_second_feed_replace_nothing(spark, feed, tmp_path):
    feed.land_customers(CUSTOMERS, "c.json")
    write_lines(tmp_path / "tx", [{**BASE, "transaction_id": "a"}], name="1.json")
    feed.judge()
    write_lines(tmp_path / "other", [{**BASE, "transaction_id": "b"}], name="1.json")
    other = replace(feed.run, transactions=str(tmp_path / "other"))
    finish(stream_transactions(spark, other, str(tmp_path / "other-check"), clock=feed.clock))
    assert outcome(feed.table()) == [("a", "valid"), ("b", "valid")]
    finish(stream_transactions(spark, feed.run, str(tmp_path / "renewed"), clock=feed.clock))
    assert outcome(feed.table()) == [("a", "valid"), ("a", "valid"), ("b", "valid")]


def test_landed_files_go_once_they_are_judged(spark, feed, tmp_path):
    feed.land_customers(CUSTOMERS, "c.json")
    queue, landing = tmp_path / "queue", tmp_path / "tx"
    for wave in range(3):
        write_lines(queue, [{**BASE, "transaction_id": f"t{wave}"}], name=f"{wave}.txt")
        finish(land(read_messages(spark, path=str(queue)), str(landing), str(tmp_path / "land-check")))
        feed.judge(clean="delete")
    left = [p for p in landing.glob("*.json") if p.stat().st_size]
    assert len(left) == 1
    assert outcome(feed.table()) == [(f"t{i}", "valid") for i in range(3)]


def test_a_judging_stream_can_archive(spark, feed, tmp_path):
    feed.land_customers(CUSTOMERS, "c.json")
    for wave in range(3):
        write_lines(tmp_path / "tx", [{**BASE, "transaction_id": f"t{wave}"}], name=f"{wave}.json")
        finish(stream_transactions(
            spark, feed.run, str(tmp_path / "tx-check"), "archive", None, feed.clock, str(tmp_path / "archive")
        ))
    assert list((tmp_path / "archive").rglob("0.json"))
    assert outcome(feed.table()) == [(f"t{i}", "valid") for i in range(3)]
    with pytest.raises(ValueError):
        read_landed(spark, str(tmp_path / "tx"), TRANSACTION_DDL, "archive")


def test_several_batches_in_one_start(spark, feed, tmp_path):
    feed.land_customers(CUSTOMERS, "c.json")
    for i in range(3):
        write_lines(tmp_path / "tx", [{**BASE, "transaction_id": f"t{i}"}], name=f"{i}.json")
    feed.judge(files_per_batch=1)
    assert feed.table().select("run_id").distinct().count() == 3
    assert outcome(feed.table()) == [(f"t{i}", "valid") for i in range(3)]


def test_a_batch_done_again_counts_once(spark, feed, tmp_path):
    feed.land_customers(CUSTOMERS, "c.json")
    write_lines(tmp_path / "tx", transactions(), name="1.json")
    feed.judge()
    before = outcome(feed.table())
    forget_commit(tmp_path / "tx-check", 0)
    feed.judge()
    assert outcome(feed.table()) == before


def test_copies_in_later_batches_can_be_skipped(spark, feed, tmp_path):
    feed.run = replace(feed.run, skip_seen_hours=1)
    feed.land_customers(CUSTOMERS, "c.json")
    for wave, ids in enumerate((["a", "b"], ["b", "c"], ["a", "d"])):
        rows = [{**BASE, "transaction_id": i} for i in ids]
        write_lines(tmp_path / "tx", rows, name=f"{wave}.json")
        feed.judge()
    assert outcome(feed.table()) == [(i, "valid") for i in "abcd"]


def test_customers_of_an_earlier_wave_are_known(spark, feed, tmp_path):
    feed.land_customers([{"customer_id": "c1", "age": 30}], "1.json")
    feed.land_customers([{"customer_id": "c1", "age": 13}, {"customer_id": "c2", "age": 20}], "2.json")
    rows = [{**BASE, "transaction_id": "a"}, {**BASE, "transaction_id": "b", "customer_id": "c2"}]
    write_lines(tmp_path / "tx", rows, name="1.json")
    feed.judge()
    assert outcome(feed.table()) == [("a", "invalid"), ("b", "valid")]


def test_finished_files_are_deleted_a_run_later(spark, feed, tmp_path):
    feed.land_customers(CUSTOMERS, "c.json")
    folder = tmp_path / "tx"
    for wave in range(3):
        write_lines(folder, [{**BASE, "transaction_id": f"t{wave}"}], name=f"{wave}.json")
        feed.judge(clean="delete")
    left = {p.name for p in folder.glob("*.json")}
    assert "0.json" not in left and "2.json" in left
    assert outcome(feed.table()) == [(f"t{i}", "valid") for i in range(3)]


def test_finished_files_can_be_archived(spark, tmp_path):
    out = str(tmp_path / "out")
    for wave in range(3):
        write_lines(tmp_path / "in", [{**BASE, "transaction_id": f"t{wave}"}], name=f"{wave}.json")
        stream = read_landed(spark, str(tmp_path / "in"), TRANSACTION_DDL, "archive", 1, str(tmp_path / "archive"))
        finish(
            stream.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        )
    assert list((tmp_path / "archive").rglob("0.json"))
    assert spark.read.parquet(out).count() == 3


def start_to_parquet(frame, tmp_path):
    return (
        frame.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True)
        .start()
    )


@pytest.mark.parametrize("salts", [1, 4])
def test_stream_dedup_across_batches(spark, tmp_path, salts):
    schema = "id string, ts timestamp, n int"
    waves = [
        [("a", "2024-01-01 00:00:00", 1), ("b", "2024-01-01 00:01:00", 1), ("a", "2024-01-01 00:02:00", 2)],
        [("a", "2024-01-01 00:30:00", 3), ("c", "2024-01-01 00:31:00", 1)],
    ]
    for i, wave in enumerate(waves):
        records = [dict(zip(("id", "ts", "n"), r)) for r in wave]
        write_lines(tmp_path / "in", records, name=f"{i}.json")
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        finish(start_to_parquet(dedup_stream(stream, "id", "ts", "1 hour", salts), tmp_path))
        got = spark.read.parquet(str(tmp_path / "out"))
        assert sorted(r.id for r in got.collect()) == (["a", "b"], ["a", "b", "c"])[i]


def test_a_hot_key_of_a_stream_is_thinned_out_first(spark, tmp_path):
    rows = [{"id": "hot" if i % 3 == 0 else f"k{i}", "ts": "2024-01-01 00:00:00"} for i in range(3000)]
    write_lines(tmp_path / "in", rows)
    stream = spark.readStream.schema("id string, ts timestamp").json(str(tmp_path / "in"))
    query = start_to_parquet(dedup_stream(stream, "id", "ts", "1 hour", salts=4), tmp_path)
    finish(query)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2001
    progress = next(p for p in query.recentProgress if p["numInputRows"])
    by_key, by_share = (o["numRowsUpdated"] for o in progress["stateOperators"])
    assert by_share == 2004 and by_key == 2001


def test_late_rows_are_counted(spark, tmp_path):
    schema, dropped = "id string, ts timestamp", 0
    for i, (key, hour) in enumerate([("a", "10"), ("b", "12"), ("late", "03")]):
        write_lines(tmp_path / "in", [{"id": key, "ts": f"2024-01-01 {hour}:00:00"}], name=f"{i}.json")
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        query = start_to_parquet(dedup_stream(stream, "id", "ts", "1 hour"), tmp_path)
        finish(query)
        dropped += late_rows(query)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    assert dropped == 1


def test_stream_windows_come_out_when_complete(spark, tmp_path):
    schema = "transaction_id string, amount double, upload_time timestamp"

    def at(hour, amount):
        moment = datetime(2024, 1, 1) + timedelta(hours=hour)
        return {"transaction_id": "t", "amount": amount, "upload_time": str(moment)}

    waves = [[at(1, 1.0), at(5, 2.0)], [at(7, 4.0), at(5.5, 8.0)], [at(14, 16.0)], [at(40, 32.0)]]
    for i, wave in enumerate(waves):
        write_lines(tmp_path / "in", wave, name=f"{i}.json")
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        finish(start_to_parquet(window_totals(stream, "1 hour"), tmp_path))
    got = {r.window_start.hour: (r.num_transactions, r.total_amount) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {0: (3, 11.0), 6: (1, 4.0), 12: (1, 16.0)}
