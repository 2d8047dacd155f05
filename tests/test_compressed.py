from veriledger.schemas import TRANSACTION_DDL
from veriledger.sources.feeds import write_feed
from veriledger.streaming.landing import _land_batch, land, land_rows, read_messages


def size_of(folder):
    return sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())


def test_compressed_messages_land_and_are_read(spark, tmp_path):
    landing, frame = str(tmp_path / "landing"), spark.createDataFrame([(str(i),) for i in range(40)], "value string").repartition(4)
    _land_batch(frame, landing, "s", 0, compressed=True)
    _land_batch(frame, landing, "s", 0, compressed=True)
    _land_batch(frame.limit(0), landing, "s", 1, compressed=True)
    files = sorted(p.name for p in (tmp_path / "landing").glob("stream-*"))
    assert files == [f"stream-s-batch-000000000-part-0000{i}.json.gz" for i in range(4)]
    assert sorted(int(r.value) for r in spark.read.text(landing).collect()) == list(range(40))


def test_landed_and_waiting_rows_take_little_room(spark, tmp_path):
    rows = spark.range(5000, numPartitions=2).selectExpr("concat('t', id) transaction_id", "'somebody' customer_id", "'a city' city")
    rows.selectExpr("to_json(struct(*)) value").write.text(str(tmp_path / "queue"))
    land(read_messages(spark, path=str(tmp_path / "queue")), str(tmp_path / "landing"), str(tmp_path / "check"), compressed=True).awaitTermination()
    land_rows(rows, str(tmp_path / "waiting"), "s", 0)
    assert max(size_of(tmp_path / "landing"), size_of(tmp_path / "waiting")) * 4 < size_of(tmp_path / "queue")
    for name in ("landing", "waiting"):
        assert spark.read.schema(TRANSACTION_DDL).json(str(tmp_path / name)).select("transaction_id").distinct().count() == 5000


def test_a_compressed_feed_is_read_as_it_was(spark, tmp_path):
    rows = spark.range(5000, numPartitions=2).selectExpr("concat('t', id) transaction_id", "cast(null as string) city")
    for name, compressed in (("plain", False), ("small", True)):
        write_feed(rows, str(tmp_path / name), compressed=compressed)
    assert size_of(tmp_path / "small") * 4 < size_of(tmp_path / "plain")
    assert sorted(spark.read.schema("transaction_id string, city string").json(str(tmp_path / "small")).collect()) == sorted(rows.collect())
