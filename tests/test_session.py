import uuid

import pytest

from veriledger.session import DEFAULTS, MIB, input_bytes, pin_session, shared_folder, size_session, sized_for

TIB = 1024**4


def test_task_sizes():
    small = sized_for(10 * MIB, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * MIB)
    medium = sized_for(TIB, cores=400)
    assert medium["spark.sql.shuffle.partitions"] == "8192"
    large = sized_for(100 * TIB, cores=4000)
    assert 99_000 < int(large["spark.sql.shuffle.partitions"]) <= 100_000
    assert int(large["spark.sql.files.maxPartitionBytes"]) > 1000 * MIB


def test_session_is_sized_by_its_inputs(spark, tmp_path):
    (tmp_path / "a" / "deep").mkdir(parents=True)
    (tmp_path / "a" / "deep" / "x").write_bytes(b"1" * 1000)
    (tmp_path / "ab").write_bytes(b"1" * 10)
    assert input_bytes(spark, str(tmp_path / "a")) == 1000
    assert input_bytes(spark, f"{tmp_path}/a*", f"{tmp_path}/none") == 1010
    before = {k: spark.conf.get(k, None) for k in sized_for(0, 1)}
    try:
        assert size_session(spark, str(tmp_path))["spark.sql.shuffle.partitions"] == str(
            2 * spark.sparkContext.defaultParallelism
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_shared_folder_is_the_one_the_cluster_names(spark, monkeypatch):
    folder = shared_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark, "x") != folder


def test_no_machine_local_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        shared_folder(Session, "x")
    Session.sparkContext.master = "local[2]"
    assert "x-" in shared_folder(Session, "x")


def test_settings_of_a_cluster_stay(spark):
    before = {k: spark.conf.get(k) for k in DEFAULTS}
    try:
        for key, (default, value) in DEFAULTS.items():
            for chosen, kept in ((default, value), ("12345678", "12345678")):
                spark.conf.set(key, chosen)
                assert pin_session(spark).conf.get(key).removesuffix("b") == kept.removesuffix("b")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_few_verdicts_are_written_without_a_sort(spark, tmp_path):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    try:
        rows = pin_session(spark).range(0, 1000, 1, 2).selectExpr("id", "concat('v', id % 4) verdict")
        name = f"sorted_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(name)
        spark.sql(f"create table {name}_t (id bigint, verdict string) using parquet partitioned by (verdict) location '{tmp_path}/t'")
        plan = spark.sql(f"explain insert into {name}_t select * from {name}").first()[0]
        assert "InsertIntoHadoopFsRelationCommand" in plan and "Sort" not in plan
        spark.sql(f"insert into {name}_t select * from {name}")
        assert sorted((r.verdict, r["count"]) for r in spark.table(f"{name}_t").groupBy("verdict").count().collect()) == [(f"v{i}", 250) for i in range(4)]
        spark.sql(f"drop table {name}_t")
    finally:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", before)
