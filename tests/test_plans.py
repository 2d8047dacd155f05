"""What the physical plans must and must not contain, and hot keys at work."""

import pytest
from pyspark.sql import functions as F

from veriledger.operators import dedup, dimension, joins, marts, rules
from veriledger.plans import etl, registry
from veriledger.schemas import CUSTOMER_DDL, RAW_LINE, TRANSACTION_COLUMNS, TRANSACTION_DDL, with_raw_line
from veriledger.sources.run_tables import read_runs, write_run

SF = "/root/testdata/sf0.001"
LAZY = [n for n in registry.QUERIES if not n.startswith(("stored_", "stream_", "resent_"))]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def executed(frame):
    frame.collect()
    return plan_of(frame)


def shuffled_records(frame):
    """Records written by all shuffles of an executed query."""
    frame.collect()

    def total(node):
        name = node.nodeName()
        metric = node.metrics().get("shuffleRecordsWritten")
        children = [node.children().apply(i) for i in range(node.children().size())]
        if name.startswith("AdaptiveSparkPlan"):
            children.append(node.executedPlan())
        elif "QueryStage" in name:
            children.append(node.plan())
        written = metric.get().value() if metric.isDefined() and name.startswith("Exchange") else 0
        return written + sum(total(c) for c in children)

    return total(frame._jdf.queryExecution().executedPlan())


@pytest.fixture
def conf(spark):
    changed = {}

    def put(**settings):
        for key, value in settings.items():
            key = "spark.sql." + key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(registry.QUERIES[name](spark, SF))
    for operator in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "InPandas", "Cartesian", "NestedLoop"):
        assert operator not in plan


def test_group_limit_runs_before_the_shuffle(spark):
    plan = plan_of(registry.dedup_transactions(spark, SF))
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan and "Final" in plan


def test_copies_of_a_hot_key_collapse_before_the_shuffle(spark):
    rows = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 3 = 0, null, id) as k", "id % 10 as v")
    kept = dedup.keep_smallest(rows, ["k"])
    # 133 333 plain keys and the NULL one, which at most eight tasks pass on once each.
    assert kept.count() == 133_334
    assert shuffled_records(kept) == 133_333 + 8


def test_a_judged_row_is_shuffled_with_its_id_once_and_without_helpers(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", adaptive__enabled="false")

    def dealt(node):
        """The columns of each shuffle, inputs first."""
        below = [x for i in range(node.children().size()) for x in dealt(node.children().apply(i))]
        columns = [node.output().apply(i).name() for i in range(node.output().size())]
        return [*below, columns] if node.nodeName() == "Exchange" else below

    frame = registry.line_classified(spark, SF)
    rows = [columns for columns in dealt(frame._jdf.queryExecution().executedPlan()) if "merchant_id" in columns]
    for_duplicates, for_customers = rows
    assert "__key" in for_duplicates and "transaction_id" not in for_duplicates
    assert "transaction_id" in for_customers and not [c for c in for_customers if c.startswith("__")]


def test_ids_come_out_of_the_key_as_they_were(spark):
    ids = ["", "i", "i1", "l1", "\u00e4\u4e2d", " id ", None]
    fields = {**dict.fromkeys(TRANSACTION_COLUMNS), "currency": "GEL", "amount": 1.0, "total_amount": 1.0}
    rows = [{**fields, "transaction_id": i, RAW_LINE: None} for i in [*ids, *ids]]
    rows += [{**fields, "transaction_id": "own", RAW_LINE: "{"}, {**fields, RAW_LINE: "i1"}]
    feed = spark.createDataFrame([tuple(r.values()) for r in rows], with_raw_line(TRANSACTION_DDL))
    customers = spark.createDataFrame([], CUSTOMER_DDL)
    judged = etl.classified(feed, customers, ["GEL"], rules.default_rules()).collect()
    found = {(r.transaction_id, r[RAW_LINE], r.verdict) for r in judged}
    assert len(judged) == len(ids) + 2
    assert found == {(i, None, "orphan") for i in ids} | {("own", "{", "malformed"), (None, "i1", "malformed")}


def test_ids_seen_are_dropped_without_another_shuffle_of_the_feed(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    feed = spark.range(1000).selectExpr("cast(id as string) as transaction_id", "id as amount")
    seen = spark.range(10).selectExpr("cast(id as string) as transaction_id")
    plan = plan_of(dedup.drop_seen(dedup.keep_smallest(feed, ["transaction_id"]), seen, "transaction_id"))
    assert "LeftAnti" in plan and plan.count("Exchange") == 2


def test_consolidated_marts_read_the_feed_once(spark, conf):
    conf(adaptive__enabled="false")
    one = plan_of(registry.transactions_per_customer(spark, SF)).count("row_number()")
    assert plan_of(registry.consolidate_marts(spark, SF)).count("row_number()") == one


def test_few_ids_reach_the_versions_before_a_shuffle(spark, conf):
    conf(adaptive__enabled="false")
    versions = spark.range(5000).selectExpr(
        "cast(id as string) as customer_id", "30 as age", "timestamp '2024-01-01' as loaded_at"
    )
    needed = versions.select("customer_id").limit(7)
    plan = plan_of(dimension.latest_customers(versions, needed))
    assert "BroadcastHashJoin" in plan
    assert dimension.latest_customers(versions, needed).count() == 7


def test_a_lookback_by_name_reads_only_its_hours(spark):
    plan = plan_of(registry.stored_lookback_by_name(spark, SF))
    assert "PartitionFilters: [isnotnull(upload_hour" in plan


def test_lookback_reaches_the_scan(spark):
    plan = plan_of(registry.incremental_lookback(spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_marts_read_only_their_columns(spark, tmp_path):
    table = str(tmp_path / "judged")
    source = registry.line_classified(spark, SF)
    write_run(source, table, "r", ["verdict"])
    stored = read_runs(
        spark, table, "transaction_id string, customer_id string, merchant_id string, city string, "
        "amount double, timestamp timestamp_ntz, run_id string, verdict string",
    ).where("verdict = 'valid'")
    plan = plan_of(marts.transactions_per_merchant(stored))
    assert "ReadSchema: struct<transaction_id:string,merchant_id:string,amount:double>" in plan
    assert "PartitionFilters: [isnotnull(verdict" in plan


def test_rules_reach_the_scan_of_their_side(spark, tmp_path):
    for name, rows in (
        ("tx", "select '1' as transaction_id, '1' as customer_id, 1.0D as amount, 1.0D as total_amount"),
        ("cu", "select '1' as customer_id, 30 as age"),
    ):
        spark.sql(rows).write.parquet(str(tmp_path / name))
    tx, cu = (spark.read.parquet(str(tmp_path / n)) for n in ("tx", "cu"))
    checks = [rules.amount_rule(), rules.age_rule()]
    plan = plan_of(rules.only(joins.with_customers(tx, cu), checks, rules.VALID))
    assert "GreaterThanOrEqual(age,14), LessThanOrEqual(age,100)" in plan
    assert "GreaterThanOrEqual(amount,0.5)" in plan


def test_small_reference_is_broadcast_and_large_one_is_not(spark, conf):
    codes = spark.range(1000).selectExpr("cast(id as string) as currency_code")
    frame = spark.range(100).selectExpr("id as transaction_id", "cast(id as string) as currency")
    assert "BroadcastHashJoin" in plan_of(joins.flag_currency(frame, codes))
    conf(autoBroadcastJoinThreshold="1")
    conf(adaptive__autoBroadcastJoinThreshold="1")
    plan = plan_of(joins.flag_currency(frame, codes))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.fixture
def hot(spark, conf):
    """A third of the transactions belong to one customer, and thresholds are tiny."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="64k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    tx = spark.range(0, 150_000, 1, 16).selectExpr(
        "cast(id as string) as transaction_id",
        "if(id % 3 = 0, 'hot', concat('c', id % 2000)) as customer_id",
        "abs(xxhash64(id)) / 1e12 as amount",
    )
    cu = spark.range(0, 2000).selectExpr("concat('c', id) as customer_id", "30 as age")
    cu = cu.union(spark.sql("select 'hot', 30"))
    return tx, dedup.keep_smallest(cu.union(cu), ["customer_id"])


def test_a_hot_customer_is_split(hot):
    tx, cu = hot
    for frame in (joins.with_customers(tx, cu), joins.with_known_customers(tx, cu)):
        assert "SortMergeJoin(skew=true)" in executed(frame)
        assert frame.count() == 150_000
    # Without the extra key the join would reuse the partitioning of the customers.
    assert "skew=true" not in executed(tx.join(cu, "customer_id"))


def test_a_hot_customer_is_split_before_a_grouping(hot):
    tx, cu = hot
    grouped = marts.transactions_per_customer(joins.with_customers(tx, cu))
    plan = executed(grouped)
    assert "SortMergeJoin(skew=true)" in plan and "partial_sum" in plan
    assert grouped.where("customer_id = 'hot'").first().num_transactions == 50_000


def test_transactions_without_customer_spread_out(hot, conf):
    tx, cu = hot
    conf(adaptive__coalescePartitions__enabled="false")
    lost = tx.withColumn("customer_id", F.when(F.col("customer_id") != "hot", F.col("customer_id")))
    alone = joins.orphans(lost, cu)
    assert alone.count() == 50_000
    sizes = [r["count"] for r in alone.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 50_000 / 2


def test_unreadable_lines_spread_out(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    conf(adaptive__coalescePartitions__enabled="false")
    lines = spark.range(40_000).selectExpr(
        "cast(null as string) as transaction_id", "cast(null as string) as customer_id",
        "concat('{', id) as _corrupt_record",
    )
    cu = spark.range(10).selectExpr("cast(id as string) as customer_id", "30 as age")
    joined = joins.with_known_customers(lines, cu)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 40_000 / 4
