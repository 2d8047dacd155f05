from veriledger.operators import joins
from veriledger.plans import etl, registry, testbed


def test_transactions_stay_where_they_are_when_few_customers_are_unknown(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    tx = spark.range(40_000).selectExpr("concat('t', id) transaction_id", "if(id % 9 = 0, null, concat('c', id % 5000)) customer_id")
    known = spark.range(4999).selectExpr("concat('c', id) customer_id")
    known = known.union(known)
    try:
        for key in keys:
            spark.conf.set(key, "20000")
        lost = joins.orphans(tx, known)
        assert lost.columns == ["customer_id", "transaction_id"]
        assert lost.where("customer_id is null").count() == 4445 and lost.where("customer_id = 'c4999'").count() == 7
        assert lost.count() == 4452
        assert "Exchange hashpartitioning" not in lost._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_each_query_of_stored_marts_writes_its_own_runs(spark):
    folders = [registry._two_stored_runs(spark, "/root/testdata/sf0.001") for _ in range(2)]
    assert folders[0] != folders[1]


def test_a_feed_that_is_read_several_times_is_put_together_once(spark, monkeypatch):
    feeds, run_on = [], etl.run_on
    monkeypatch.setattr(etl, "run_on", lambda spark, feed, *a, **b: feeds.append(feed) or run_on(spark, feed, *a, **b))
    sf = "/root/testdata/sf0.001"
    for build in (registry.stored_run_report, registry.resent_orphans_by_bitmap):
        assert build(spark, sf).agg({"num_rows": "sum"}).first()[0] > 0
    assert len(feeds) == 4
    plain = testbed.line_transactions(spark, sf)
    for feed in feeds:
        assert "Join" not in feed._jdf.queryExecution().executedPlan().toString()
        assert feed.dtypes == plain.dtypes and feed.exceptAll(plain).isEmpty() and plain.exceptAll(feed).isEmpty()
