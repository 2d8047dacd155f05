"""One query per operator, each over whole test tables.

``build(spark, folder)`` gives a DataFrame.  Money is summed as doubles, as in the job, and
rounded when it is given out, since the last bits depend on the order of addition; the
queries named ``exact`` sum decimals instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.functions import text
from veriledger.functions.times import bucket
from veriledger.operators import cleaning, dedup, dimension, joins, marts, rules
from veriledger.operators.profile import merged_profiles, quantile
from veriledger.plans import etl, testbed
from veriledger.plans.mart_deltas import keep_marts, read_kept_mart
from veriledger.plans.marts import (
    MONTHLY,
    PER_CUSTOMER,
    PER_MERCHANT,
    compact_marts,
    read_mart,
    run_marts,
)
from veriledger.schemas import (
    CUSTOMER_COLUMNS,
    RUN_TABLE_DDL,
    TRANSACTION_COLUMNS,
    TRANSACTION_DDL,
    retyped,
)
from veriledger.session import shared_folder
from veriledger.sources import synthetic
from veriledger.sources.catalog import append_rows, ensure_namespace, ensure_table
from veriledger.sources.cleanup import delete_consumed
from veriledger.sources.dimension_table import read_dimension, write_customer_versions
from veriledger.sources.feeds import read_currencies, read_transactions, write_feed
from veriledger.sources.run_tables import lookback, read_lookback, read_runs, write_run
from veriledger.streaming.bounded import dedup_stream
from veriledger.streaming.incremental import stream_customers, stream_orphans, stream_transactions
from veriledger.streaming.landing import land, read_messages

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters, stated again in the oracle texts.
LOOKBACK_NOW = "2024-01-31 00:00:00"
RUN_SPLIT = "1998-07-01 00:00:00"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD"]

ENRICHED_COLUMNS = TRANSACTION_COLUMNS + [c for c in CUSTOMER_COLUMNS if c != "customer_id"]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def as_double(column: str) -> Column:
    return F.col(column).cast("double").alias(column)


def cents(column: str) -> Column:
    """A sum of doubles, given out in cents."""
    return F.round(column, 2).alias(column)


def average(column: str) -> Column:
    """An average given out to four places.  The shift keeps it off the ties of rounding."""
    return F.round(F.col(column) + 3e-7, 4).alias(column)


def plain_time(column: str) -> Column:
    """As stored in the test tables: a timestamp without zone."""
    return F.col(column).cast("timestamp_ntz").alias(column)


def tri_state(condition: Column) -> Column:
    return F.when(condition, "true").when(~condition, "false").otherwise("unknown")


def line_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return etl.enriched(
        testbed.line_transactions(spark, sf), testbed.line_customers(spark, sf), testbed.CODES
    )


def line_verdict(spark: SparkSession, sf: str, verdict: str) -> DataFrame:
    return rules.only(line_enriched(spark, sf), rules.default_rules(), verdict)


def line_valid(spark: SparkSession, sf: str) -> DataFrame:
    return line_verdict(spark, sf, rules.VALID)


def line_classified(spark: SparkSession, sf: str) -> DataFrame:
    return etl.classified(
        testbed.line_transactions(spark, sf),
        testbed.line_customers(spark, sf),
        testbed.CODES,
        rules.default_rules(),
    )


def in_first_run() -> Column:
    """Rows without a time belong to the second run."""
    return F.coalesce(F.col("timestamp") < F.lit(RUN_SPLIT).cast("timestamp_ntz"), F.lit(False))


# --- scans and layout ---------------------------------------------------------------


@query
def currency_reference_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One column of a reference table."""
    return testbed.table(spark, sf, "supplier").select(F.col("s_name").alias("currency_code"))


@query
def incremental_lookback(spark: SparkSession, sf: str) -> DataFrame:
    events = testbed.table(spark, sf, "events")
    return lookback(events, LOOKBACK_NOW, hours=6, time_column="ts", hour_column=None)


@query
def hour_partition_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Rows each hour directory of the events would hold."""
    hours = testbed.table(spark, sf, "events").select(bucket(F.col("ts"), "HOUR").alias("hour"))
    return (
        hours.groupBy("hour")
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .select(F.col("hour").cast("timestamp_ntz").alias("upload_hour"), "num_rows")
    )


@query
def run_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    report = rules.verdict_counts(line_classified(spark, sf))
    return report.select("verdict", "num_rows", "num_ids", cents("total_amount"))


# --- cleaning -----------------------------------------------------------------------


@query
def cast_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts as the feed declares them (float), widened."""
    feed = testbed.line_transactions(spark, sf).select(
        "transaction_id",
        F.col("amount").cast("float").alias("amount"),
        F.col("total_amount").cast("float").alias("total_amount"),
    )
    return cleaning.widen_amounts(feed)


@query
def fill_unknown_transactions(spark: SparkSession, sf: str) -> DataFrame:
    filled = cleaning.fill_transactions(testbed.line_transactions(spark, sf))
    return filled.select("transaction_id", "merchant_id", "city")


@query
def fill_unknown_customers(spark: SparkSession, sf: str) -> DataFrame:
    filled = cleaning.fill_customers(testbed.line_customers(spark, sf))
    return filled.select("customer_id", "job", "housing", "marital")


@query
def normalize_domain(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.normalize_gender(testbed.line_customers(spark, sf)).select(
        "customer_id", "gender"
    )


@query
def parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    texts = testbed.mapped(spark, sf, testbed.SHIP_TEXTS, "lineitem")
    parsed = text.parse_timestamp(F.col("text")).cast("timestamp_ntz")
    return texts.select("l_orderkey", "l_linenumber", "text", parsed.alias("parsed"))


# --- rules --------------------------------------------------------------------------


@query
def rule_id_not_nan(spark: SparkSession, sf: str) -> DataFrame:
    first, second = rules.id_rules()
    return testbed.line_transactions(spark, sf).select(
        "transaction_id",
        "customer_id",
        tri_state(first.check).alias("transaction_ok"),
        tri_state(second.check).alias("customer_ok"),
    )


@query
def rule_min_amount(spark: SparkSession, sf: str) -> DataFrame:
    return testbed.event_transactions(spark, sf).select(
        "transaction_id", tri_state(rules.amount_rule().check).alias("amount_ok")
    )


def _stored_codes(spark: SparkSession) -> DataFrame:
    path = shared_folder(spark, "codes")
    testbed.code_table(spark).write.parquet(path)
    return read_currencies(spark, path, table=False)


@query
def rule_currency_member(spark: SparkSession, sf: str) -> DataFrame:
    """Against the codes as a stored table."""
    codes = _stored_codes(spark)
    flagged = joins.flag_currency(testbed.event_transactions(spark, sf), codes)
    return flagged.select(
        "transaction_id", tri_state(rules.currency_rule().check).alias("currency_ok")
    )


@query
def rule_age_range(spark: SparkSession, sf: str) -> DataFrame:
    return testbed.event_customers(spark, sf).select(
        "customer_id", tri_state(rules.age_rule().check).alias("age_ok")
    )


@query
def valid_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return line_verdict(spark, sf, rules.VALID).select(*ENRICHED_COLUMNS)


@query
def invalid_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return line_verdict(spark, sf, rules.INVALID).select(*ENRICHED_COLUMNS)


@query
def indeterminate_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return line_verdict(spark, sf, rules.INDETERMINATE).select(*ENRICHED_COLUMNS)


@query
def event_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """The verdict of every event, from the rules on amount, currency and age."""
    flagged = joins.flag_currency(testbed.event_transactions(spark, sf), testbed.CODES)
    joined = joins.with_customers(flagged, testbed.event_customers(spark, sf))
    judged = rules.judge(joined, [rules.amount_rule(), rules.currency_rule(), rules.age_rule()])
    return judged.select("transaction_id", "customer_id", "verdict")


@query
def failure_reason_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rules.reason_counts(line_classified(spark, sf))


# --- duplicates ---------------------------------------------------------------------


@query
def dedup_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.keep_smallest(testbed.line_transactions(spark, sf), ["transaction_id"])


@query
def dedup_customers(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.keep_smallest(testbed.line_customers(spark, sf), ["customer_id"])


@query
def dedup_across_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The later run without the ids the earlier run has seen."""
    feed = testbed.line_transactions(spark, sf)
    earlier, later = feed.where(in_first_run()), feed.where(~in_first_run())
    fresh = dedup.keep_smallest(later, ["transaction_id"])
    return dedup.drop_seen(fresh, earlier, "transaction_id")


# --- joins --------------------------------------------------------------------------


@query
def enrich_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return joins.with_customers(
        testbed.event_transactions(spark, sf), testbed.event_customers(spark, sf)
    )


@query
def currency_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    return joins.in_reference(
        testbed.event_transactions(spark, sf), _stored_codes(spark), "currency"
    )


@query
def orphan_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return joins.orphans(testbed.line_transactions(spark, sf), testbed.line_customers(spark, sf))


@query
def enrich_with_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """A feed holding one segment's customers only, joined to all customers ever loaded."""
    customers = testbed.line_customers(spark, sf)
    batch = customers.where(F.col("job") == "BUILDING").withColumn("age", F.lit(50))
    versions = dimension.as_versions(customers, "2024-01-01 00:00:00").union(
        dimension.as_versions(batch, "2024-01-01 06:00:00")
    )
    known = cleaning.clean_customers(dimension.latest_customers(versions))
    joined = joins.with_customers(testbed.line_transactions(spark, sf), known)
    return joined.select("transaction_id", "customer_id", "amount", "age", "job", "balance")


@query
def dimension_of_merged_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Seven loads into a dimension that merges itself, and the customers of some transactions out of it."""
    folder = f"{shared_folder(spark, 'merged-dimension')}/customers"
    customers = testbed.line_customers(spark, sf)
    loads = [customers, *[customers.where(F.col("job").eqNullSafe(F.lit(j))).withColumn("age", F.lit(40 + i)) for i, j in enumerate(SEGMENTS)]]
    for number, load in enumerate([*loads, customers.limit(0)]):
        write_customer_versions(load, folder, f"load-{number}", datetime(2024, 1, 1, number), fan=3)
    feed = testbed.line_transactions(spark, sf).where("status = 'completed'")
    known = read_dimension(spark, folder, feed.select("customer_id"))
    joined = joins.with_customers(feed, known.select("customer_id", "age", "job", "balance"))
    return joined.select("transaction_id", "customer_id", "amount", "age", "job", as_double("balance"))


# --- marts --------------------------------------------------------------------------


def customer_mart(mart: DataFrame) -> DataFrame:
    return mart.select(
        "customer_id", "num_transactions", cents("total_amount"), average("average_transaction_amount")
    )


def _exact_mart(valid: DataFrame) -> DataFrame:
    mart = marts.transactions_per_customer(cleaning.exact_amounts(valid))
    return mart.select(
        "customer_id", "num_transactions", as_double("total_amount"), average("average_transaction_amount")
    )


@query
def transactions_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    return customer_mart(marts.transactions_per_customer(line_valid(spark, sf)))


@query
def transactions_per_customer_exact(spark: SparkSession, sf: str) -> DataFrame:
    """With sums of decimals, in which a NaN has no part."""
    return _exact_mart(line_valid(spark, sf))


@query
def transactions_per_customer_reproducible(spark: SparkSession, sf: str) -> DataFrame:
    """With sums of doubles that are the same in any order of addition; nothing is rounded."""
    totals = marts.amount_totals(line_valid(spark, sf), "customer_id")
    return marts.mart_of_totals(totals, "customer_id", "total_amount", "average_transaction_amount")


@query
def transactions_per_merchant(spark: SparkSession, sf: str) -> DataFrame:
    mart = marts.transactions_per_merchant(line_valid(spark, sf))
    return mart.select("merchant_id", "num_transactions", cents("total_sales"))


@query
def monthly_transactions(spark: SparkSession, sf: str) -> DataFrame:
    mart = marts.monthly_transactions(line_valid(spark, sf))
    return mart.select("transaction_month", "num_transactions", cents("total_amount"))


@query
def monthly_transactions_by_year(spark: SparkSession, sf: str) -> DataFrame:
    mart = marts.monthly_transactions_by_year(line_valid(spark, sf))
    return mart.select(plain_time("month_start"), "num_transactions", cents("total_amount"))


@query
def consolidate_marts(spark: SparkSession, sf: str) -> DataFrame:
    """The customer marts of two runs, made in one pass and merged."""
    valid = line_valid(spark, sf).withColumn("first_run", in_first_run())
    partials = marts.customer_partials(valid, "first_run")
    return customer_mart(marts.merge_customer_partials(partials))


def _dirty_valid(spark: SparkSession, sf: str) -> DataFrame:
    rows = etl.enriched(
        testbed.dirty_transactions(spark, sf), testbed.line_customers(spark, sf), testbed.CODES
    )
    return rules.only(rows, rules.default_rules(), rules.VALID)


@query
def nan_amounts_customer_mart(spark: SparkSession, sf: str) -> DataFrame:
    """A NaN amount is valid and turns the sums of its customer to NaN."""
    return customer_mart(marts.transactions_per_customer(_dirty_valid(spark, sf)))


@query
def nan_amounts_customer_mart_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _exact_mart(_dirty_valid(spark, sf))


@query
def marts_by_upload_window(spark: SparkSession, sf: str) -> DataFrame:
    flagged = joins.flag_currency(testbed.event_transactions(spark, sf), testbed.CODES)
    joined = joins.with_customers(flagged, testbed.event_customers(spark, sf))
    checks = [rules.amount_rule(), rules.currency_rule(), rules.age_rule()]
    mart = marts.by_upload_window(rules.only(joined, checks, rules.VALID))
    return mart.select(
        plain_time("window_start"), plain_time("window_end"), "num_transactions", cents("total_amount")
    )


# --- messages -----------------------------------------------------------------------


@query
def id_batch_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Customer ids packed into JSON arrays of a hundred and unpacked again."""
    ids = testbed.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("customer_id")
    )
    return synthetic.read_id_batches(synthetic.id_batches(ids, "c_custkey"))


@query
def json_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions as JSON messages, read back under the declared schema."""
    messages = synthetic.as_messages(testbed.line_transactions(spark, sf))
    # The test amounts are doubles; the zone-less timestamp text is read as such.
    kinds = {
        "timestamp": "timestamp_ntz",
        "amount": "double",
        "total_amount": "double",
        "installment_amount": "double",
        "bank_interest": "double",
    }
    record = F.from_json("value", retyped(TRANSACTION_DDL, kinds))
    return messages.select(record.alias("record")).select("record.*")


@query
def generated_draws(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions generated for messages of given ids: how many draws hit a known customer."""
    ids = testbed.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("customer_id")
    )
    drawn = synthetic.transactions_from_batches(synthetic.id_batches(ids, "c_custkey"), per_batch=200)
    return drawn.join(ids, "customer_id").groupBy(
        F.floor(F.col("c_custkey") / 100).cast("bigint").alias("batch")
    ).agg(
        F.count("*").alias("num_transactions"),
        F.count_if((F.col("amount") >= 10) & (F.col("amount") <= 10_000)).alias("num_in_range"),
        F.count_distinct("transaction_id").alias("num_ids"),
    )


# --- whole jobs, through written tables ---------------------------------------------


def _run(folder: str, run_id: str, hour: int, **options) -> etl.EtlRun:
    return etl.EtlRun(
        run_id=run_id,
        run_time=datetime(2024, 1, 1, hour, 30),
        customers=None,
        transactions="",
        table=f"{folder}/judged",
        currencies=testbed.CODES,
        **options,
    )


def _both_feeds(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return testbed.line_transactions(spark, sf), testbed.line_customers(spark, sf)


def _kept_feeds(spark: SparkSession, sf: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """The same, the transactions as a stored table, for queries that read all of them several times.

    Else each reading would shuffle order lines and orders anew, at several times the room of the table.
    """
    feed, customers = _both_feeds(spark, sf)
    feed.write.option("compression", "zstd").parquet(f"{folder}/feed")
    return spark.read.schema(feed.schema).parquet(f"{folder}/feed"), customers


@query
def stored_run_report(spark: SparkSession, sf: str) -> DataFrame:
    """A run written twice under one id, then counted from its table."""
    folder = shared_folder(spark, "stored-run")
    feed, customers = _kept_feeds(spark, sf, folder)
    for _ in range(2):
        etl.run_on(spark, feed, customers, _run(folder, "first", 0))
    report = rules.verdict_counts(read_runs(spark, f"{folder}/judged", RUN_TABLE_DDL))
    return report.select("verdict", "num_rows", "num_ids", cents("total_amount"))


@query
def stored_clustered_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs whose files follow a curve through customers and times, and all of their rows."""
    folder = shared_folder(spark, "clustered")
    feed, customers = _both_feeds(spark, sf)
    for run_id, hour, rows in (("first", 0, in_first_run()), ("second", 6, ~in_first_run())):
        etl.run_on(spark, feed.where(rows), customers, _run(folder, run_id, hour, cluster=("customer_id", "timestamp")))
    return read_runs(spark, f"{folder}/judged", RUN_TABLE_DDL).select(
        "run_id", "verdict", "transaction_id", "customer_id", plain_time("timestamp"), "amount", "merchant_id"
    )


def _two_stored_runs(spark: SparkSession, sf: str) -> str:
    """Two runs split by time and their marts, the second mart repeated."""
    folder = shared_folder(spark, "stored-marts")
    feed, customers = _both_feeds(spark, sf)
    etl.run_on(spark, feed.where(in_first_run()), customers, _run(folder, "first", 0))
    etl.run_on(spark, feed.where(~in_first_run()), customers, _run(folder, "second", 6))
    for runs in (["first", "second"], ["second"]):
        run_marts(spark, f"{folder}/judged", f"{folder}/marts", runs)
    return folder


@query
def stored_customer_mart(spark: SparkSession, sf: str) -> DataFrame:
    return customer_mart(read_mart(spark, f"{_two_stored_runs(spark, sf)}/marts", PER_CUSTOMER))


@query
def stored_merchant_mart(spark: SparkSession, sf: str) -> DataFrame:
    mart = read_mart(spark, f"{_two_stored_runs(spark, sf)}/marts", PER_MERCHANT)
    return mart.select("merchant_id", "num_transactions", cents("total_sales"))


@query
def stored_monthly_mart(spark: SparkSession, sf: str) -> DataFrame:
    mart = read_mart(spark, f"{_two_stored_runs(spark, sf)}/marts", MONTHLY)
    return mart.select("transaction_month", "num_transactions", cents("total_amount"))


@query
def stored_compacted_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The customer mart after its runs were merged into one."""
    compact = shared_folder(spark, "compact-marts")
    compact_marts(spark, f"{_two_stored_runs(spark, sf)}/marts", compact)
    return customer_mart(read_mart(spark, compact, PER_CUSTOMER))


@query
def stored_reproducible_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The merchants of two stored runs, merged, compacted and read: the bits of one sum over all rows."""
    folder = shared_folder(spark, "reproducible")
    judged = f"{_two_stored_runs(spark, sf)}/judged"
    run_marts(spark, judged, f"{folder}/marts", reproducible=True)
    compact_marts(spark, f"{folder}/marts", f"{folder}/compact", reproducible=True)
    return read_mart(spark, f"{folder}/compact", PER_MERCHANT, reproducible=True)


@query
def stored_mart_after_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """A run repeated with more rows after its summary: the marts follow."""
    folder = shared_folder(spark, "rerun")
    feed, customers = _both_feeds(spark, sf)
    for rows in (feed.where(in_first_run()), feed):
        etl.run_on(spark, rows, customers, _run(folder, "first", 0))
        run_marts(spark, f"{folder}/judged", f"{folder}/marts")
    return customer_mart(read_mart(spark, f"{folder}/marts", PER_CUSTOMER))


@query
def stored_mart_by_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """A run of the whole feed cut down to half after its delta was merged with that of a second run."""
    folder = shared_folder(spark, "deltas")
    feed, customers = _both_feeds(spark, sf)
    for run_id, hour, rows in (
        ("first", 0, feed),
        ("second", 6, feed.where(~in_first_run())),
        ("first", 0, feed.where(in_first_run())),
    ):
        etl.run_on(spark, rows, customers, _run(folder, run_id, hour))
        keep_marts(spark, f"{folder}/judged", f"{folder}/marts", fan=2)
    return read_kept_mart(spark, f"{folder}/marts", PER_CUSTOMER)


@query
def stored_lookback_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs written by the job into a table of the catalog, and a lookback over it by name."""
    folder, name = shared_folder(spark, "named"), f"judged_{uuid.uuid4().hex}"
    feed, customers = _both_feeds(spark, sf)
    for half, hour, rows in (("first", 0, in_first_run()), ("second", 8, ~in_first_run())):
        etl.run_on(spark, feed.where(rows), customers, _run(folder, half, hour, catalog=name))
    recent = lookback(spark.table(name), datetime(2024, 1, 1, 9), hours=6)
    return recent.groupBy("run_id", "verdict").agg(
        F.count("*").alias("num_rows"), F.count("transaction_id").alias("num_ids")
    )


@query
def stored_run_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs with profiles, merged: rows exactly, and whether the sketches are as near as they promise to be."""
    folder = shared_folder(spark, "profile")
    feed, customers = _both_feeds(spark, sf)
    for run_id, hour, rows in (("first", 0, in_first_run()), ("second", 6, ~in_first_run())):
        etl.run_on(spark, feed.where(rows), customers, _run(folder, run_id, hour, profile=True))
    table = f"{folder}/judged"
    told = merged_profiles(etl.run_profiles(spark, table)).withColumn("median", quantile("amounts", 0.5))
    rows = read_runs(spark, table, RUN_TABLE_DDL).join(told.select("verdict", "median"), "verdict")
    exact = rows.groupBy("verdict").agg(
        F.count_distinct("customer_id").alias("num_customers"),
        F.count("amount").alias("num_amounts"),
        F.count_if(F.col("amount") <= F.col("median")).alias("below"),
        F.count_if(F.col("amount") < F.col("median")).alias("under"),
    )
    half, slack = F.col("num_amounts") / 2, F.col("num_amounts") * 0.02 + 1
    return told.join(exact, "verdict").select(
        "verdict", "num_rows", "num_customers",
        (F.abs(F.hll_sketch_estimate("customers") - F.col("num_customers")) <= F.col("num_customers") * 0.07).alias("customers_near"),
        ((F.col("under") - slack <= half) & (half <= F.col("below") + slack)).alias("median_near"),
    )


@query
def stored_extra_rule(spark: SparkSession, sf: str) -> DataFrame:
    """A run with a rule of its own: how many rows each reason applies to."""
    folder = shared_folder(spark, "extra-rule")
    feed, customers = _both_feeds(spark, sf)
    own = [*rules.default_rules(), rules.Rule("paid_by_card", F.col("deposit_method") == "card")]
    etl.run_on(spark, feed, customers, _run(folder, "first", 0, rules=own))
    return rules.reason_counts(read_runs(spark, f"{folder}/judged", RUN_TABLE_DDL))


def _resent(spark: SparkSession, sf: str, **options) -> DataFrame:
    folder = shared_folder(spark, "resent")
    feed, customers = _kept_feeds(spark, sf, folder)
    few = customers.where(~F.col("job").eqNullSafe(F.lit("BUILDING")))
    etl.run_on(spark, feed, few, _run(folder, "first", 0, **options))
    etl.run_on(spark, feed, customers, _run(folder, "second", 6, skip_seen_hours=24, **options))
    judged = read_runs(spark, f"{folder}/judged", RUN_TABLE_DDL)
    return judged.groupBy("run_id", "verdict").agg(
        F.count("*").alias("num_rows"), F.count("transaction_id").alias("num_ids")
    )


@query
def resent_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """A feed sent again once more customers are known: ids judged before are skipped, orphans not."""
    return _resent(spark, sf)


@query
def resent_orphans_by_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """The same, with bitmaps that rule out ids that were not judged."""
    return _resent(spark, sf, id_bits=1 << 16)


@query
def stored_json_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole batch job from JSON files, with the time it stamps on its rows."""
    folder = shared_folder(spark, "json-run")
    feed, customers = _both_feeds(spark, sf)
    write_feed(feed, f"{folder}/transactions", compressed=True)
    write_feed(customers, f"{folder}/customers", compressed=True)
    run = replace(
        _run(folder, "first", 0), customers=f"{folder}/customers", transactions=f"{folder}/transactions"
    )
    etl.run_etl(spark, run)
    return read_runs(spark, run.table, RUN_TABLE_DDL).groupBy(
        "verdict", plain_time("upload_time"), plain_time("upload_hour")
    ).agg(F.count("*").alias("num_rows"), F.count("transaction_id").alias("num_ids"))


def _two_halves(spark: SparkSession, sf: str, folder: str, between: Callable[[etl.EtlRun], object]) -> etl.EtlRun:
    """A feed that arrives in two halves, with ``between`` called after each; the run that reads it."""
    feed, customers = _both_feeds(spark, sf)
    write_feed(customers, f"{folder}/customers", compressed=True)
    run = replace(
        _run(folder, "slot", 0), customers=f"{folder}/customers", transactions=f"{folder}/transactions", named=False
    )
    for half in (in_first_run(), ~in_first_run()):
        write_feed(feed.where(half), run.transactions, compressed=True)
        between(run)
    return run


@query
def retried_slot(spark: SparkSession, sf: str) -> DataFrame:
    """A time slot run, run again, and once more after another file has landed: each file is judged once."""
    folder = shared_folder(spark, "retried")

    def twice(run: etl.EtlRun) -> None:
        for _ in range(2):
            etl.run_etl(spark, run)

    run = _two_halves(spark, sf, folder, twice)
    return read_runs(spark, run.table, RUN_TABLE_DDL).groupBy("run_id", "verdict").agg(
        F.count("*").alias("num_rows"), F.count("transaction_id").alias("num_ids")
    )


@query
def read_files_deleted(spark: SparkSession, sf: str) -> DataFrame:
    """Only files that a finished run has read are deleted: what is left of the feed, by currency."""
    folder = shared_folder(spark, "deleted")
    done = []

    def judge_first(run: etl.EtlRun) -> None:
        if not done:
            done.append(etl.run_etl(spark, run))

    run = _two_halves(spark, sf, folder, judge_first)
    delete_consumed(spark, run.transactions, run.table)
    left = read_transactions(spark, run.transactions)
    return left.groupBy("currency").agg(F.count("*").alias("num_rows"), F.count("transaction_id").alias("num_ids"))


@query
def lookback_over_many_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The events as 200 runs of an hour each; a lookback opens those of the last six."""
    table = f"{shared_folder(spark, 'many-runs')}/events"
    events = testbed.table(spark, sf, "events")
    start = datetime(2024, 1, 1)

    def write(number: int) -> None:
        when = start + timedelta(hours=number)
        rows = events.where(F.col("event_id") % 200 == number)
        stamped = rows.withColumns({c: F.lit(str(when)).cast("timestamp") for c in ("upload_time", "upload_hour")})
        write_run(stamped, table, f"run-{number}", ["upload_hour"], times=(when, when))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(200)))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema)
    ddl = f"{fields}, upload_time timestamp, run_id string, upload_hour timestamp"
    recent = read_lookback(spark, table, ddl, start + timedelta(hours=199, minutes=30))
    return recent.select(*events.columns, "run_id")


@query
def created_and_appended(spark: SparkSession, sf: str) -> DataFrame:
    """A namespace and an hourly table, created if absent; events appended in two parts; rows by hour."""
    name = f"ledger_{uuid.uuid4().hex}"
    events = testbed.table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("upload_time"))
    for part in (0, 1):
        ensure_namespace(spark, name)
        ensure_table(spark, f"{name}.events", "event_id bigint, event_type string, upload_time timestamp", "upload_time", "HOUR")
        append_rows(events.where(F.col("event_id") % 2 == part), f"{name}.events")
    stored = spark.table(f"{name}.events")
    return stored.groupBy(plain_time("upload_hour"), "event_type").agg(F.count("*").alias("num_rows"))


def _landed(spark: SparkSession, folder: str, name: str, feed: DataFrame) -> str:
    """A feed as messages, landed by a stream."""
    synthetic.as_messages(feed).write.mode("append").option("compression", "gzip").text(f"{folder}/queue/{name}")
    land(
        read_messages(spark, path=f"{folder}/queue/{name}"),
        f"{folder}/landing/{name}",
        f"{folder}/checkpoints/land-{name}",
        compressed=True,
    ).awaitTermination()
    return f"{folder}/landing/{name}"


def _judged_stream(spark: SparkSession, folder: str, name: str, feed: DataFrame, clean: str | None = None, **options) -> None:
    run = replace(
        _run(folder, "", 0), transactions=_landed(spark, folder, name, feed), dimension=f"{folder}/dimension"
    )
    stream_transactions(spark, run, f"{folder}/checkpoints/{name}", clean, **options).awaitTermination()


def _with_customers(spark: SparkSession, folder: str, customers: DataFrame, **options) -> None:
    landing = _landed(spark, folder, "customers", customers)
    stream_customers(
        spark, landing, f"{folder}/dimension", f"{folder}/checkpoints/customers", **options
    ).awaitTermination()


def _stream_report(spark: SparkSession, folder: str) -> DataFrame:
    judged = read_runs(spark, f"{folder}/judged", RUN_TABLE_DDL)
    return rules.verdict_counts(judged).select("verdict", "num_rows", "num_ids")


@query
def stream_run_report(spark: SparkSession, sf: str) -> DataFrame:
    """Feeds as messages, landed by one stream and judged by the next, counted by verdict."""
    folder = shared_folder(spark, "stream-run")
    feed, customers = _both_feeds(spark, sf)
    _with_customers(spark, folder, customers)
    _judged_stream(spark, folder, "transactions", feed)
    return _stream_report(spark, folder)


@query
def stream_two_feeds_report(spark: SparkSession, sf: str) -> DataFrame:
    """Two feeds with checkpoints of their own, judged into one table."""
    folder = shared_folder(spark, "two-feeds")
    feed, customers = _both_feeds(spark, sf)
    _with_customers(spark, folder, customers)
    _judged_stream(spark, folder, "early", feed.where(in_first_run()))
    _judged_stream(spark, folder, "late", feed.where(~in_first_run()))
    return _stream_report(spark, folder)


def _left(rows: DataFrame) -> DataFrame:
    """A line of a report: what is left of a feed."""
    return rows.agg(
        F.lit("left").alias("verdict"), F.count("*").alias("num_rows"), F.count("transaction_id").alias("num_ids")
    )


@query
def stream_landed_and_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """Two waves through a stream that deletes what it has judged: no row is lost, and the first wave is gone."""
    folder = shared_folder(spark, "cleaned")
    feed, customers = _both_feeds(spark, sf)
    _with_customers(spark, folder, customers)
    # Spark deletes the files of a batch while it plans the next one; with no threads, at once.
    threads = "spark.sql.streaming.fileSource.cleaner.numThreads"
    before = spark.conf.get(threads, None)
    spark.conf.set(threads, "0")
    try:
        for half in (in_first_run(), ~in_first_run()):
            _judged_stream(spark, folder, "transactions", feed.where(half), clean="delete")
    finally:
        spark.conf.unset(threads) if before is None else spark.conf.set(threads, before)
    left = _left(read_transactions(spark, f"{folder}/landing/transactions"))
    return _stream_report(spark, folder).unionByName(left)


@query
def repeated_landing(spark: SparkSession, sf: str) -> DataFrame:
    """A batch landed and judged, then landed again as after a crash: every row still counts once."""
    folder = shared_folder(spark, "repeated")
    feed, customers = _both_feeds(spark, sf)
    _with_customers(spark, folder, customers)
    _judged_stream(spark, folder, "transactions", feed)
    commits = f"{folder}/checkpoints/land-transactions/commits"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(commits).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hadoop.Path(f"{commits}/0"), False)
    _judged_stream(spark, folder, "transactions", feed.limit(0))
    return _stream_report(spark, folder)


@query
def waiting_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of one segment come after the feed: their transactions wait in a stream and are judged then."""
    folder = shared_folder(spark, "waiting")
    waiting, arrivals = f"{folder}/waiting", f"{folder}/arrivals"
    feed, customers = _both_feeds(spark, sf)
    late = F.col("job").eqNullSafe(F.lit("BUILDING"))

    def look() -> str:
        run = replace(_run(folder, "", 0), dimension=f"{folder}/dimension")
        looking = stream_orphans(spark, run, waiting, arrivals, f"{folder}/checkpoints/waiting")
        looking.awaitTermination()
        return looking.id

    _with_customers(spark, folder, customers.where(~late), arrivals=arrivals)
    _judged_stream(spark, folder, "transactions", feed, waiting=waiting)
    look()
    _with_customers(spark, folder, customers.where(late), arrivals=arrivals)
    stream = look()
    judged = read_runs(spark, f"{folder}/judged", RUN_TABLE_DDL)
    waited = F.col("run_id").startswith(f"stream-{stream}-").alias("waited")
    return judged.groupBy(waited, "verdict").agg(
        F.count("*").alias("num_rows"), F.count("transaction_id").alias("num_ids")
    )


@query
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Events, doubled on the way in, deduplicated as a stream."""
    folder = shared_folder(spark, "stream-dedup")
    schema = testbed.table(spark, sf, "events").schema
    # A stream needs a pattern to read a single file; this one matches just that name.
    events = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    distinct = dedup_stream(events.union(events), "event_id", "ts", "1 day")
    (
        distinct.writeStream.format("parquet")
        .option("path", f"{folder}/events")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    stored = spark.read.schema(distinct.schema).parquet(f"{folder}/events")
    return stored.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
