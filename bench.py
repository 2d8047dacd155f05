"""Time the headline queries and the whole job; prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)

``python bench.py --shapes`` instead compares the job with the usual two-write shape:
deduplicate, repartition, join, cache, then filter and write once per verdict.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import datetime

from veriledger.operators import rules
from veriledger.operators.cleaning import clean_customers, clean_transactions
from veriledger.operators.joins import flag_currency
from veriledger.plans import testbed
from veriledger.plans.etl import EtlRun, run_etl
from veriledger.plans.marts import run_marts
from veriledger.plans.registry import QUERIES
from veriledger.session import build_session
from veriledger.sources.feeds import read_customers, read_transactions, write_feed

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "dedup_transactions",
    "enrich_transactions",
    "valid_transactions",
    "run_quality_report",
    "failure_reason_counts",
    "dedup_across_runs",
    "transactions_per_customer",
    "transactions_per_merchant",
    "monthly_transactions",
    "consolidate_marts",
    "marts_by_upload_window",
]
# Timed too, but not part of the total, which stays comparable.
WRITTEN = ["stored_run_report", "stored_customer_mart", "stream_dedup"]


def session():
    spark = build_session(
        "veriledger-bench",
        f"local[{CPUS}]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action, repeats: int = 3) -> float:
    """Median of some runs after the first, which compiles."""
    action()
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def land_feeds(spark, scratch: str) -> None:
    """The test tables as JSON feeds of several files, as the job would find them."""
    write_feed(testbed.line_transactions(spark, FOLDER).repartition(16), f"{scratch}/transactions")
    write_feed(testbed.line_customers(spark, FOLDER).repartition(4), f"{scratch}/customers")


def spread_tables(spark, scratch: str) -> str:
    """The test tables in files enough for all cores: each is a single row group as given."""
    for name in ("events", "customer", "orders", "lineitem", "supplier"):
        rows = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        rows.repartition(int(CPUS)).write.parquet(f"{scratch}/tables/{name}.parquet")
    return f"{scratch}/tables"


def job(scratch: str) -> EtlRun:
    return EtlRun(
        run_id="bench",
        run_time=datetime(2024, 1, 1),
        customers=f"{scratch}/customers",
        transactions=f"{scratch}/transactions",
        table=f"{scratch}/judged",
        currencies=testbed.CODES,
    )


def two_write_shape(spark, scratch: str) -> None:
    tx = read_transactions(spark, f"{scratch}/transactions").dropDuplicates(["transaction_id"])
    cu = read_customers(spark, f"{scratch}/customers").dropDuplicates(["customer_id"])
    tx = flag_currency(clean_transactions(tx), testbed.CODES).repartition("transaction_id")
    joined = tx.join(clean_customers(cu).repartition("customer_id"), "customer_id").cache()
    for verdict in (rules.VALID, rules.INVALID):
        rows = rules.only(joined, rules.default_rules(), verdict)
        rows.write.mode("overwrite").parquet(f"{scratch}/two-writes/{verdict}")
    joined.unpersist(blocking=True)


def main() -> None:
    spark = session()
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    land_feeds(spark, scratch)
    times = {}
    if "--shapes" in sys.argv:
        times["two_write_shape"] = seconds(lambda: two_write_shape(spark, scratch))
        times["etl_from_json"] = seconds(lambda: run_etl(spark, job(scratch)))
    else:
        tables = spread_tables(spark, scratch)
        for name in HEADLINE + WRITTEN:
            times[name] = seconds(
                lambda: QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
            )
        times["etl_from_json"] = seconds(lambda: run_etl(spark, job(scratch)))
        times["marts_of_run"] = seconds(
            lambda: run_marts(spark, f"{scratch}/judged", f"{scratch}/marts", ["bench"])
        )
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries and jobs, warm median",
                "value": round(sum(t for name, t in times.items() if name not in WRITTEN), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
