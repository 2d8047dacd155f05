"""The jobs from the command line, for ``spark-submit`` or a scheduler.

    python -m veriledger etl --customers DIR --transactions DIR --table DIR --currencies GEL,EUR,USD
    python -m veriledger marts --table DIR --marts DIR
    python -m veriledger generate --out DIR
    python -m veriledger delete --prefix PATH
    python -m veriledger delete --feed DIR --read-by TABLE
    python -m veriledger compact --dimension DIR --into DIR
    python -m veriledger compact --marts DIR --into DIR
    python -m veriledger prune --table DIR --hours 24
    python -m veriledger orphans --table DIR --dimension DIR --currencies GEL,EUR,USD
"""

from __future__ import annotations

import argparse
import json
import logging
import secrets
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from veriledger.operators.rules import Limits
from veriledger.plans.etl import EtlRun, judge_orphans_again, run_etl, run_id_for
from veriledger.plans.mart_deltas import keep_marts
from veriledger.plans.marts import compact_marts, run_marts, run_marts_lookback
from veriledger.session import build_session, size_session
from veriledger.sources import synthetic
from veriledger.sources.cleanup import delete_consumed, delete_feed
from veriledger.sources.dimension_table import compact_dimension
from veriledger.sources.feeds import write_feed
from veriledger.sources.run_tables import prune_attempts
from veriledger.streaming.incremental import utc_now


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="veriledger")
    jobs = top.add_subparsers(dest="job", required=True)

    etl = jobs.add_parser("etl", help="judge the transactions of a feed")
    etl.add_argument("--customers")
    etl.add_argument("--transactions", required=True)
    etl.add_argument("--dimension", help="folder of accumulated customers")
    etl.add_argument("--prefix", action="store_true", help="feed paths are name prefixes")
    etl.add_argument("--skip-seen-hours", type=float)
    etl.add_argument("--id-bits", type=int, default=0, help="bits of a bitmap of judged ids to keep and to use")
    etl.add_argument("--new-files", action="store_true", help="read only files that no run of the table has read")

    orphans = jobs.add_parser("orphans", help="judge stored orphans against the customers known by now")
    orphans.add_argument("--dimension", required=True, help="folder of accumulated customers")
    for judging in (etl, orphans):
        judging.add_argument("--table", required=True, help="folder of the judged table")
        codes = judging.add_mutually_exclusive_group(required=True)
        codes.add_argument("--currencies", help="the codes, with commas between")
        codes.add_argument("--currency-path", help="Parquet folder with the codes")
        codes.add_argument("--currency-table", help="catalog table with the codes")
        judging.add_argument("--catalog", help="catalog table to keep over the judged table")
        judging.add_argument("--min-amount", type=float, default=Limits.min_amount)
        judging.add_argument("--min-age", type=int, default=Limits.min_age)
        judging.add_argument("--max-age", type=int, default=Limits.max_age)

    etl.add_argument("--double-amounts", action="store_true", help="read amounts as doubles")
    etl.add_argument("--cluster", default="", help="columns to search by, with commas between")
    etl.add_argument("--rebalance", action="store_true", help="write evenly sized files")
    etl.add_argument(
        "--size", action="store_true", help="set task sizes from the size of the feeds"
    )

    marts = jobs.add_parser("marts", help="summarise the valid rows")
    marts.add_argument("--table", required=True)
    marts.add_argument("--marts", required=True, help="folder of the marts")
    marts.add_argument("--exact", action="store_true", help="sum money as decimals of cents")
    marts.add_argument("--deltas", action="store_true", help="keep marts that are read from a few merged deltas")
    marts.add_argument("--lookback-hours", type=float, help="instead of one run, the last hours")

    etl.add_argument("--run-id", help="default: the six-hour slot of the run time, for files not read before")
    orphans.add_argument("--run-id", help="default: the six-hour slot of the run time, with -orphans")
    marts.add_argument("--run-id", help="default: all runs not summarised yet")
    for job in (etl, marts, orphans):
        job.add_argument("--run-time", type=datetime.fromisoformat, help="default: now, in UTC")

    generate = jobs.add_parser("generate", help="write feeds of generated records")
    generate.add_argument("--out", required=True)
    generate.add_argument("--customers", type=int, default=synthetic.CUSTOMERS_PER_BATCH)
    generate.add_argument("--transactions", type=int, default=synthetic.TRANSACTIONS_PER_BATCH)
    generate.add_argument("--seed", type=int, help="default: another one for each call")
    generate.add_argument("--dirt", type=float, default=0.0, help="share of each defect")

    delete = jobs.add_parser("delete", help="delete processed inputs")
    what = delete.add_mutually_exclusive_group(required=True)
    what.add_argument("--feed", help="a folder that has been read")
    what.add_argument("--prefix", help="everything whose path begins so")
    delete.add_argument("--read-by", help="only files that finished runs of this table have read")

    compact = jobs.add_parser("compact", help="merge what many runs have written into another folder")
    which = compact.add_mutually_exclusive_group(required=True)
    which.add_argument("--dimension")
    which.add_argument("--marts")
    compact.add_argument("--into", required=True)

    prune = jobs.add_parser("prune", help="delete attempts of runs that do not count")
    prune.add_argument("--table", required=True)
    prune.add_argument("--hours", type=float, default=24, help="only those last written so long ago")
    return top


def run_job(spark: SparkSession, args: argparse.Namespace) -> dict:
    if args.job == "generate":
        if args.seed is None:
            args.seed = secrets.randbits(31)
        customers = synthetic.customers(spark, args.customers, args.seed)
        transactions = synthetic.transactions(
            spark, args.transactions, args.customers, args.seed, utc_now().year
        )
        if args.dirt:
            customers = synthetic.with_dirty_ages(customers, args.dirt, args.seed)
            transactions = synthetic.with_dirt(transactions, args.dirt, args.seed)
        write_feed(customers, f"{args.out}/customers")
        write_feed(transactions, f"{args.out}/transactions")
        return {"customers": args.customers, "transactions": args.transactions, "seed": args.seed}
    if args.job == "delete":
        path, prefix = args.feed or args.prefix, bool(args.prefix)
        if args.read_by:
            return {"deleted": delete_consumed(spark, path, args.read_by, prefix)}
        return {"deleted": delete_feed(spark, path, prefix)}
    if args.job == "compact":
        if args.dimension:
            return {"written": compact_dimension(spark, args.dimension, args.into)}
        compact_marts(spark, args.marts, args.into)
        return {"written": args.into}
    if args.job == "prune":
        return {"deleted": prune_attempts(spark, args.table, timedelta(hours=args.hours))}

    run_time = args.run_time or utc_now()
    run_id = args.run_id or run_id_for(run_time)
    if args.job == "marts":
        if args.deltas:
            if args.run_id or args.exact or args.lookback_hours:
                raise SystemExit("--deltas keeps all runs: it goes with no --run-id, --exact or --lookback-hours")
            return {"runs": keep_marts(spark, args.table, args.marts)}
        if args.lookback_hours:
            run_marts_lookback(
                spark, args.table, args.marts, run_id, run_time, args.lookback_hours, args.exact
            )
            return {"runs": [run_id]}
        named = [args.run_id] if args.run_id else None
        return {"runs": run_marts(spark, args.table, args.marts, named, args.exact)}
    codes: str | list[str] = args.currency_path or args.currency_table
    if args.currencies is not None:
        codes = [c for c in args.currencies.split(",") if c]
    shared = {
        "table": args.table, "currencies": codes, "currency_table": bool(args.currency_table), "dimension": args.dimension,
        "limits": Limits(args.min_amount, args.min_age, args.max_age), "catalog": args.catalog, "run_time": run_time,
    }
    if args.job == "orphans":
        run = EtlRun(run_id=args.run_id or f"{run_id}-orphans", customers=None, transactions="", **shared)
        return {"run_id": run.run_id, **judge_orphans_again(spark, run)}
    if args.size:
        feeds = filter(None, (args.customers, args.transactions))
        size_session(spark, *[f"{f}*" if args.prefix else f for f in feeds])
    run = EtlRun(
        run_id=run_id,
        customers=args.customers,
        transactions=args.transactions,
        prefix=args.prefix,
        skip_seen_hours=args.skip_seen_hours,
        double_amounts=args.double_amounts,
        rebalance=args.rebalance,
        cluster=[c for c in args.cluster.split(",") if c],
        named=args.run_id is not None,
        new_files=args.new_files,
        id_bits=args.id_bits,
        **shared,
    )
    return {"run_id": run_id, **run_etl(spark, run)}


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or build_session(f"veriledger-{args.job}")
    print(json.dumps(run_job(spark, args)))


if __name__ == "__main__":
    main()
