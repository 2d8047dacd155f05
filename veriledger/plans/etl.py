"""The transactions job: read, deduplicate, clean, join, judge, write once.

The run is one Spark job over one plan.  Every transaction read ends up in exactly one
verdict partition (valid, invalid, indeterminate, orphan or malformed), all rows carry the
same upload time, and repeating a run replaces its rows.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veriledger.functions.times import lookback_start, start_of_hour
from veriledger.operators.cleaning import clean_customers, clean_transactions
from veriledger.operators.clustering import clustered
from veriledger.operators.dedup import drop_seen, keep_smallest
from veriledger.operators.joins import flag_currency, with_customers, with_known_customers
from veriledger.operators.profile import PROFILE_DDL, compared, merged_profiles, profile_of
from veriledger.operators.rules import (
    INDETERMINATE,
    INVALID,
    VALID,
    Limits,
    Rule,
    checked,
    default_rules,
    reasons_of,
    verdict_of,
)
from veriledger.operators.sketch import BITMAP_DDL, bitmap_of, merged_bitmaps, possibly_in
from veriledger.schemas import (
    CUSTOMER_COLUMNS,
    JUDGED_COLUMNS,
    RAW_LINE,
    RUN_LEVELS,
    RUN_TABLE_DDL,
    TRANSACTION_COLUMNS,
)
from veriledger.session import broadcast_bytes, pin_session, planned_bytes, shared_folder
from veriledger.sources.catalog import keep_registered
from veriledger.sources.dimension_table import read_dimension, write_customer_versions
from veriledger.sources.feeds import (
    feed_files,
    read_currencies,
    read_customers_with_raw,
    read_transactions_with_raw,
)
from veriledger.sources.run_tables import (
    attempts,
    check_owner,
    consumed_files,
    free_run_id,
    lookback,
    manifests,
    read_attempts,
    read_beside,
    read_manifest,
    read_runs,
    write_run,
)

log = logging.getLogger(__name__)

ORPHAN, MALFORMED = "orphan", "malformed"
JUDGED = (VALID, INVALID, INDETERMINATE)
# More characters than a text can have.
_WHOLE = 2**31 - 1
VERDICTS = (*JUDGED, ORPHAN, MALFORMED)

Codes = DataFrame | Sequence[str]


def enriched(transactions: DataFrame, customers: DataFrame, codes: Codes) -> DataFrame:
    """Deduplicated, cleaned transactions with their customers and the currency flag."""
    tx = clean_transactions(keep_smallest(transactions, ["transaction_id"]))
    cu = clean_customers(keep_smallest(customers, ["customer_id"]))
    return with_customers(flag_currency(tx, codes), cu)


def classified(
    transactions: DataFrame,
    customers: DataFrame,
    codes: Codes,
    rules: Sequence[Rule],
    unique_customers: bool = False,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Every distinct transaction with its verdict and reasons, but for ids ``seen`` before.

    ``transactions`` may carry the raw line of malformed input.  Such lines are told apart
    by their text, so they neither collapse into one NULL id nor displace a good row.
    """
    if RAW_LINE not in transactions.columns:
        transactions = transactions.withColumn(RAW_LINE, F.lit(None).cast("string"))
    # One key for both kinds of rows, so that what follows can go on in its partitions.  The id travels in
    # it alone, behind one letter: what sorts compare first is then nearly all of the id.
    line, own = F.col(RAW_LINE), F.col("transaction_id")
    key = F.coalesce(F.concat(F.lit("l"), line), F.concat(F.lit("i"), own))
    keyed = transactions.withColumn("__key", key).withColumn("transaction_id", F.when(line.isNotNull(), own))
    tx = keep_smallest(keyed, ["__key"])
    if seen is not None:
        tx = drop_seen(tx, seen.select(F.concat(F.lit("i"), "transaction_id").alias("__key")), "__key")
    tx = tx.withColumn("transaction_id", F.when(line.isNull(), F.substring("__key", 2, _WHOLE)).otherwise(own))
    tx = flag_currency(clean_transactions(tx.drop("__key")), codes)
    if not unique_customers:
        customers = keep_smallest(customers, ["customer_id"])
    cu = clean_customers(customers.select(*CUSTOMER_COLUMNS)).withColumn("__known", F.lit(True))
    joined, results = checked(with_known_customers(tx, cu), rules)

    known = F.col("__known").isNotNull()
    verdict = (
        F.when(F.col(RAW_LINE).isNotNull(), MALFORMED)
        .when(~known, ORPHAN)
        .otherwise(verdict_of(results))
    )
    reasons = F.when(known, reasons_of(results)).otherwise(F.array().cast("array<string>"))
    customer_fields = [c for c in CUSTOMER_COLUMNS if c != "customer_id"]
    return joined.select(
        *TRANSACTION_COLUMNS,
        *customer_fields,
        RAW_LINE,
        reasons.alias("reasons"),
        verdict.alias("verdict"),
    )


def stamped(classified_rows: DataFrame, run_time: datetime) -> DataFrame:
    """The same upload time for all rows of the run, and the hour it falls in."""
    return classified_rows.withColumns(
        {
            "upload_time": F.lit(str(run_time)).cast("timestamp"),
            "upload_hour": F.lit(str(start_of_hour(run_time))).cast("timestamp"),
        }
    ).select(*JUDGED_COLUMNS, "reasons", RAW_LINE, "verdict", "upload_hour")


@dataclass(frozen=True)
class EtlRun:
    """What one run reads and writes.

    ``currencies`` is a list of codes, a Parquet path or a table; ``currency_table`` says which
    of the latter, else a slash tells.  With ``skip_seen_hours``
    ids that earlier runs uploaded within that time are left out.  ``dimension`` names the
    folder of accumulated customers; without it a transaction meets only the customers in
    the feed of its own run.  ``double_amounts`` reads amounts without rounding to float.
    ``rebalance`` spends one more shuffle on even files: otherwise each task of the join
    writes a file of its own for every verdict it meets, most of them small.  ``rules`` takes
    the place of the default rules and their ``limits``.  A run that is not ``named``, whose id
    is just its time slot, never replaces a run: it takes the next free id and reads only
    the transaction files that no finished run of the table has read, and so does a named one
    with ``new_files``.  ``owner`` signs the run; one signed by another owner is not replaced.
    ``catalog`` is the name of a table of the session catalog to be kept over the run table.
    With ``id_bits`` a run keeps a bitmap of so many bits of the ids it judged, and the search
    for ids seen before looks only for those that the bitmaps of the runs do not rule out.
    With ``profile`` sketches of each verdict are stored beside the run, see ``run_profiles``.
    ``cluster`` names columns whose neighbours are to be kept together in the files of a verdict, so
    that a search by any of them opens few row groups; the rows are then written twice.
    """

    run_id: str
    run_time: datetime
    customers: str | None
    transactions: str
    table: str
    currencies: str | Sequence[str]
    limits: Limits = field(default_factory=Limits)
    prefix: bool = False
    dimension: str | None = None
    skip_seen_hours: float | None = None
    double_amounts: bool = False
    rebalance: bool = False
    rules: Sequence[Rule] | None = None
    named: bool = True
    new_files: bool = False
    owner: str | None = None
    catalog: str | None = None
    id_bits: int = 0
    currency_table: bool | None = None
    profile: bool = False
    cluster: Sequence[str] = ()


# Beside the rows of an attempt: a bitmap of the ids it judged.
_SEEN, _SEEN_DDL = "_seen", f"bits bigint, {BITMAP_DDL}"
# And the profiles of its verdicts.
_PROFILE = "_profile"


def _judged_bitmap(bits: int) -> Callable[[DataFrame], DataFrame]:
    def make(stored: DataFrame) -> DataFrame:
        ids = stored.where(F.col("verdict").isin(*JUDGED))
        return bitmap_of(ids, "transaction_id", bits).select(F.lit(bits).cast("bigint").alias("bits"), "bitmap_row", "bitmap")

    return make


def seen_ids(spark: SparkSession, run: EtlRun, transactions: DataFrame | None = None) -> DataFrame:
    """Ids other runs judged in the hours before this one.

    Orphans were not judged: one that is sent again may have a customer by now.  With ``id_bits``
    only those of ``transactions``: the bitmaps of the runs rule out nearly all ids that are
    new, and the rows of the runs are searched for the others alone, or not at all if none
    is left.  Should a run have no bitmap of that size, or should so many ids be left that Spark
    would not broadcast them, all ids are taken: to search for many would shuffle both
    sides once more, before the caller does so again to drop what was seen.
    """
    since = lookback_start(run.run_time, run.skip_seen_hours)
    runs = [pair for pair in attempts(spark, run.table, since=since) if pair[0] != run.run_id]
    recent = lookback(read_attempts(spark, run.table, RUN_TABLE_DDL, runs), run.run_time, run.skip_seen_hours)
    ids = recent.where(
        F.col("verdict").isin(*JUDGED) & (F.col("upload_time") < F.lit(str(run.run_time)))
    ).select("transaction_id")
    if not run.id_bits or transactions is None or not runs:
        return ids
    counted = F.col("bits") == run.id_bits
    bitmaps = read_beside(spark, run.table, _SEEN, _SEEN_DDL).where(F.col("attempt").isin([a for _, a in runs]))
    if bitmaps.where(counted).select("attempt").distinct().count() < len(runs):
        return ids
    possible = possibly_in(transactions.select("transaction_id"), "transaction_id", merged_bitmaps(bitmaps), run.id_bits)
    path = shared_folder(spark, "possibly-seen")
    # An id may be there several times: it is asked for all the same, and no row is shuffled for that.
    possible.write.option("compression", "zstd").parquet(path)
    asked = spark.read.schema("transaction_id string").parquet(path)
    if asked.isEmpty():
        return asked
    if planned_bytes(asked) > broadcast_bytes(spark):
        return ids
    # Few ids: Spark broadcasts them, and nothing of the runs but hits is shuffled.
    return ids.join(asked, "transaction_id", "left_semi")


def stored_orphans(spark: SparkSession, run: EtlRun) -> DataFrame:
    """Orphans of finished runs that no run has judged since, as a feed.

    Their amounts are those of the run table, already cleaned.
    """
    table = read_runs(spark, run.table, RUN_TABLE_DDL).where(F.col("run_id") != run.run_id)
    judged = table.where(F.col("verdict").isin(*JUDGED)).select("transaction_id")
    waiting = table.where(F.col("verdict") == ORPHAN).select(*TRANSACTION_COLUMNS)
    return drop_seen(keep_smallest(waiting, ["transaction_id"]), judged, "transaction_id")


def judge_orphans_again(spark: SparkSession, run: EtlRun) -> dict[str, int]:
    """Judge stored orphans against the dimension as it is now; what stays orphan is written too."""
    customers = read_dimension(spark, run.dimension)
    return run_on(spark, stored_orphans(spark, run), customers, run, unique_customers=True)


def _observed(observation: Observation) -> dict[str, int]:
    """What a finished job observed; empty if it never had to read the observed rows.

    A join with an empty side is dropped from the plan, and the observation with it; asking
    for its values is then an error on the JVM side.
    """
    try:
        return dict(observation.get)
    except Py4JJavaError:
        return {}


def run_on(
    spark: SparkSession,
    transactions: DataFrame,
    customers: DataFrame,
    run: EtlRun,
    unique_customers: bool = False,
    consumed: DataFrame | None = None,
) -> dict[str, int]:
    """Judge the given frames and write them as the run; returns rows per verdict.

    The counts are observed while writing, so they cost no job of their own.  ``consumed``
    lists the files the transactions come from; it counts once the run does.
    """
    seen = None if run.skip_seen_hours is None else seen_ids(spark, run, transactions)
    codes = run.currencies
    if isinstance(codes, str):
        codes = read_currencies(spark, codes, run.currency_table)
    rules = default_rules(run.limits) if run.rules is None else run.rules
    rows = classified(transactions, customers, codes, rules, unique_customers, seen)
    counts = Observation(f"verdicts-{run.run_id}")
    observed = stamped(rows, run.run_time).observe(
        counts, *[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS]
    )
    if run.rebalance:
        observed = observed.hint("rebalance", "verdict")
    report: dict[str, int] = {}

    def counted() -> dict[str, int]:
        report.update({verdict: 0 for verdict in VERDICTS} | _observed(counts))
        return report

    beside = {_SEEN: _judged_bitmap(run.id_bits)} if run.id_bits else {}
    if run.profile:
        beside[_PROFILE] = profile_of
    path = write_run(
        observed, run.table, run.run_id, ["verdict", "upload_hour"], owner=run.owner,
        times=(run.run_time, run.run_time), counts=counted, consumed=consumed,
        beside=beside, order=(lambda rows: clustered(rows, run.cluster, ["verdict"])) if run.cluster else None,
    )
    if run.catalog:
        keep_registered(spark, run.catalog, run.table, RUN_TABLE_DDL, RUN_LEVELS, run.run_id, path)
    log.info("run %s written to %s: %s", run.run_id, path, report)
    return report


def _unread(spark: SparkSession, feed: str, run: EtlRun, table: str) -> DataFrame:
    """The files of a feed that no other finished run of a table has read, as they are now."""
    files = feed_files(spark, feed, run.prefix)
    return files.join(consumed_files(spark, table, run.run_id), files.columns, "left_anti")


def _pinned(spark: SparkSession, files: DataFrame) -> tuple[DataFrame, list[str]]:
    """A list of files that stays as it is now, and its paths; one row a file of the run."""
    rows = files.collect()
    return spark.createDataFrame(rows, files.schema), [r.path for r in rows]


def run_etl(spark: SparkSession, run: EtlRun) -> dict[str, int]:
    """One batch run from the JSON feeds; returns rows per verdict and bad customer lines.

    A run that reads only new files and finds none writes nothing.  Files that land while a
    run is working belong to a later one, since the files of a run are listed at its start.
    """
    pin_session(spark)
    if run.customers is None and run.dimension is None:
        raise ValueError("a run needs a customer feed or a dimension")
    latest = run.run_id
    if not run.named:
        run = replace(run, run_id=free_run_id(spark, run.table, run.run_id))
    only_new = run.new_files or not run.named
    if only_new:
        files, paths = _pinned(spark, _unread(spark, run.transactions, run, run.table))
        if not paths:
            log.info("no new files in %s: run %s is not written", run.transactions, run.run_id)
            nothing = {verdict: 0 for verdict in VERDICTS}
            return nothing if run.named else {"run_id": latest, **nothing}
    else:
        files, paths = _pinned(spark, feed_files(spark, run.transactions, run.prefix))
    check_owner(spark, run.table, run.run_id, run.owner)
    transactions = read_transactions_with_raw(spark, paths, False, run.double_amounts)
    customers, bad_lines = None, None
    if run.customers:
        # Without a dimension all customers of the feed are wanted, however often they were read.
        known, sources = feed_files(spark, run.customers, run.prefix), None
        if run.dimension and only_new:
            known = _unread(spark, run.customers, run, run.dimension)
        sources, customer_paths = _pinned(spark, known)
        feed = read_customers_with_raw(spark, customer_paths)
        bad_lines = Observation(f"customers-{run.run_id}")
        bad = F.count_if(F.col(RAW_LINE).isNotNull()).alias("malformed_customers")
        customers = feed.observe(bad_lines, bad).where(F.col(RAW_LINE).isNull()).drop(RAW_LINE)
    if run.dimension:
        if customers is not None:
            write_customer_versions(customers, run.dimension, run.run_id, run.run_time, run.owner, sources)
        customers = read_dimension(spark, run.dimension)
    report = run_on(spark, transactions, customers, run, unique_customers=bool(run.dimension), consumed=files)
    if bad_lines is not None:
        report |= _observed(bad_lines)
        if report.get("malformed_customers"):
            log.warning("run %s: %d unreadable customers", run.run_id, report["malformed_customers"])
    return {"run_id": run.run_id, **report} if not run.named else report


def run_profiles(spark: SparkSession, table: str, since: datetime | None = None) -> DataFrame:
    """The profiles of a table's finished runs, one row a run and verdict; runs without one are left out.

    No row of a run is read, only the sketches beside it.
    """
    live = manifests(spark, table, since).select("attempt", "run_id", "to_time")
    return read_beside(spark, table, _PROFILE, PROFILE_DDL).join(live, "attempt").drop("attempt")


def compare_run(spark: SparkSession, table: str, run_id: str, hours: float | None = None) -> DataFrame:
    """A run beside the runs before it, or those of the ``hours`` before it, verdict by verdict."""
    held = read_manifest(spark, table, run_id)
    if held is None:
        raise ValueError(f"run {run_id} of {table} has not been written to its end")
    moment = datetime.fromisoformat(held["to_time"])
    profiles = run_profiles(spark, table, None if hours is None else lookback_start(moment, hours))
    mine = F.col("run_id") == run_id
    earlier = profiles.where(~mine & (F.col("to_time") < F.lit(str(moment)).cast("timestamp")))
    return compared(profiles.where(mine).drop("run_id", "to_time"), merged_profiles(earlier))


def read_verdict(spark: SparkSession, table: str, verdict: str, run_ids=None) -> DataFrame:
    """One verdict of a run table; only its directories are read."""
    return read_runs(spark, table, RUN_TABLE_DDL, run_ids).where(F.col("verdict") == verdict)


def create_views(spark: SparkSession, table: str, prefix: str = "") -> list[str]:
    """One temporary view per verdict over a run table, for SQL users."""
    names = [f"{prefix}{verdict}_transactions" for verdict in VERDICTS]
    for name, verdict in zip(names, VERDICTS, strict=True):
        read_verdict(spark, table, verdict).createOrReplaceTempView(name)
    return names


def run_id_for(moment: datetime, every: timedelta = timedelta(hours=6)) -> str:
    """The id of the scheduled slot a moment falls in, so a late start keeps its id."""
    day = moment.replace(hour=0, minute=0, second=0, microsecond=0)
    slot = day + ((moment - day) // every) * every
    return slot.strftime("%Y%m%dT%H%M%S")
