"""Marts that are kept up to date by deltas, so that reading them merges few partials.

Layout of a mart: ``<mart>/run_id=<run>.<attempt>/attempt=…/sign=…``.  Each judged attempt adds one
delta: its own partial (sign 1) and, if it takes the place of an earlier attempt of the run,
that one's partial with all numbers negated (sign -1).  Both count from the same moment, so
a reader sees a repeated run either as it was or as it is.  Amounts are reproducible sums,
of which a part can be taken away again without a trace, NaN and infinities included.

Once ``FAN`` deltas of a tier have gathered they are merged into one of the next tier (sign 0).
The manifest of the merged one names its members, which count no more from that moment.
The folders of deltas stay, as their partials are what a later retraction needs.
One job at a time keeps the marts of a folder; any number may read them.
"""

from __future__ import annotations

import hashlib
import logging

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from veriledger.operators import marts
from veriledger.operators.exact_sums import TOTAL, exact_totals, merged_totals, negated
from veriledger.operators.rules import VALID
from veriledger.plans.marts import TOTALS
from veriledger.schemas import RUN_TABLE_DDL
from veriledger.session import pin_session
from veriledger.sources.run_tables import GENERATION, manifests, read_attempts, retire_run, write_run

log = logging.getLogger(__name__)

FAN = 8
_TIER = "tier"
_COUNTS = ("num_transactions", "num_rows")


def _ddl(name: str) -> str:
    key = TOTALS[name][0]
    kind = "int" if key == "transaction_month" else "string"
    return f"{key} {kind}, num_transactions bigint, num_rows bigint, amounts {TOTAL}, run_id string, sign int"


def _named(totals: DataFrame) -> DataFrame:
    return totals.withColumnsRenamed({f"__m{i}": c for i, c in enumerate(_COUNTS)})


def delta_of(valid: DataFrame, name: str) -> DataFrame:
    """What some valid rows add to a mart; the number of rows tells whether a key is there at all."""
    key, made, _, _ = TOTALS[name]
    rows = valid.withColumn(key, F.expr(made))
    return _named(exact_totals(rows, [key], "amount", "amounts", F.count("transaction_id"), F.count(F.lit(1))))


def negated_delta(delta: DataFrame) -> DataFrame:
    return delta.withColumns({**{c: -F.col(c) for c in _COUNTS}, "amounts": negated("amounts")})


def merged_deltas(deltas: DataFrame, name: str) -> DataFrame:
    """The sum of deltas; keys of which nothing is left drop out."""
    key = TOTALS[name][0]
    rows = deltas.select(key, *_COUNTS, "amounts")
    total = _named(merged_totals(rows, [key], "amounts", *[F.sum(c) for c in _COUNTS]))
    return total.where(~_nothing())


def _nothing() -> Column:
    zero = (F.size("amounts.digits") == 0) & (F.col("amounts.n") == 0)
    for part in (*_COUNTS, "amounts.nan", "amounts.plus", "amounts.minus"):
        zero &= F.col(part) == 0
    return zero


def _changed(spark: SparkSession, table: str, mart: str) -> list[Row]:
    """Judged attempts that the mart does not hold, each with the delta it takes the place of, if any."""
    deltas = manifests(spark, mart, retired=True).withColumn("generation", F.col("counts")[GENERATION])
    held = deltas.where("generation is not null").select(
        F.expr("left(run_id, length(run_id) - length(source) - 1)").alias("run_id"),
        "generation",
        F.struct(F.col("run_id").alias("delta"), "attempt", "source").alias("held"),
    )
    newest = held.groupBy("run_id").agg(
        F.max_by("held", "generation").alias("held"), F.max("generation").alias("generation")
    )
    judged = manifests(spark, table, retired=True).select("run_id", "attempt")
    changed = judged.join(newest, "run_id", "left").where(~F.col("attempt").eqNullSafe(F.col("held.source")))
    return changed.orderBy("run_id").collect()  # a few short texts for each run to be summarised


def _add(spark: SparkSession, table: str, mart: str, name: str, change: Row) -> None:
    judged = read_attempts(spark, table, RUN_TABLE_DDL, [(change.run_id, change.attempt)])
    delta = delta_of(judged.where(F.col("verdict") == VALID), name).withColumn("sign", F.lit(1))
    generation = 0
    if change.held:
        before = read_attempts(spark, mart, _ddl(name), [(change.held.delta, change.held.attempt)])
        undone = negated_delta(before.where("sign = 1").drop("run_id"))
        delta = delta.unionByName(undone.withColumn("sign", F.lit(-1)))
        generation = change.generation + 1
    write_run(
        delta, mart, f"{change.run_id}.{change.attempt}", ["sign"], source=change.attempt,
        counts=lambda: {_TIER: 0, GENERATION: generation},
    )


def _live(spark: SparkSession, mart: str) -> tuple[list[Row], list[tuple[Row, str]]]:
    """Deltas that count, and those that do not, with the one they have become part of."""
    rows = manifests(spark, mart).select("run_id", "attempt", "source", F.col("counts")[_TIER].alias("tier")).collect()
    into = {member: row.run_id for row in rows if row.tier for member in row.source.split(",")}
    counting = sorted((r for r in rows if r.attempt not in into), key=lambda r: r.run_id)
    return counting, [(r, into[r.attempt]) for r in rows if r.attempt in into]


def merge_tiers(spark: SparkSession, mart: str, name: str, fan: int = FAN) -> list[str]:
    """Merge each tier with ``fan`` deltas into one of the next; returns the runs written."""
    written = []
    while True:
        counting, gone = _live(spark, mart)
        for member, into in gone:
            retire_run(spark, mart, member.run_id, member.attempt, into)
        tiers: dict[int, list[Row]] = {}
        for row in counting:
            tiers.setdefault(row.tier, []).append(row)
        full = sorted(t for t, members in tiers.items() if len(members) >= fan)
        if not full:
            return written
        tier, members = full[0], tiers[full[0]]
        source = ",".join(m.attempt for m in members)
        run_id = f"tier-{tier + 1}-{hashlib.sha256(source.encode()).hexdigest()[:32]}"
        rows = read_attempts(spark, mart, _ddl(name), [(m.run_id, m.attempt) for m in members])
        write_run(
            merged_deltas(rows, name).withColumn("sign", F.lit(0)), mart, run_id, ["sign"], source=source,
            counts=lambda tier=tier: {_TIER: tier + 1},
        )
        log.info("%d deltas of %s merged into %s", len(members), mart, run_id)
        written.append(run_id)


def keep_marts(spark: SparkSession, table: str, folder: str, fan: int = FAN) -> list[str]:
    """Bring the three marts up to the judged runs as they are now; returns the runs that had changed.

    Started again after a failure it goes on where it was: an attempt is added once to each mart.
    """
    if fan < 2:
        raise ValueError("a merge takes two deltas at least")
    pin_session(spark)
    changed = set()
    for name in TOTALS:
        mart = f"{folder}/{name}"
        for change in _changed(spark, table, mart):
            _add(spark, table, mart, name, change)
            changed.add(change.run_id)
        merge_tiers(spark, mart, name, fan)
    return sorted(changed)


def read_kept_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A mart that is kept by deltas, one row per key: the bits of one sum over all rows."""
    mart = f"{folder}/{name}"
    counting, _ = _live(spark, mart)
    deltas = read_attempts(spark, mart, _ddl(name), [(r.run_id, r.attempt) for r in counting])
    key, _, total, average = TOTALS[name]
    return marts.mart_of_totals(merged_deltas(deltas, name).where("num_rows > 0"), key, total, average)
