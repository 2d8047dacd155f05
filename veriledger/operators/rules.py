"""Quality rules and the verdict of a row under them.

A rule is a named three-valued condition: true, false or NULL (unknown).  A row is
*valid* if all rules are true, *invalid* if at least one is false, and *indeterminate*
otherwise: no rule is false but one could not be decided.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriledger.functions.text import reads_as_nan

VALID, INVALID, INDETERMINATE = "valid", "invalid", "indeterminate"


@dataclass(frozen=True)
class Rule:
    name: str
    check: Column


@dataclass(frozen=True)
class Limits:
    """The bounds of the default rules, all inclusive."""

    min_amount: float = 0.5
    min_age: int = 14
    max_age: int = 100


def id_rules() -> list[Rule]:
    """Ids must not be the text NaN; a NULL id passes."""
    return [
        Rule("transaction_id_not_nan", ~reads_as_nan(F.col("transaction_id"))),
        Rule("customer_id_not_nan", ~reads_as_nan(F.col("customer_id"))),
    ]


def amount_rule(limits: Limits = Limits()) -> Rule:
    """Both amounts reach the minimum; NaN sorts above all numbers and passes."""
    return Rule(
        "min_amount",
        (F.col("amount") >= limits.min_amount) & (F.col("total_amount") >= limits.min_amount),
    )


def currency_rule(flag: str = "currency_ok") -> Rule:
    """The currency is in the reference table; reads the flag set by ``flag_member``."""
    return Rule("known_currency", F.col(flag))


def age_rule(limits: Limits = Limits()) -> Rule:
    return Rule("age_range", F.col("age").between(limits.min_age, limits.max_age))


def default_rules(limits: Limits = Limits()) -> list[Rule]:
    return [*id_rules(), amount_rule(limits), currency_rule(), age_rule(limits)]


def all_hold(rules: Sequence[Rule]) -> Column:
    """The three-valued conjunction of the rules."""
    return reduce(and_, [r.check for r in rules], F.lit(True))


def only(df: DataFrame, rules: Sequence[Rule], verdict: str) -> DataFrame:
    """The rows of one verdict, as a plain filter that Catalyst can push into the inputs."""
    holds = all_hold(rules)
    condition = {VALID: holds, INVALID: ~holds, INDETERMINATE: holds.isNull()}[verdict]
    return df.where(condition)


def checked(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, list[Rule]]:
    """The rules evaluated once per row, as columns, and rules that read those columns.

    A verdict and its reasons use each rule several times.
    """
    names = {f"__rule_{i}": rule for i, rule in enumerate(rules)}
    frame = df.withColumns({column: rule.check for column, rule in names.items()})
    return frame, [Rule(rule.name, F.col(column)) for column, rule in names.items()]


def verdict_of(rules: Sequence[Rule]) -> Column:
    holds = all_hold(rules)
    return F.when(holds, VALID).when(~holds, INVALID).otherwise(INDETERMINATE)


def reasons_of(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules, and of the undecided ones as ``unknown:<name>``."""
    notes = [
        F.when(~r.check, r.name).when(r.check.isNull(), f"unknown:{r.name}") for r in rules
    ]
    return F.array_compact(F.array(*notes))


def judge(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``verdict`` and ``reasons``."""
    frame, results = checked(df, rules)
    return frame.select(
        *df.columns, verdict_of(results).alias("verdict"), reasons_of(results).alias("reasons")
    )


def reason_counts(judged: DataFrame) -> DataFrame:
    """How many rows each reason applies to."""
    return (
        judged.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("num_rows"))
    )


def verdict_counts(judged: DataFrame) -> DataFrame:
    """Rows and amount per verdict: the quality report of a run."""
    return judged.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count("transaction_id").alias("num_ids"),
        F.sum("amount").alias("total_amount"),
    )
