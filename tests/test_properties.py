"""The job against a plain Python model on random small feeds."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from veriledger.operators import rules
from veriledger.operators.marts import (
    customer_partials,
    merge_customer_partials,
    transactions_per_customer,
)
from veriledger.plans.etl import classified
from veriledger.schemas import CUSTOMER_DDL, TRANSACTION_DDL, column_names

CODES = ["GEL", "USD"]
AMOUNTS = [None, 0.25, 0.5, 10.0, float("nan")]

transaction = st.fixed_dictionaries(
    {
        "transaction_id": st.sampled_from(["a", "b", "c", "d", "e", "f", "NaN", None]),
        "currency": st.sampled_from(["GEL", "USD", "ZZZ", None]),
        "amount": st.sampled_from(AMOUNTS),
        "total_amount": st.sampled_from(AMOUNTS),
        "customer_id": st.sampled_from(["c1", "c2", "c3", "gone", "nan", None]),
    }
)
customer = st.fixed_dictionaries(
    {
        "customer_id": st.sampled_from(["c1", "c2", "c3", "nan", None]),
        "age": st.sampled_from([None, 13, 14, 50, 100, 101]),
    }
)


def smallest(rows, key, order):
    """One row per key, NULLs first and NaN last."""

    def rank(row):
        values = [row[c] for c in order]
        return [
            (0,) if v is None else (2,) if isinstance(v, float) and math.isnan(v) else (1, v)
            for v in values
        ]

    kept = {}
    for row in rows:
        if row[key] not in kept or rank(row) < rank(kept[row[key]]):
            kept[row[key]] = row
    return list(kept.values())


def at_least(value, bound):
    return None if value is None else (math.isnan(value) or value >= bound)


def conjunction(values):
    return False if False in values else None if None in values else True


def verdict(row, ages):
    if row["customer_id"] is None or row["customer_id"] not in ages:
        return "orphan"
    age = ages[row["customer_id"]]
    outcome = conjunction(
        [
            row["transaction_id"] != "NaN",
            row["customer_id"] != "nan",
            at_least(row["amount"], 0.5),
            at_least(row["total_amount"], 0.5),
            None if row["currency"] is None else row["currency"] in CODES,
            None if age is None else 14 <= age <= 100,
        ]
    )
    return {True: "valid", False: "invalid", None: "indeterminate"}[outcome]


def frame(spark, rows, ddl):
    return spark.createDataFrame([[r.get(c) for c in column_names(ddl)] for r in rows], ddl)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(transaction, min_size=1, max_size=30), st.lists(customer, min_size=1, max_size=10))
def test_verdicts_and_marts_match_the_model(spark, txs, customers):
    rows = classified(
        frame(spark, txs, TRANSACTION_DDL), frame(spark, customers, CUSTOMER_DDL), CODES, rules.default_rules()
    )
    got = rows.collect()
    ages = {c["customer_id"]: c["age"] for c in smallest(customers, "customer_id", ["age"])}
    order = [c for c in column_names(TRANSACTION_DDL) if c in txs[0] and c != "transaction_id"]
    kept = smallest(txs, "transaction_id", order)
    model = sorted(
        (str(r["transaction_id"]), str(r["customer_id"]), str(r["amount"]), verdict(r, ages))
        for r in kept
    )
    ours = sorted((str(r.transaction_id), str(r.customer_id), str(r.amount), r.verdict) for r in got)
    assert ours == model

    valid = rows.where("verdict = 'valid'").cache()
    whole = sorted(map(str, transactions_per_customer(valid).collect()))
    halves = [valid.where("transaction_id < 'c'"), valid.where("transaction_id >= 'c' or transaction_id is null")]
    merged = merge_customer_partials(customer_partials(halves[0]).union(customer_partials(halves[1])))
    assert sorted(map(str, merged.collect())) == whole
    valid.unpersist()
