"""Hand-made feed rows, one per case of the rules."""

import json
from datetime import datetime

RUN_TIME = datetime(2024, 3, 1, 12, 34, 56)

CUSTOMERS = [
    {"customer_id": "c1", "age": 30, "gender": "male"},
    {"customer_id": "c2", "age": None, "gender": None},
    {"customer_id": "c3", "age": 30.5, "gender": "Male"},
    {"customer_id": "c4", "age": 13, "gender": "other", "job": ""},
    {"customer_id": "c14", "age": 14, "gender": "female"},
    {"customer_id": "c100", "age": 100, "gender": "female"},
    {"customer_id": "c101", "age": 101, "gender": "female"},
    {"customer_id": None, "age": 40},
    {"customer_id": "NaN", "age": 40},
]

BASE = {
    "currency": "GEL",
    "timestamp": "2024-03-01 10:00:00",
    "amount": 10,
    "total_amount": 11,
    "customer_id": "c1",
}

# (transaction id, changed fields, expected verdict)
CASES = [
    ("ok-1", {"amount": 10.1, "city": None}, "valid"),
    ("edge", {"amount": 0.5, "total_amount": 0.5}, "valid"),
    ("low", {"amount": 0.49}, "invalid"),
    ("low-total", {"total_amount": 0.49}, "invalid"),
    ("nan-amount", {"amount": "NaN"}, "valid"),
    ("null-amount", {"amount": None}, "indeterminate"),
    ("null-total", {"total_amount": None}, "indeterminate"),
    ("str-amount", {"amount": "12.5"}, "indeterminate"),
    ("null-cur", {"currency": None}, "indeterminate"),
    ("null-cur-low", {"currency": None, "amount": 0.1}, "invalid"),
    ("bad-cur", {"currency": "ZZZ"}, "invalid"),
    (None, {}, "valid"),
    ("NaN", {}, "invalid"),
    ("nan-customer", {"customer_id": "NaN"}, "invalid"),
    ("null-age", {"customer_id": "c2"}, "indeterminate"),
    ("age-frac", {"customer_id": "c3", "timestamp": "bad ts"}, "indeterminate"),
    ("young", {"customer_id": "c4"}, "invalid"),
    ("age-14", {"customer_id": "c14"}, "valid"),
    ("age-100", {"customer_id": "c100"}, "valid"),
    ("age-101", {"customer_id": "c101"}, "invalid"),
    ("orphan", {"customer_id": "c9"}, "orphan"),
    ("no-customer", {"customer_id": None}, "orphan"),
]

MALFORMED = ["{broken", "not json either"]


def transactions():
    return [{**BASE, "transaction_id": name, **change} for name, change, _ in CASES]


def write_lines(folder, records, extra_lines=(), name="part-0.json"):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps(r) for r in records] + list(extra_lines)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)
