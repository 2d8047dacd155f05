"""Declared schemas of the feeds and of the tables built from them.

Schemas are DDL text, which every Spark reader accepts.  Columns are nullable
throughout: file readers ignore NOT NULL, so required values are checked by the
quality rules and not by the reader.
"""

from __future__ import annotations

# Names, order and types of the two feeds.
CUSTOMER_DDL = """
    customer_id string, age int, fullname string, job string, marital string,
    balance float, housing string, loan boolean, contact string, gender string,
    credit_score int, geography string, number_of_products int, tenure int,
    loan_number int
"""

TRANSACTION_DDL = """
    currency string, transaction_id string, timestamp timestamp, amount float,
    total_amount float, status string, customer_id string, merchant_id string,
    city string, deposit_method string, installment boolean,
    installment_amount float, bank_interest float
"""

CURRENCY_DDL = "currency_code string"

# The reader puts a line (or the line around a badly typed field) here.
RAW_LINE = "_corrupt_record"


def column_names(ddl: str) -> list[str]:
    """Column names of a flat DDL schema, in order."""
    return [field.split()[0] for field in ddl.split(",")]


def with_raw_line(ddl: str) -> str:
    """The schema plus the column in which the JSON reader keeps bad lines."""
    return f"{ddl}, {RAW_LINE} string"


def retyped(ddl: str, types: dict[str, str]) -> str:
    """The schema with the types of some columns replaced."""
    fields = [field.split() for field in ddl.split(",")]
    return ", ".join(f"{name} {types.get(name, kind)}" for name, kind in fields)


CUSTOMER_COLUMNS = column_names(CUSTOMER_DDL)
TRANSACTION_COLUMNS = column_names(TRANSACTION_DDL)

# The judged table: both feeds side by side, plus what the run adds.
JUDGED_DDL = (
    retyped(TRANSACTION_DDL, {"amount": "double", "total_amount": "double"})
    + ", "
    + ", ".join(f.strip() for f in CUSTOMER_DDL.split(",")[1:])
    + ", upload_time timestamp"
)
JUDGED_COLUMNS = column_names(JUDGED_DDL)

# Columns a run table adds; the last three are directory levels.
RUN_TABLE_DDL = (
    JUDGED_DDL
    + f", reasons array<string>, {RAW_LINE} string"
    + ", run_id string, verdict string, upload_hour timestamp"
)

PER_CUSTOMER_DDL = (
    "customer_id string, num_transactions bigint, total_amount double, "
    "average_transaction_amount double"
)
PER_MERCHANT_DDL = "merchant_id string, num_transactions bigint, total_sales double"
MONTHLY_DDL = "transaction_month int, num_transactions bigint, total_amount double"

# The directory levels of a run table, outermost first.
RUN_LEVELS = ("run_id", "verdict", "upload_hour")
