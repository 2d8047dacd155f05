"""The queries of ``registry`` as plain SQL over the same tables."""

from __future__ import annotations

from veriledger.plans import testbed

_TABLES = {n: n for n in ("events", "customer", "lineitem", "orders")}

ET = testbed.EVENT_TRANSACTIONS.format(**_TABLES)
EC = testbed.EVENT_CUSTOMERS.format(**_TABLES)
LT = testbed.LINE_TRANSACTIONS.format(**_TABLES)
LC = testbed.LINE_CUSTOMERS.format(**_TABLES)
DT = testbed.DIRTY_TRANSACTIONS.format(**_TABLES)

CODES = "('GEL', 'USD', 'EUR')"
# Rows without a time belong to the second run.
FIRST_RUN = "coalesce(timestamp < timestamp '1998-07-01 00:00:00', false)"

_TX_PAYLOAD = (
    "currency, timestamp, amount, total_amount, status, customer_id, merchant_id, city, "
    "deposit_method, installment, installment_amount, bank_interest"
)
_CU_PAYLOAD = (
    "age, fullname, job, marital, balance, housing, loan, contact, gender, credit_score, "
    "geography, number_of_products, tenure, loan_number"
)


def _first_of(source: str, key: str, payload: str) -> str:
    order = ", ".join(f"{c.strip()} asc nulls first" for c in payload.split(","))
    return f"""
        select * exclude (rn) from (
            select *, row_number() over (partition by {key} order by {order}) as rn
            from {source}) ranked
        where rn = 1"""


def _not_nan(column: str) -> str:
    return f"not coalesce(isnan(try_cast({column} as double)), false)"


_RULES = {
    "transaction_id_not_nan": _not_nan("transaction_id"),
    "customer_id_not_nan": _not_nan("customer_id"),
    "min_amount": "(amount >= 0.5 and total_amount >= 0.5)",
    "known_currency": f"(currency in {CODES})",
    "age_range": "(age >= 14 and age <= 100)",
}
_ALL_RULES = " and ".join(_RULES.values())


def _tri(condition: str) -> str:
    return f"case when {condition} then 'true' when not ({condition}) then 'false' else 'unknown' end"


def _line_pipeline(feed: str = LT, key: str = "transaction_id", customers: str = LC) -> str:
    """CTEs: td/cd without duplicates, tc/cc cleaned, lj joined with the outcome p, lo with orphans."""
    return f"""
    with lt as ({feed}),
    lc as ({customers}),
    td as ({_first_of("lt", key, _TX_PAYLOAD)}),
    cd as ({_first_of("lc", "customer_id", _CU_PAYLOAD)}),
    tc as (select * replace (coalesce(city, 'unknown') as city) from td),
    cc as (select * replace (
               coalesce(job, 'unknown') as job,
               coalesce(housing, 'unknown') as housing,
               coalesce(marital, 'unknown') as marital,
               case when gender in ('male', 'female', 'other') then gender
                    else 'unknown' end as gender) from cd),
    lj as (select *, {_ALL_RULES} as p from tc join cc using (customer_id)),
    lv as (select * exclude (p) from lj where p),
    lo as (select tc.*, cc.age,
                  case when cc.customer_id is null then 'orphan'
                       when {_ALL_RULES.replace("customer_id", "tc.customer_id")} then 'valid'
                       when not ({_ALL_RULES.replace("customer_id", "tc.customer_id")}) then 'invalid'
                       else 'indeterminate' end as verdict
           from tc left join cc on tc.customer_id = cc.customer_id)
    """


_LINE = _line_pipeline()

# Sums and averages of doubles, given out in cents and to four places off the ties.
_SUM = "round(sum(amount), 2)"
_AVERAGE = "round({} + 0.0000003, 4)"

_CUSTOMER_MART = f"""
    select customer_id, count(transaction_id) as num_transactions, {_SUM} as total_amount,
           {_AVERAGE.format("avg(amount)")} as average_transaction_amount
    from lv group by customer_id
"""
# The same from exact cents; the average of decimals has six places.
_EXACT_CUSTOMER_MART = f"""
    select customer_id, num_transactions, cents / 100.0::double as total_amount,
           {_AVERAGE.format("((cents * 20000 + num_amounts) // (2 * num_amounts))::double / 1000000::double")}
               as average_transaction_amount
    from (select customer_id, count(transaction_id) as num_transactions,
                 sum(case when not isnan(amount) then cast(round(amount * 100) as hugeint) end) as cents,
                 count(case when not isnan(amount) then 1 end) as num_amounts
          from lv group by customer_id) sums
"""
# The double nearest to a sum: amounts are whole multiples of 2^-60 here.
_NEAREST = """cast(cast(sum(cast(amount * 1152921504606846976.0::double as hugeint)) as varchar) as double)
              / 1152921504606846976.0::double"""
_MERCHANT_MART = f"""
    select merchant_id, count(transaction_id) as num_transactions,
           {_SUM} as total_sales
    from lv group by merchant_id
"""
_MONTHLY_MART = f"""
    select cast(month(timestamp) as integer) as transaction_month,
           count(transaction_id) as num_transactions, {_SUM} as total_amount
    from lv group by 1
"""
_REPORT = f"""
    select verdict, count(*) as num_rows, count(transaction_id) as num_ids,
           {_SUM} as total_amount
    from lo group by verdict
"""

# Two runs split by time: duplicates are removed within a run only.
_TWO_RUNS = _line_pipeline(key=f"transaction_id, {FIRST_RUN}")

# The JSON feed declares float amounts, which can change which duplicate is the smallest.
_FLOAT_FEED = f"""
    select * replace (
        cast(cast(amount as float) as double) as amount,
        cast(cast(total_amount as float) as double) as total_amount,
        cast(cast(installment_amount as float) as double) as installment_amount,
        cast(cast(bank_interest as float) as double) as bank_interest)
    from ({LT}) t
"""

_EVENT_JOIN = f"""
    with et as ({ET}), ec as ({EC}),
    ej as (select et.*, ec.age, ec.job,
                  {_RULES["min_amount"]} and {_RULES["known_currency"]}
                  and {_RULES["age_range"]} as p
           from et join ec on et.customer_id = ec.customer_id)
"""


def _reason_counts(**more: str) -> str:
    parts = []
    for name, condition in {**_RULES, **more}.items():
        parts.append(f"select '{name}' as reason from lj where not ({condition})")
        parts.append(f"select 'unknown:{name}' as reason from lj where ({condition}) is null")
    union = " union all ".join(parts)
    return f"{_LINE} select reason, count(*) as num_rows from ({union}) r group by reason"


_FLOAT_CUSTOMERS = f"select * replace (cast(balance as float) as balance) from ({LC}) c"
_COUNTS = "count(*) as num_rows, count(transaction_id) as num_ids"
_TWO_FLOAT_RUNS = _line_pipeline(
    feed=_FLOAT_FEED, key=f"transaction_id, {FIRST_RUN}", customers=_FLOAT_CUSTOMERS
)

# The feed sent twice: at first the customers of one segment are missing; then ids judged
# before are skipped.  Both runs have the same transactions without duplicates.
_RESENT = f"""
    {_line_pipeline(customers=f"select * from ({LC}) c where job is distinct from 'BUILDING'").replace("with lt", "with r0 as (select 0), lt", 1)}
    , full_lc as ({LC}),
    full_cd as ({_first_of("full_lc", "customer_id", _CU_PAYLOAD)}),
    second as (
        select tc.transaction_id, full_cd.customer_id as known, full_cd.age, tc.customer_id,
               case when full_cd.customer_id is null then 'orphan'
                    when {_ALL_RULES.replace("customer_id", "tc.customer_id")} then 'valid'
                    when not ({_ALL_RULES.replace("customer_id", "tc.customer_id")}) then 'invalid'
                    else 'indeterminate' end as verdict
        from tc left join full_cd on tc.customer_id = full_cd.customer_id
        where not exists (select 1 from lo where lo.transaction_id = tc.transaction_id
                                             and lo.verdict <> 'orphan'))
    select 'first' as run_id, verdict, {_COUNTS} from lo group by all
    union all
    select 'second' as run_id, verdict, {_COUNTS} from second group by all
"""

# The customers of one segment come later: what they had left as orphans is judged then, once more.
_WAITED = f"""
    {_line_pipeline(feed=_FLOAT_FEED, customers=f"select * from ({_FLOAT_CUSTOMERS}) f where job is distinct from 'BUILDING'")}
    , full_lc as ({_FLOAT_CUSTOMERS}),
    full_cd as ({_first_of("full_lc", "customer_id", _CU_PAYLOAD)}),
    waited as (
        select tc.transaction_id,
               case when {_ALL_RULES.replace("customer_id", "tc.customer_id")} then 'valid'
                    when not ({_ALL_RULES.replace("customer_id", "tc.customer_id")}) then 'invalid'
                    else 'indeterminate' end as verdict
        from (select * exclude (age) from lo where verdict = 'orphan') tc
        join full_cd on tc.customer_id = full_cd.customer_id)
    select false as waited, verdict, {_COUNTS} from lo group by all
    union all
    select true as waited, verdict, {_COUNTS} from waited group by all
"""

_ENRICHED = f"transaction_id, {_TX_PAYLOAD}, {_CU_PAYLOAD}"

ORACLES: dict[str, str] = {
    "currency_reference_scan": "select s_name as currency_code from supplier",
    "incremental_lookback": """
        select * from events
        where ts >= timestamp '2024-01-31 00:00:00' - interval 6 hour""",
    "hour_partition_layout": """
        select date_trunc('hour', ts) as upload_hour, count(*) as num_rows
        from events group by 1""",
    "run_quality_report": _LINE + _REPORT,
    "cast_amounts": f"""
        select transaction_id, cast(cast(amount as float) as double) as amount,
               cast(cast(total_amount as float) as double) as total_amount
        from ({LT}) t""",
    "fill_unknown_transactions": f"""
        select transaction_id, merchant_id, coalesce(city, 'unknown') as city from ({LT}) t""",
    "fill_unknown_customers": f"""
        select customer_id, coalesce(job, 'unknown') as job,
               coalesce(housing, 'unknown') as housing,
               coalesce(marital, 'unknown') as marital
        from ({LC}) t""",
    "normalize_domain": f"""
        select customer_id, case when gender in ('male', 'female', 'other') then gender
                                 else 'unknown' end as gender
        from ({LC}) t""",
    "parse_timestamp": f"""
        select l_orderkey, l_linenumber, text,
               try_strptime(text, '%Y-%m-%d %H:%M:%S') as parsed
        from ({testbed.SHIP_TEXTS.format(**_TABLES)}) t""",
    "rule_id_not_nan": f"""
        select transaction_id, customer_id,
               {_tri(_not_nan("transaction_id"))} as transaction_ok,
               {_tri(_not_nan("customer_id"))} as customer_ok
        from ({LT}) t""",
    "rule_min_amount": f"""
        select transaction_id, {_tri(_RULES["min_amount"])} as amount_ok from ({ET}) t""",
    "rule_currency_member": f"""
        select transaction_id, {_tri(_RULES["known_currency"])} as currency_ok from ({ET}) t""",
    "rule_age_range": f"""
        select customer_id, {_tri(_RULES["age_range"])} as age_ok from ({EC}) t""",
    "valid_transactions": f"{_LINE} select {_ENRICHED} from lj where p",
    "invalid_transactions": f"{_LINE} select {_ENRICHED} from lj where not p",
    "indeterminate_transactions": f"{_LINE} select {_ENRICHED} from lj where p is null",
    "event_verdicts": f"""{_EVENT_JOIN}
        select transaction_id, customer_id,
               case when p then 'valid' when not p then 'invalid'
                    else 'indeterminate' end as verdict
        from ej""",
    "failure_reason_counts": _reason_counts(),
    "dedup_transactions": f"{_LINE} select * from td",
    "dedup_customers": f"{_LINE} select * from cd",
    "dedup_across_runs": f"""
        with lt as ({LT}),
        early as (select transaction_id from lt where {FIRST_RUN}),
        fresh as (select * from lt where not {FIRST_RUN} and not exists (
                      select 1 from early where early.transaction_id = lt.transaction_id))
        {_first_of("fresh", "transaction_id", _TX_PAYLOAD)}""",
    "enrich_transactions": f"{_EVENT_JOIN} select * exclude (p) from ej",
    "currency_semi_join": f"select * from ({ET}) t where currency in {CODES}",
    "orphan_transactions": f"""
        with lt as ({LT}), lc as ({LC})
        select * from lt where not exists (
            select 1 from lc where lc.customer_id = lt.customer_id)""",
    "enrich_with_dimension": f"""
        with lt as ({LT}), lc as ({LC}),
        versions as (select *, 0 as version from lc
                     union all
                     select * replace (50 as age), 1 as version from lc where job = 'BUILDING'),
        latest as (
            select * exclude (rn) from (
                select *, row_number() over (
                    partition by customer_id
                    order by version desc, {", ".join(f"{c.strip()} desc nulls last" for c in _CU_PAYLOAD.split(","))}) as rn
                from versions) r
            where rn = 1)
        select lt.transaction_id, lt.customer_id, lt.amount, latest.age,
               coalesce(latest.job, 'unknown') as job, latest.balance
        from lt join latest on lt.customer_id = latest.customer_id""",
    "dimension_of_merged_runs": f"""
        with lt as ({LT}), lc as ({_FLOAT_CUSTOMERS}),
        versions as (select *, 0 as version from lc
                     union all
                     select * exclude (segment) replace (cast(39 + segment as integer) as age), segment as version from (
                         select *, list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD'], job) as segment
                         from lc) s where segment > 0),
        latest as (
            select * exclude (rn) from (
                select *, row_number() over (
                    partition by customer_id
                    order by version desc, {", ".join(f"{c.strip()} desc nulls last" for c in _CU_PAYLOAD.split(","))}) as rn
                from versions) r
            where rn = 1)
        select lt.transaction_id, lt.customer_id, lt.amount, latest.age, latest.job, cast(latest.balance as double) as balance
        from lt join latest on lt.customer_id = latest.customer_id where lt.status = 'completed'""",
    "transactions_per_customer": _LINE + _CUSTOMER_MART,
    "transactions_per_customer_exact": _LINE + _EXACT_CUSTOMER_MART,
    "nan_amounts_customer_mart": _line_pipeline(DT) + _CUSTOMER_MART,
    "nan_amounts_customer_mart_exact": _line_pipeline(DT) + _EXACT_CUSTOMER_MART,
    "transactions_per_customer_reproducible": f"""{_LINE}
        select customer_id, count(transaction_id) as num_transactions, {_NEAREST} as total_amount,
               {_NEAREST} / count(amount) as average_transaction_amount
        from lv group by customer_id""",
    "stored_mart_by_deltas": f"""{_TWO_RUNS}
        select customer_id, count(transaction_id) as num_transactions, {_NEAREST} as total_amount,
               {_NEAREST} / count(amount) as average_transaction_amount
        from lv group by customer_id""",
    "stored_reproducible_mart": f"""{_TWO_RUNS}
        select merchant_id, count(transaction_id) as num_transactions, {_NEAREST} as total_sales
        from lv group by merchant_id""",
    "transactions_per_merchant": _LINE + _MERCHANT_MART,
    "monthly_transactions": _LINE + _MONTHLY_MART,
    "monthly_transactions_by_year": f"""{_LINE}
        select cast(date_trunc('month', timestamp) as timestamp) as month_start,
               count(transaction_id) as num_transactions, {_SUM} as total_amount
        from lv group by 1""",
    "consolidate_marts": _LINE + _CUSTOMER_MART,
    "marts_by_upload_window": f"""{_EVENT_JOIN}
        select time_bucket(interval 6 hour, upload_time) as window_start,
               time_bucket(interval 6 hour, upload_time) + interval 6 hour as window_end,
               count(transaction_id) as num_transactions, {_SUM} as total_amount
        from ej where p group by 1, 2""",
    "id_batch_messages": """
        select cast(floor(c_custkey / 100.0) as bigint) as batch,
               cast(c_custkey as string) as customer_id
        from customer""",
    "json_messages": LT,
    "stored_run_report": _LINE + _REPORT,
    "stored_customer_mart": _TWO_RUNS + _CUSTOMER_MART,
    "stored_compacted_mart": _TWO_RUNS + _CUSTOMER_MART,
    "stored_mart_after_rerun": _LINE + _CUSTOMER_MART,
    "stored_lookback_by_name": f"""{_TWO_RUNS}
        select 'second' as run_id, verdict, {_COUNTS} from lo where not {FIRST_RUN} group by all""",
    "stored_run_profile": f"""{_TWO_RUNS}
        select verdict, count(*) as num_rows, count(distinct customer_id) as num_customers,
               true as customers_near, true as median_near
        from lo group by verdict""",
    "stored_clustered_run": f"""{_TWO_RUNS}
        select case when {FIRST_RUN} then 'first' else 'second' end as run_id, verdict, transaction_id, customer_id,
               cast(timestamp as timestamp) as timestamp, amount, merchant_id
        from lo""",
    "stored_extra_rule": _reason_counts(paid_by_card="(deposit_method = 'card')"),
    "resent_orphans": _RESENT,
    "resent_orphans_by_bitmap": _RESENT,
    "stored_json_run": _line_pipeline(feed=_FLOAT_FEED, customers=_FLOAT_CUSTOMERS) + f"""
        select verdict, timestamp '2024-01-01 00:30:00' as upload_time,
               timestamp '2024-01-01 00:00:00' as upload_hour, {_COUNTS}
        from lo group by all""",
    "generated_draws": """
        select cast(floor(c_custkey / 100.0) as bigint) as batch, 200 as num_transactions,
               200 as num_in_range, 200 as num_ids
        from customer group by 1""",
    "stored_merchant_mart": _TWO_RUNS + _MERCHANT_MART,
    "stored_monthly_mart": _TWO_RUNS + _MONTHLY_MART,
    "stream_run_report": _line_pipeline(feed=_FLOAT_FEED, customers=_FLOAT_CUSTOMERS)
    + f"select verdict, {_COUNTS} from lo group by 1",
    "stream_landed_and_cleaned": f"""{_TWO_FLOAT_RUNS}
        select verdict, {_COUNTS} from lo group by 1
        union all select 'left', {_COUNTS} from lt where not {FIRST_RUN}""",
    "repeated_landing": _line_pipeline(feed=_FLOAT_FEED, customers=_FLOAT_CUSTOMERS)
    + f"select verdict, {_COUNTS} from lo group by 1",
    "retried_slot": f"""{_TWO_FLOAT_RUNS}
        select case when {FIRST_RUN} then 'slot' else 'slot-2' end as run_id, verdict, {_COUNTS} from lo group by 1, 2""",
    "read_files_deleted": f"select currency, {_COUNTS} from ({_FLOAT_FEED}) t where not {FIRST_RUN} group by 1",
    "lookback_over_many_runs": """
        select *, 'run-' || (event_id % 200) as run_id from events where event_id % 200 >= 194""",
    "created_and_appended": """
        select date_trunc('hour', ts) as upload_hour, event_type, count(*) as num_rows from events group by 1, 2""",
    "stream_two_feeds_report": f"{_TWO_FLOAT_RUNS} select verdict, {_COUNTS} from lo group by 1",
    "waiting_orphans": _WAITED,
    "stream_dedup": "select * from events",
}
