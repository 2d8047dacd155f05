import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import CASES, CUSTOMERS, MALFORMED, RUN_TIME, transactions, write_lines
from veriledger.functions.text import reads_as_nan
from veriledger.operators import rules
from veriledger.operators.joins import flag_currency, flag_member
from veriledger.plans.etl import EtlRun, enriched, run_etl
from veriledger.schemas import JUDGED_COLUMNS, RAW_LINE, RUN_TABLE_DDL
from veriledger.sources.feeds import read_customers, read_transactions
from veriledger.sources.run_tables import read_runs


@pytest.fixture(scope="module")
def judged(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("judged")
    run = EtlRun(
        run_id="r1",
        run_time=RUN_TIME,
        customers=write_lines(base / "customers", CUSTOMERS, ["{broken customer"]),
        transactions=write_lines(base / "transactions", transactions(), MALFORMED),
        table=str(base / "judged"),
        currencies=["GEL", "USD", "EUR"],
    )
    report = run_etl(spark, run)
    return dict(report), read_runs(spark, run.table, RUN_TABLE_DDL).collect()


@pytest.mark.parametrize("name,_change,expected", CASES, ids=[str(c[0]) for c in CASES])
def test_verdict(judged, name, _change, expected):
    rows = [r for r in judged[1] if r.transaction_id == name and r[RAW_LINE] is None]
    assert [r.verdict for r in rows] == [expected]


def test_nothing_is_lost(judged):
    report, rows = judged
    assert len(rows) == len(CASES) + len(MALFORMED)
    assert report.pop("malformed_customers") == 1
    assert sum(report.values()) == len(rows)
    assert report["malformed"] == 2 and report["orphan"] == 2
    assert {r[RAW_LINE] for r in rows if r.verdict == "malformed"} == set(MALFORMED)


def test_reasons(judged):
    reasons = {r.transaction_id: r.reasons for r in judged[1] if r[RAW_LINE] is None}
    assert reasons["ok-1"] == []
    assert reasons["low"] == ["min_amount"]
    assert reasons["null-cur-low"] == ["min_amount", "unknown:known_currency"]
    assert reasons["null-age"] == ["unknown:age_range"]
    assert reasons["NaN"] == ["transaction_id_not_nan"]
    assert reasons["orphan"] == []


def test_row_content(judged):
    rows = {r.transaction_id: r for r in judged[1] if r[RAW_LINE] is None}
    row = rows["ok-1"]
    assert set(JUDGED_COLUMNS) <= set(row.asDict())
    assert row.amount == 10.100000381469727
    assert (row.city, row.job, row.housing, row.marital) == ("unknown",) * 4
    assert row.gender == "male"
    assert {r.upload_time for r in judged[1]} == {RUN_TIME}
    assert str(row.upload_hour) == "2024-03-01 12:00:00"
    assert math.isnan(rows["nan-amount"].amount)
    assert rows["age-frac"].timestamp is None and rows["age-frac"].gender == "unknown"
    assert rows["young"].job == ""


def test_filters_agree_with_verdicts(spark, tmp_path):
    tx = read_transactions(spark, write_lines(tmp_path / "t", transactions()))
    cu = read_customers(spark, write_lines(tmp_path / "c", CUSTOMERS))
    frame = enriched(tx, cu, ["GEL"])
    checks = rules.default_rules()
    judged = rules.judge(frame, checks)
    for verdict in (rules.VALID, rules.INVALID, rules.INDETERMINATE):
        ours = {r.transaction_id for r in rules.only(frame, checks, verdict).collect()}
        theirs = {r.transaction_id for r in judged.where(F.col("verdict") == verdict).collect()}
        assert ours == theirs


def test_empty_code_list_makes_nothing_valid(spark, tmp_path):
    tx = read_transactions(spark, write_lines(tmp_path / "t", transactions()))
    cu = read_customers(spark, write_lines(tmp_path / "c", CUSTOMERS))
    empty = spark.sql("select currency_code from values ('x') as t(currency_code) where 1 = 0")
    for codes in ([], empty):
        counts = {
            r.verdict: r.num_rows
            for r in rules.verdict_counts(
                rules.judge(enriched(tx, cu, codes), rules.default_rules())
            ).collect()
        }
        assert set(counts) == {"invalid"}


CODE_LISTS = [[], ["GEL"], ["GEL", "GEL", "USD"], ["GEL", None], [None]]


@pytest.mark.parametrize("codes", CODE_LISTS, ids=str)
def test_membership_has_the_truth_values_of_in(spark, codes):
    rows = [(i, c) for i, c in enumerate(["GEL", "ZZZ", "", None])]
    frame = spark.createDataFrame(rows, "transaction_id int, currency string")
    table = spark.createDataFrame([(c,) for c in codes], "currency_code string")
    joined = flag_currency(frame, table)
    plain = flag_currency(frame, codes)
    want = {r.transaction_id: r.currency_ok for r in plain.collect()}
    assert {r.transaction_id: r.currency_ok for r in joined.collect()} == want
    if codes == ["GEL"]:
        assert want == {0: True, 1: False, 2: False, 3: None}


def test_member_flag_keeps_every_row(spark):
    frame = spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, cast(id % 5 as string)) as code")
    codes = spark.sql("select * from values ('1'), ('2'), ('2') as t(code)")
    assert flag_member(frame, codes, "code", "ok", ["id"]).count() == 1000


NAN_TEXTS = [
    "NaN", "nan", "NAN", " NaN ", "\tnan\n", "+NaN", "-NaN", "+nan", "-nan", "NaNs", "na n", "", " ",
    "1", "1e400", "inf", "-Infinity", "0x1p3", "nan1", "a-NaN", None,
    "3f2504e0-4f89-41d3-9a0c-0305e82c3301",
]


def _differences(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    text = F.col("text")
    cast = F.isnan(text.try_cast("double"))
    return frame.where(reads_as_nan(text) != cast).collect()


def test_nan_text_matches_the_cast(spark):
    assert _differences(spark, NAN_TEXTS) == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="nNaA+- \t\x00ifF1.e", max_size=6), min_size=40, max_size=40))
def test_nan_text_matches_the_cast_on_random_text(spark, texts):
    assert _differences(spark, texts) == []


def test_a_user_rule_joins_the_verdict(spark):
    frame = spark.sql("select * from values (1, 'a'), (2, 'b'), (3, null) as t(id, tag)")
    extra = rules.Rule("tag_is_a", F.col("tag") == "a")
    got = {r.id: (r.verdict, r.reasons) for r in rules.judge(frame, [extra]).collect()}
    assert got == {
        1: ("valid", []),
        2: ("invalid", ["tag_is_a"]),
        3: ("indeterminate", ["unknown:tag_is_a"]),
    }


def test_limits_are_parameters(spark):
    frame = spark.sql("select 5 as age, 1.0D as amount, 1.0D as total_amount")
    limits = rules.Limits(min_amount=2.0, min_age=5, max_age=5)
    checks = [rules.age_rule(limits), rules.amount_rule(limits)]
    assert rules.judge(frame, checks).first().reasons == ["min_amount"]
