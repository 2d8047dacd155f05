"""Sketches of runs: within their bounds, and the same when merged."""

import random
from datetime import datetime, timedelta

import pytest

from veriledger.operators.profile import compared, described, merged_profiles, profile_of, quantile, rank
from veriledger.plans import etl
from veriledger.sources.run_tables import write_run

COLUMNS = "verdict string, customer_id string, amount double, merchant_id string"


def some(seed, n, shift=0.0):
    source = random.Random(seed)
    return [
        ("valid", f"c{source.randint(0, 3000)}", source.uniform(0, 100) + shift, "hot" if i % 3 == 0 else f"m{source.randint(0, 900)}")
        for i in range(n)
    ]


def test_merged_sketches_are_near_the_whole(spark):
    parts = [some(seed, 5000) for seed in range(4)]
    frames = [spark.createDataFrame(p, COLUMNS).repartition(3) for p in parts]
    profiles = profile_of(frames[0])
    for frame in frames[1:]:
        profiles = profiles.unionByName(profile_of(frame))
    (told,) = described(merged_profiles(profiles), (0.1, 0.5, 0.9), top=1).collect()
    rows = [r for p in parts for r in p]
    amounts = sorted(r[2] for r in rows)
    assert told.num_rows == len(rows)
    assert told.customers == pytest.approx(len({r[1] for r in rows}), rel=0.07)
    for share, value in zip((0.1, 0.5, 0.9), told.amounts, strict=True):
        assert sum(a <= value for a in amounts) / len(amounts) == pytest.approx(share, abs=0.02)
    hot = sum(r[3] == "hot" for r in rows)
    assert told.merchants[0].item == "hot" and told.merchants[0]["count"] == pytest.approx(hot, rel=0.02)


def test_null_and_nan_and_empty(spark):
    rows = [("valid", None, None, None), ("valid", None, float("nan"), None), ("orphan", "c", 3.0, "m"), ("malformed", None, None, None)]
    frame = spark.createDataFrame(rows, COLUMNS)
    told = {r.verdict: r for r in described(merged_profiles(profile_of(frame)), (0.5,)).collect()}
    assert (told["valid"].num_rows, told["valid"].customers, told["valid"].amounts) == (2, 0, [None])
    assert (told["orphan"].customers, told["orphan"].amounts) == (1, [3.0])
    assert profile_of(frame.limit(0)).collect() == []
    found = compared(profile_of(frame), merged_profiles(profile_of(frame.limit(0)))).collect()
    assert len(found) == 3 and all(r.num_rows_before is None and r.median_rank_before is None for r in found)
    figures = profile_of(frame).select("verdict", quantile("amounts", 0.5), rank("amounts", quantile("amounts", 0.5)))
    assert {tuple(r) for r in figures.collect()} == {("valid", None, None), ("orphan", 3.0, 1.0), ("malformed", None, None)}


def test_a_run_beside_the_runs_before(spark, tmp_path):
    table, start = str(tmp_path / "judged"), datetime(2024, 1, 1)
    for number, shift in enumerate((0.0, 0.0, 40.0)):
        when = start + timedelta(hours=number)
        rows = spark.createDataFrame(some(number, 3000, shift), COLUMNS)
        write_run(rows, table, f"r{number}", ["verdict"], times=(when, when), beside={"_profile": profile_of})
    (same,) = etl.compare_run(spark, table, "r1").collect()
    assert same.num_rows_before == 3000 and same.share == 1.0
    assert same.median_rank_before == pytest.approx(0.5, abs=0.05)
    (moved,) = etl.compare_run(spark, table, "r2").collect()
    assert moved.num_rows_before == 6000 and moved.median_rank_before > 0.8
    (near,) = etl.compare_run(spark, table, "r2", hours=1).collect()
    assert near.num_rows_before == 3000
    # A run that is repeated is known by its new profile alone.
    when = start + timedelta(hours=1)
    write_run(spark.createDataFrame(some(9, 100), COLUMNS), table, "r1", ["verdict"], times=(when, when), beside={"_profile": profile_of})
    assert etl.compare_run(spark, table, "r2").first().num_rows_before == 3100
    with pytest.raises(ValueError):
        etl.compare_run(spark, table, "none")
