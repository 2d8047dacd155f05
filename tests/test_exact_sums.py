"""Sums of doubles against exact arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from veriledger.operators.exact_sums import as_double, exact_totals, merged_totals


def exact(values):
    known = [v for v in values if v is not None]
    if not known:
        return None
    if any(math.isnan(v) for v in known) or (math.inf in known and -math.inf in known):
        return math.nan
    for end in (math.inf, -math.inf):
        if end in known:
            return end
    total = sum(map(Fraction, known))
    return float(total)


def bits(x):
    return None if x is None else "nan" if math.isnan(x) else float(x).hex() if x else "zero"


def groups(seed):
    source = random.Random(seed)
    found = {
        "money": [round(source.uniform(0, 10_000), 2) for _ in range(500)],
        "signs": [source.uniform(-1, 1) * 10 ** source.randint(-20, 20) for _ in range(300)],
        "cancels": [1e16, 1.0, -1e16, 0.1, -0.1],
        "tiny": [5e-324, 2.2250738585072014e-308, 1e-310, -5e-324],
        "huge": [1e300, 1e300, -1e300, 1.5],
        "tie": [1.0, 2.0**-53, 2.0**-120],
        "none": [None, None],
        "nan": [1.0, math.nan],
        "plus": [math.inf, 2.0],
        "both": [math.inf, -math.inf],
        "minus": [-math.inf, 3.0],
        "zero": [0.0, -0.0],
        "powers": [2.0**k for k in range(-200, 200, 24)] + [2.0**k - 2.0 ** (k - 53) for k in range(-48, 72, 24)],
        "negative": [-(2.0**k) for k in range(-30, 30)],
        "float": [float(F32) for F32 in (10.100000381469727, 0.5, 99.94999694824219)] * 33,
        None: [0.1] * 10,
    }
    return found


@pytest.mark.parametrize("partitions", [1, 4, 200])
def test_sums_are_the_nearest_doubles(spark, partitions):
    want = {k: exact(v) for k, v in groups(1).items()}
    rows = [(k, v) for k, values in groups(1).items() for v in values]
    random.Random(partitions).shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, v double").repartition(partitions)
    totals = exact_totals(frame, ["k"], "v", "total", F.count("k"), F.count("*"))
    got = totals.select("k", as_double("total").alias("sum"), "total.n", "__m1").collect()
    assert {r.k: bits(r["sum"]) for r in got} == {k: bits(v) for k, v in want.items()}
    assert {r.k: (r.n, r["__m1"]) for r in got} == {k: (sum(x is not None for x in v), len(v)) for k, v in groups(1).items()}


def test_parts_add_up_to_the_whole(spark):
    rows = [(k, i % 7, v) for k, values in groups(2).items() for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "k string, part int, v double")
    parts = exact_totals(frame, ["k", "part"], "v", "total", F.count("*"))
    for keys in (["k"],):
        whole = exact_totals(frame, keys, "v", "total", F.count("*"))
        merged = merged_totals(parts.drop("part"), keys, "total", F.sum("__m0"))
        assert sorted(map(str, whole.collect())) == sorted(map(str, merged.collect()))


def test_random_doubles_of_every_size(spark):
    source = random.Random(3)
    rows = []
    for k in range(200):
        for _ in range(source.randint(1, 12)):
            rows.append((k, source.choice([-1, 1]) * source.random() * 2.0 ** source.randint(-1070, 1015)))
    frame = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: r["sum"] for r in exact_totals(frame, ["k"], "v", "t").select("k", as_double("t").alias("sum")).collect()}
    want = {k: exact([v for i, v in rows if i == k]) for k in got}
    wrong = {k for k in got if bits(got[k]) != bits(want[k])}
    # Results below the normal doubles are rounded twice.
    assert all(abs(want[k]) < 2.3e-308 for k in wrong)
