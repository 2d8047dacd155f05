"""SuperMinHash near-duplicates and components against comparing all pairs."""

import random

import numpy as np
import pytest
from samples import ODD, SF, components, documents, edited, prose

from veriledger.llm import queries, superminhash
from veriledger.llm.components import components as connected


def found(frame, **options):
    return {r.doc_id: r for r in superminhash.near_duplicates(frame, **options).collect()}


def check(rows, result):
    want = components(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in result.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in result.items())


def test_every_document(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(rows, {r.doc_id: r for r in queries.op7_superminhash(spark, SF).collect()})


def near_rows(count):
    rows = [(i, edited(prose(i % 5, 60), i, 0.002 * (i % 40))) for i in range(count)]
    return [*rows, (9001, "a b c"), (9002, "A  b\tc"), (9003, "a b"), (9004, ""), (9005, None)]


def test_groups_of_near_copies(spark):
    rows = near_rows(200)
    check(rows, found(documents(spark, rows, ["digest", "signature", "rep"])))


def test_blocks_and_buckets_that_do_not_fit(spark, monkeypatch):
    """Every bucket is too large, and every cluster is cut into blocks."""
    rows = near_rows(200)
    candidates, links = superminhash.candidates, superminhash.links
    monkeypatch.setattr(superminhash, "candidates", lambda c: candidates(c, largest=3))
    monkeypatch.setattr(superminhash, "links", lambda d, c: links(d, c, block_docs=8))
    check(rows, found(documents(spark, rows)))


def test_odd_documents(spark):
    result = superminhash.near_duplicates(documents(spark, ODD)).collect()
    assert len(result) == len(ODD)
    for r in result:
        assert r.component_id == r.doc_id
        assert r.kept
    assert found(documents(spark, [])) == {}


def test_signatures_estimate_similarity():
    source = random.Random(1)
    for size in (3, 40, 2000):
        pool = np.array([source.getrandbits(64) for _ in range(2 * size)], dtype=np.uint64)
        a, b = np.unique(pool[:size]), np.unique(pool[size // 3 : size + size // 3])
        rows = superminhash.signatures([a, b] * 1 + [a])
        assert (rows[0] == rows[2]).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((rows[0] == rows[1]).mean() - true) < 0.2


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    source = random.Random(7)
    edges = {
        "chain": [(i, i + 1) for i in range(300)],
        "star": [(i, 500) for i in range(300)] + [(600, 601), (601, 601)],
        "random": [(source.randrange(400), source.randrange(400)) for _ in range(220)],
    }[shape]
    root = {n: n for e in edges for n in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)
    assert {r.id: r.root for r in connected(frame, limit=20).collect()} == {n: top(n) for n in root if top(n) != n}
