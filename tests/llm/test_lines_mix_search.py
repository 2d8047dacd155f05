"""Line templates, Pfair mixing and vector search: odd cases and plain models."""

import math
import random

import numpy as np
import pytest
from samples import ODD, documents, prose

from veriledger.llm import dimension_scan, line_templates, pfair, queries

# Line templates


def cleaned(spark, rows, **options):
    names = ["leaf", "code", "line", "doc", "gone_id", "gone_lines", "key", "place", "first", "shape", "words", "n_lines"]
    frame = documents(spark, rows, names)
    return {r.doc_id: r for r in line_templates.without_recurring_lines(frame, **options).collect()}


def test_variable_fields(spark):
    names = ["ann", "bob", "cat", "dan", "eve"]
    rows = [
        (i, f"{prose(i, 12)}\nPage {i} of 10 printed at 12:0{i}\nThe user called {names[i]} signed in today from home\n{prose(50 + i, 9)}")
        for i in range(5)
    ]
    found = cleaned(spark, rows)
    assert found[0].text == rows[0][1] and found[0].n_dropped == 0
    for i in range(1, 5):
        first, _, _, last = rows[i][1].split("\n")
        assert found[i].text == f"{first}\n{last}"
        assert (found[i].n_lines, found[i].n_dropped) == (4, 2)


def test_repeats_within_a_document_stay_and_short_lines_recur_by_shape(spark):
    line = "one two three four"
    found = cleaned(spark, [(1, f"{line}\n{line}\nok\n\n12"), (2, f"ok\n{line}\nall mine here now\n\n13"), (3, "ok\nno no\nv1 v2\nPage 1"), (4, "v3 v4\nPage 2\nno yes")])
    assert found[1].text == f"{line}\n{line}\nok\n\n12"
    assert found[2].text == "all mine here now\n\n13"  # blank lines and bare numbers are no templates
    assert found[3].text == "no no\nv1 v2\nPage 1"
    assert found[4].text == "v3 v4\nno yes"


NAMES = ["ann", "bob", "cat", "dan", "eve", "fay"]
TEMPLATES = [
    "The user called {} signed in today from home", "The user called {} lost his red new phone", "User {} signed in today from home",
    "Your order will be delivered to the following address: {}",
]


def test_several_templates_of_one_leaf(spark):
    rows = [(i, "\n".join(t.format(n) for t in TEMPLATES)) for i, n in enumerate(NAMES)]
    found = cleaned(spark, rows)
    assert found[0].n_dropped == 0
    assert all(found[i].text == "" and found[i].n_dropped == len(TEMPLATES) for i in range(1, 6))


def test_other_lines_change_nothing(spark):
    rows = [(i, "\n".join(t.format(n) for t in TEMPLATES)) for i, n in enumerate(NAMES)]
    more = [(100 + i, f"The user called {prose(i, 6)}\nUser {prose(500 + i, 3)} from home") for i in range(300)]
    alone, among = cleaned(spark, rows), cleaned(spark, rows + more)
    assert {i: among[i].text for i in alone} == {i: r.text for i, r in alone.items()}
    assert all(among[i].n_dropped == 0 for i, _ in more)


def test_long_lines(spark):
    words = prose(1, 20_000).split(" ")
    other = words.copy()
    other[9_000] = "another"
    far = [w if i % 2 else "x" for i, w in enumerate(words)]
    found = cleaned(spark, [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(far)), (4, "y" * 300_000), (5, "y" * 300_000)])
    assert [found[i].n_dropped for i in (1, 2, 3, 4, 5)] == [0, 1, 0, 0, 1]


def test_different_lines_of_one_leaf_stay(spark):
    rows = [(i, f"The first words {prose(i, 9)}") for i in range(40)]
    assert all(r.n_dropped == 0 for r in cleaned(spark, rows).values())


def test_odd_lines(spark):
    rows = line_templates.without_recurring_lines(documents(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    assert sorted([(r.doc_id, r.text) for r in rows], key=str) == sorted(ODD, key=str)
    assert {r.n_lines for r in rows if r.text is None} == {0}
    twice = cleaned(spark, [(1, "a b c"), (2, "a  b\tc\r\nx"), (3, "a b c")])
    assert [twice[i].text for i in (1, 2, 3)] == ["a b c", "x", ""]
    assert line_templates.without_recurring_lines(documents(spark, [])).collect() == []


# Mixing


@pytest.mark.parametrize("shares", [[1], [1, 1], [6, 4, 3, 2, 5], [50, 25, 25], [7, 3, 9, 2, 2, 13, 1], [1, 99], [33, 33, 34]])
def test_schedule_keeps_every_window(spark, shares):
    slots = spark.range(1).select(pfair.pattern(shares)).first()[0]
    total, done = sum(shares), [0] * len(shares)
    assert len(slots) == total
    for t, k in enumerate(slots):
        i = done[k]
        assert i * total // shares[k] <= t < -(-(i + 1) * total // shares[k])
        done[k] += 1
        assert all(abs(d - s * (t + 1) / total) < 1 for d, s in zip(done, shares, strict=True))
    assert done == shares


def test_mixture_of_uneven_sources(spark):
    source = random.Random(5)
    rows = [(i, "t", source.choice(["a"] * 6 + ["b", "c", None, "d"])) for i in range(700)]
    frame = documents(spark, rows, ["mix_slot", "offset"])
    found = sorted(pfair.mixed(frame, {"a": 3, "b": 2}, rest=1, block_rows=8).collect(), key=lambda r: r.mix_position)
    assert [r.mix_position for r in found] == list(range(700)) and len({r.doc_id for r in found}) == 700
    assert {c for c in found[0].asDict() if c.startswith(("mix", "kept"))} == {"mix_block", "mix_position", "mix_slot", "kept_5"}
    sizes = {k: sum((r.source if r.source in ("a", "b") else None) == k for r in found) for k in ("a", "b", None)}
    # Until a source runs out, each has its share of the blocks to within one.
    last = min(r.mix_slot for k in sizes for r in found if (r.source if r.source in ("a", "b") else None) == k and r.mix_block == (sizes[k] - 1) // 8)
    for slot in range(last):
        blocks = {(r.source if r.source in ("a", "b") else None, r.mix_block) for r in found if r.mix_slot <= slot}
        for k, share in (("a", 3), ("b", 2), (None, 1)):
            assert abs(sum(b[0] == k for b in blocks) - share * (slot + 1) / 6) < 1


def test_names_of_the_mixture_may_be_taken(spark):
    frame = documents(spark, [(i, "t", "a" if i % 2 else "b") for i in range(40)], ["kept_5", "mix_slot", "kept_6", "offset", "mix_part"])
    found = pfair.mixed(frame, {"a": 1})
    assert found.columns == [
        "doc_id", "text", "lang", "source", "n_chars", "kept_5", "kept_6_", "kept_6", "offset", "kept_9", "mix_block", "mix_slot", "mix_position",
    ]
    assert sorted(r.mix_position for r in found.collect()) == list(range(40))


def test_odd_mixtures(spark):
    found = pfair.mixed(documents(spark, ODD), {"src0": 1}).collect()
    assert sorted(r.mix_position for r in found) == list(range(len(ODD)))
    assert pfair.mixed(documents(spark, []), {"src0": 1}).collect() == []
    with pytest.raises(ValueError):
        pfair.mixed(documents(spark, []), {"src0": 0})


# Search


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def brute(rows, every=100, k=10):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    want = {}
    for q, x in good:
        if q % every == 0:
            near = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in good if i != q)
            want[q] = near[:k]
    return want


def test_ties_and_rows_that_take_no_part(spark):
    source = np.random.default_rng(1)
    rows = [(i, source.normal(size=8).tolist(), 0) for i in range(300)]
    rows += [(1000 + i, [1.0] * 8, 0) for i in range(60)] + [(2000, [1.0] * 8, 0)]
    rows += [(400, None, 0), (500, [0.0] * 8, 0), (600, [float("nan")] * 8, 0), (700, [None] * 8, 0), (800, [float("inf")] * 8, 0), (None, [1.0] * 8, 0), (900, [], 0)]
    found = {}
    for r in dimension_scan.nearest_neighbours(vectors(spark, rows), recall=1.0, epsilon=20.0).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    want = brute(rows)
    assert set(found) == set(want)
    for q, near in want.items():
        got = [found[q][i] for i in range(1, 11)]
        assert [i for _, i in got] == [i for _, i in near]
        assert np.allclose([d for d, _ in got], [d for d, _ in near], rtol=1e-12)
    assert [i for _, i in want[1000]] == list(range(1001, 1011))


def test_repeated_ids_are_one_candidate_and_one_query(spark):
    source = np.random.default_rng(4)
    rows = [(i, source.normal(size=8).tolist(), 0) for i in range(1, 200)]
    near = source.normal(size=8)
    rows += [(100, near.tolist(), 0), (200, near.tolist(), 0)]
    rows += [(777, (near + source.normal(size=8) * 0.01).tolist(), 0) for _ in range(40)]  # one id, often and close
    rows += [(300, source.normal(size=8).tolist(), 0) for _ in range(3)]  # a query of three vectors
    frame = vectors(spark, rows)
    for name in ("list", "block", "key", "limit", "vector", "asks", "id", "rank", "score"):
        frame = frame.selectExpr("*", f"'x' as `{name}`")
    found = {}
    for r in dimension_scan.nearest_neighbours(frame, recall=1.0, epsilon=20.0).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v, _ in rows]
    for q in (100, 200, 300):
        best = {}
        for i, y in good:
            if i != q:
                best[i] = min([best.get(i, math.inf), *(float(np.sqrt(((x - y) ** 2).sum())) for j, x in good if j == q)])
        want = sorted((d, i) for i, d in best.items())[:10]
        assert [found[q][k][0] for k in range(1, 11)] == [i for _, i in want]
        assert np.allclose([found[q][k][1] for k in range(1, 11)], [d for d, _ in want], rtol=1e-12)


def test_clustered_vectors_need_few_lists(spark):
    source = np.random.default_rng(5)
    centres = source.normal(size=(60, 24)) * 8
    rows = [(i, (centres[i % 60] + source.normal(size=24)).tolist(), 0) for i in range(6000)]
    frame = vectors(spark, rows)
    taken = dimension_scan.taking_part(frame)
    coarse = dimension_scan.learn(taken, 6000, 10, 0.99)
    assert coarse.probes < 0.2 * len(coarse.centres)
    want, hits = brute(rows), 0
    for r in dimension_scan.nearest_neighbours(frame).collect():
        hits += r.vec_id in {i for _, i in want[r.query_id]}
    assert hits / (10 * len(want)) >= 0.9
    print(f"clustered: {coarse.probes} of {len(coarse.centres)} lists, recall {hits / (10 * len(want)):.3f}")


def test_fewer_candidates_than_wanted(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(4)] + [(9, [1.0, 2.0, 3.0], 0)]
    found = dimension_scan.nearest_neighbours(vectors(spark, rows)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == [(0, 1, 1, 1.0), (0, 2, 2, 2.0), (0, 3, 3, 3.0)]
    assert dimension_scan.nearest_neighbours(vectors(spark, [])).collect() == []
    assert dimension_scan.nearest_neighbours(vectors(spark, [(100, [1.0], 0)])).collect() == []


def test_blocks_and_chunks(spark):
    """Lists cut into blocks and queries into chunks find the same."""
    source = np.random.default_rng(2)
    rows = [(i, source.normal(size=16).tolist(), 0) for i in range(400)]
    plain = dimension_scan.nearest_neighbours(vectors(spark, rows), every=10, recall=1.0, epsilon=20.0)
    cut = dimension_scan.nearest_neighbours(
        vectors(spark, rows), every=10, recall=1.0, epsilon=20.0, block_rows=7, chunk_queries=6
    )
    assert sorted(plain.collect()) == sorted(cut.collect())


def test_recall_on_the_embeddings(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want, hits, found = brute(rows), 0, {}
    for r in queries.op2_dimension_scan(spark, folder).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for q, near in want.items():
        assert len(found[q]) == 10
        hits += len(found[q] & {i for _, i in near})
    assert hits / (10 * len(want)) >= 0.9


def test_scan_abandons_but_keeps_the_nearest():
    source = np.random.default_rng(3)
    x = source.normal(size=(3000, 64))
    columns = [np.ascontiguousarray(x.T[i : i + 16]) for i in range(0, 64, 16)]
    hits = 0
    for q in source.normal(size=(20, 64)):
        exact = np.argsort(((x - q) ** 2).sum(1))[:10]
        rows, scores = dimension_scan.scan(columns, q, 10, math.inf, 2.1, x, q)
        assert list(scores) == sorted(scores)
        hits += len(set(rows) & set(exact))
    assert hits >= 190
