"""Toxicity, language model and secrets: contracts, brute force, held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from samples import ODD, SF, documents, prose, words

from veriledger.llm import gated_lm, queries, secret_forest, toxicity
from veriledger.llm.common import near_smallest, remainder, smallest


def fold(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}


# Toxicity


def test_the_sample_takes_no_python_workers_for_its_rows(spark, monkeypatch):
    """A list made a frame is read by workers of another kind, which idle beside those that score."""
    docs = documents(spark, [(i, prose(i, 20)) for i in range(40)]).localCheckpoint()
    labels = spark.range(40).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    nothing = labels.filter("doc_id < 0")
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", None)
    assert toxicity.sample(docs, labels, 10, 10_000).groupBy("toxic").count().count() == 2
    assert toxicity.sample(docs, nothing, 10, 10_000).collect() == []


def insulting(count):
    rows, labels = [], []
    for i in range(count):
        text = prose(i, 60)
        if i % 3 == 0:
            w = text.split()
            for k in range(4):
                w.insert(random.Random(i + k).randrange(60), ["blorg", "snaff", "grumpf"][(i + k) % 3])
            text = " ".join(w)
        rows.append((i, text))
        labels.append((i, 1, int(i % 3 == 0)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = insulting(360)
    docs = documents(spark, rows, ["score", "toxic", "place"])
    known = spark.createDataFrame([x for x in labels if fold(x[0], 5)], "doc_id bigint, quality int, toxic int")
    judge = toxicity.train(docs.select("doc_id", "text"), known)
    found = {r.doc_id: r.score for r in toxicity.score(docs, judge).collect()}
    assert len(found) == 360 and all(0 <= s <= 1 for s in found.values())
    held = [i for i in found if not fold(i, 5)]
    right = [(found[i] >= 0.5) == (i % 3 == 0) for i in held]
    assert np.mean(right) > 0.95


def test_toxicity_of_the_documents(spark, texts):
    found = queries.op4_kneser_ney(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        assert r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.5)
    held = [r for r in found if r.held_out and r.doc_id in labels]
    clean = [r.predicted for r in held if not labels[r.doc_id]]
    toxic = [r.predicted for r in held if labels[r.doc_id]]
    assert np.mean(clean) < 0.05 and np.mean(toxic) > 0.5


def test_toxicity_odd_cases(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    docs = documents(spark, ODD)
    judge = toxicity.train(docs.select("doc_id", "text"), none)
    assert [r.score for r in toxicity.score(docs, judge).collect()] == [0.0] * len(ODD)
    rows, labels = insulting(60)
    known = spark.createDataFrame([*[(i, t) for i, _, t in labels], (0, 1), (0, 0), (1, None), (None, 1), (99999, 1)], none.schema)
    judge = toxicity.train(documents(spark, rows).select("doc_id", "text"), known)
    found = toxicity.score(docs, judge).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score(documents(spark, []), judge).collect() == []


def test_toxicity_sample_skips_what_does_not_fit(spark):
    docs = documents(spark, [(i, "w " * (4000 if i % 7 == 0 else 5)) for i in range(40)] + [(i, None) for i in range(40, 60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id bigint, toxic int")
    # Texts over the budget shut nothing out; labels without a text take no place.
    short = {t: sum(i % 7 != 0 and i % 2 == t for i in range(40)) for t in (0, 1)}
    found = toxicity.sample(docs, labels, 60, 3000).collect()
    assert {t: sum(r.toxic == t for r in found) for t in (0, 1)} == short and {len(r.text) for r in found} == {10}
    found = toxicity.sample(docs, labels, 17, 30_000).collect()
    assert {t: sum(r.toxic == t for r in found) for t in (0, 1)} == {0: 17, 1: 17}
    # Long texts take the room that is left.
    found = toxicity.sample(docs, labels, 60, 10_000).collect()
    assert sorted(len(r.text) for r in found if r.toxic) == [10] * short[1] + [8000]
    assert toxicity.fitting([5, 9, 4, 2, 1], 10) == [True, False, True, False, True]


def test_toxicity_class_that_never_fits_is_an_error(spark):
    docs = documents(spark, [(1, "x" * 500), (2, "x")])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    with pytest.raises(ValueError):
        toxicity.train(docs, labels, max_chars=100)


def test_class_models_sum_to_one():
    source = np.random.default_rng(1)
    left, right = source.integers(0, 30, 400), source.integers(0, 30, 400)
    pairs = np.unique(np.column_stack([left, right]), axis=0)
    counts = source.integers(0, 40, (len(pairs), 2))
    words = np.arange(30)
    kinds = np.array([[(counts[pairs[:, 1] == w, c] > 0).sum() for c in range(2)] for w in words])
    after = np.array([[counts[pairs[:, 0] == w, c].sum() for c in range(2)] for w in words])
    models = toxicity.ClassModels(words, kinds, after, pairs[:, 0], pairs[:, 1], counts, 4.0)
    assert np.allclose(models.backoff.sum(axis=1), 1)
    for c in range(2):
        for word in range(len(models.words)):
            own = models.above[c][:-1][models.keys[:-1] // models.size == word].sum()
            assert math.isclose(own + models.weight[c][word] * models.backoff[c].sum(), 1, rel_tol=1e-9)


# Language model


def base_scores(rows, learns):
    counts = Counter()
    for i, t in rows:
        if learns(i):
            counts.update(words(t))
            counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        w = [*words(t), b""]
        yield i, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)


def test_language_model_of_the_documents(spark, texts):
    found = {r.doc_id: r for r in queries.op6_gated_lm(spark, "/root/testdata/sf0.01").collect()}
    assert len(found) == len(texts)
    for i, n, known, train, base in base_scores(texts.items(), lambda i: fold(i, 7) != 2):
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, train, fold(i, 7) == 2)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > 0.98 * sum(r.base_score for r in held)


def test_language_model_odd_cases(spark):
    docs = documents(spark, ODD, ["n", "code", "key"])
    found = gated_lm.score(docs, docs).collect()
    want = sorted(base_scores(ODD, lambda i: True), key=str)
    # The order of rows that share an id is open.
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens) for r in found) == sorted(
        (str(i), n, k, t) for i, n, k, t, _ in want
    )
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    nothing = gated_lm.score(documents(spark, [(1, "a b")]), documents(spark, [])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in nothing] == [(3, 0, 0, 0.0)]
    assert gated_lm.score(documents(spark, []), docs).collect() == []


def tiny_words():
    share = np.full(gated_lm.SHORTLIST + 1, 0.5 / gated_lm.SHORTLIST)
    share[gated_lm.REST] = 0.5
    return np.log(share)


def test_gradients():
    """Backpropagation against differences, in double precision."""
    model = gated_lm.GatedModel.start(tiny_words())
    model.weights = model.weights.astype(np.float64)
    at = 0
    for name, shape in model.SHAPES.items():
        size = int(np.prod(shape))
        setattr(model, name, model.weights[at : at + size].reshape(shape))
        at += size
    source = np.random.default_rng(2)
    x, y = source.integers(0, gated_lm.SHORTLIST + 1, (5, 3)), source.integers(0, gated_lm.SHORTLIST + 1, (5, 3))
    fresh = source.random((5, 3)) < 0.3
    h = source.normal(size=(3, gated_lm.HIDDEN))

    def loss():
        return -model.outputs(model.states(x, fresh, h)[-1].reshape(-1, gated_lm.HIDDEN), y.ravel(), False)[0].sum()

    before, z, c, after = model.states(x, fresh, h)
    _, grads, dh = model.outputs(after.reshape(-1, gated_lm.HIDDEN), y.ravel(), True)
    got = model.gradients(x, fresh, before, z, c, dh.reshape(after.shape), grads)
    for i in [*np.argsort(-np.abs(got))[:25], *source.integers(0, len(got), 25)]:
        old = model.weights[i]
        model.weights[i] = old + 1e-2
        up = loss()
        model.weights[i] = old - 1e-2
        down = loss()
        model.weights[i] = old
        assert abs((up - down) / 2e-2 - got[i]) < 0.02 * max(1, abs(got[i]))


def test_scores_do_not_depend_on_lanes():
    """The state is carried through each whole document, whatever else is in the batch."""
    model = gated_lm.GatedModel.start(tiny_words())
    source = np.random.default_rng(3)
    docs = [source.integers(0, gated_lm.SHORTLIST + 1, n).astype(np.int32) for n in (1, 700, 3, 55, 40, 2000, 17)]
    together = gated_lm.score_of(model, docs, 5)
    alone = [gated_lm.score_of(model, [d], 5)[0] for d in docs]
    assert np.allclose(together, alone, rtol=1e-4)


def test_probabilities_sum_to_one():
    model = gated_lm.GatedModel.start(tiny_words())
    h = np.random.default_rng(4).normal(size=(1, gated_lm.HIDDEN)).astype(np.float32)
    every = np.arange(gated_lm.SHORTLIST + 1)
    found, _, _ = model.outputs(np.repeat(h, len(every), axis=0), every, False)
    assert abs(np.exp(found).sum() - 1) < 1e-4


# Secrets


def test_secrets_of_the_documents(spark):
    found = queries.op8_secret_forest(spark, "/root/testdata/sf0.1").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()}
    form = re.compile(r"[A-Za-z0-9+/_\-]{16,}={0,2}")
    want = {(i, m.start(), m.end()) for i, t in texts.items() for m in form.finditer(t)}
    assert {(r.doc_id, r.start, r.end) for r in found} == want and len(found) == len(want)
    held = [r for r in found if r.held_out and r.label is not None]
    assert len(held) > 100 and np.mean([r.secret == bool(r.label) for r in held]) > 0.97


def test_secrets_odd_cases(spark):
    docs = documents(spark, ODD, ["label", "features", "start"])
    found = secret_forest.secrets(docs).collect()
    assert [(r.doc_id, r.start, r.end, r.secret, r.score) for r in found] == [(7, 0, 5000, True, 1.0)]
    assert secret_forest.secrets(documents(spark, [])).collect() == []
    rows = [(i, f"{prose(i, 5)} token = '{random.Random(i).getrandbits(160):040x}' end") for i in range(40)]
    rows += [(100 + i, f"{prose(i, 5)} {'abcdefghijklmnopqrstuvwxyz'[i % 9:]} end") for i in range(40)]
    mixed = documents(spark, [(i, t, None) for i, t in rows])
    judged = secret_forest.secrets(mixed).collect()
    assert len(judged) == 80 and all(r.secret == (r.doc_id < 100) for r in judged)


def test_secrets_by_context(spark):
    """Values of any characters and short ones, next to a word for a credential or a sign."""
    cases = [
        ("password = 'Tr0ub4dor&3'", "Tr0ub4dor&3"), ("my passwd: x9.y!", "x9.y!"), ("DB_PASSWORD=a@b#c$d%e~f, then", "a@b#c$d%e~f"),
        ('{"client_secret": "s3cr.et"}', "s3cr.et"), ("the password is hunter2.", "hunter2"), ("token ab.cd.ef gh", "ab.cd.ef"),
        ("auth: eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.x-y_z", "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.x-y_z"),
        ("x = correct.horse!", "correct.horse!"), ("url ?password=hunter2 x", "hunter2"),
    ]
    found = secret_forest.secrets(documents(spark, [(i, t) for i, (t, _) in enumerate(cases)])).collect()
    for i, (text, value) in enumerate(cases):
        got = {(r.candidate, r.start, r.end) for r in found if r.doc_id == i}
        assert (value, text.index(value), text.index(value) + len(value)) in got
    assert secret_forest.spans("see http://a.b/c at 9:30 = ok, monkey business") == []
    for text in ("key=" * 50_000, "key " * 50_000, "a='" * 50_000, '="' * 50_000):
        assert sum(e - s for s, e, _ in secret_forest.spans(text)) <= 3 * len(text)


def test_language_statistics(spark):
    speech = secret_forest.language(documents(spark, [(1, "Hello hello wörld ab 12"), (2, None), (3, "hello there")]))
    assert {"hello", "there"} <= speech.words and "ab" not in speech.words
    assert speech.coverage("xxhelloTHERExx") == pytest.approx(10 / 14)
    assert speech.transitions("hello") > speech.transitions("qzxqj")
    assert SF


def test_samples_are_those_of_a_whole_sort(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "id % 7 = 0 as kind", "id % 5 = 0 as late").repartition(6)
    code = F.xxhash64("doc_id")
    every = sorted(r.doc_id for r in rows.orderBy(code).limit(300).collect())
    assert sorted(r.doc_id for r in smallest(rows, code, ["doc_id"], 20_000, 300).collect()) == every
    same = F.lit(1).cast("bigint")  # one hash for all rows
    assert smallest(rows, same, ["doc_id"], 20_000, 300).count() == 300
    few = near_smallest(rows, "kind", code, 200, ~F.col("late"))
    assert few.count() < 6_000
    order = Window.partitionBy("kind").orderBy("late", code)

    def ranked(frame):
        return sorted(r.doc_id for r in frame.withColumn("n", F.row_number().over(order)).filter("n <= 200").collect())

    assert ranked(few) == ranked(rows)
    assert near_smallest(rows, "kind", same, 200).count() == 20_000


def test_the_threshold_of_the_judge_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    judge = queries.toxicity_judge(spark, folder)
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    held = labels.filter(remainder("doc_id", 5) == 0)
    rows = toxicity.score(docs.join(held, "doc_id", "left_semi"), judge).join(held, "doc_id").collect()
    assert 0 < judge.threshold <= 0.5
    assert np.mean([r.score >= judge.threshold for r in rows if r.toxic == 1]) >= 0.85
    assert np.mean([r.score >= judge.threshold for r in rows if r.toxic == 0]) <= 0.06


def test_thresholds():
    chances, truth = np.array([0.1, 0.2, 0.3, 0.9]), np.array([0, 0, 0, 1])
    assert toxicity.threshold(chances, truth, 0.0) == pytest.approx(0.3) and toxicity.threshold(chances, truth, 0.0) > 0.3
    assert 0.2 < toxicity.threshold(chances, truth, 0.34) <= 0.3
    assert toxicity.threshold(np.array([0.8]), np.array([0]), 0.0) == 0.5
    assert toxicity.threshold(np.array([0.8]), np.array([1]), 0.5) == 0.5
