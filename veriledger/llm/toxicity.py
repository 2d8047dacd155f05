"""Toxicity by two Kneser-Ney language models, one of toxic and one of ordinary text.

Both back off to the same counts, so that an expression that is rare in both says nothing.
A text is judged by its length-normalised log-likelihood ratio: over the whole of it and
over its most suspicious window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.common import bounded_batches, forget, near_smallest, release, small_frame, written

_WORD = re.compile(r"[^\W_]+")
_TRIPLES = "before bigint, left bigint, right bigint, toxic int"
_TRIPLES_ARROW = pa.schema(
    [("before", pa.int64()), ("left", pa.int64()), ("right", pa.int64()), ("toxic", pa.int32())]
)
_PICKED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("code", pa.int64()), ("toxic", pa.int32()), ("calibrates", pa.bool_())]
)
START = 0  # the code of the place before the first word


class _Codes(dict):
    """Codes of words, signed 64-bit; START is never a word's."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word) - (1 << 63) or 1
        return value


class Reader:
    """Word codes of whole texts; remembers the codes of a bounded number of words."""

    def __init__(self, memory: int = 150_000):
        self.codes, self.memory = _Codes(), memory

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.codes) > self.memory:
            self.codes.clear()
        words = _WORD.findall((text or "").lower())
        return np.array([START, *(self.codes[w] for w in words)], dtype=np.int64)


class ClassModels:
    """The two models, from words and pairs of neighbouring words and how they occur in each class.

    ``words`` are codes in order; ``kinds`` has for each, in toxic and in ordinary text, the
    number of different words before it, its Kneser-Ney count, to which copies of a text add
    nothing; ``after`` the sum of the counts of the pairs it begins.  ``left, right, counts``
    are pairs and the numbers of different words before them; those that no class has more
    often than the discount may be left out.  Both orders lose an absolute ``discount``; what
    they lose goes to the next order, and in the end to counts that both classes share.  So a
    pair or word that is rarer than the discount has the same likelihood in both, relative to
    the order below.
    """

    def __init__(self, words, kinds, after, left, right, counts, discount: float = 8.0):
        self.words = words
        self.size = size = len(words) + 1  # the last number is that of all unknown words
        l, r = np.searchsorted(words, left), np.searchsorted(words, right)
        keys = l.astype(np.int64) * size + r
        order = np.argsort(keys)
        l, counts = l[order], counts[order]
        kinds, after = np.vstack([kinds, [0, 0]]).T, np.vstack([after, [0, 0]]).T
        shared = kinds.sum(axis=0) + 1.0
        shared /= shared.sum()
        self.backoff = np.empty((2, size))  # likelihood of a word by itself
        self.weight = np.ones((2, size))  # what the pairs after a word leave to single words
        above = np.zeros((2, len(l)))  # what a pair has of its own
        for c in range(2):
            own = np.maximum(kinds[c] - discount, 0) / max(1.0, kinds[c].sum())
            self.backoff[c] = own + (1 - own.sum()) * shared
            above[c] = np.maximum(counts[:, c] - discount, 0) / np.maximum(1, after[c])[l]
            self.weight[c] -= np.bincount(l, weights=above[c], minlength=size)
        some = above.any(axis=0)
        self.keys = np.append(keys[order][some], np.iinfo(np.int64).max)
        self.above = np.column_stack([above[:, some], np.zeros((2, 1))])

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, codes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == codes, at, self.size - 1) if len(self.words) else np.full(len(codes), 0)

    def ratios(self, codes: np.ndarray) -> np.ndarray:
        """For each word of a text the log of how much likelier it is under the toxic model."""
        n = self.numbers(codes)
        left, right = n[:-1], n[1:]
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[self.keys[at] != key] = -1  # the last pair has nothing of its own
        p = self.above[:, at] + self.weight[:, left] * self.backoff[:, right]
        return np.log(p[0]) - np.log(p[1])


def evidence(ratios: np.ndarray, window: int) -> tuple[float, float]:
    """The mean of the ratios and the largest mean over a window; of a short text, both over all."""
    if not len(ratios):
        return 0.0, 0.0
    mean = float(ratios.mean())
    if len(ratios) <= window:
        return mean, mean * len(ratios) / window
    sums = np.concatenate([[0.0], np.cumsum(ratios)])
    return mean, float((sums[window:] - sums[:-window]).max() / window)


def shares(y: np.ndarray, caution: float) -> np.ndarray:
    """The weight of each text: the classes count as wholes, the ordinary one ``caution`` times."""
    toxic = y > 0
    return np.where(toxic, 1 / max(1, toxic.sum()), caution / max(1, (~toxic).sum())) / (1 + caution)


def logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (share * (p - y)) + ridge * weights
        curve = (x * (share * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        move = np.linalg.solve(curve, gradient)
        weights -= move * min(1.0, 5.0 / max(1e-9, np.abs(move).max()))
    return weights


@dataclass(frozen=True)
class Judge:
    """What a score needs: the models, the window and the weights of the evidence.

    ``threshold`` is the score from which a document may be rejected at the stated loss of
    ordinary ones.
    """

    models: ClassModels | None
    window: int
    weights: np.ndarray
    threshold: float = 0.5

    def scores(self, codes: list[np.ndarray]) -> np.ndarray:
        if self.models is None:
            return np.zeros(len(codes))
        return self.chances(np.array([evidence(self.models.ratios(c), self.window) for c in codes]).reshape(-1, 2))

    def chances(self, found: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + found @ self.weights[1:], -30, 30)))


def threshold(chances: np.ndarray, truth: np.ndarray, lost: float) -> float:
    """The smallest score, 0.5 at most, that no more than a share ``lost`` of the ordinary texts reaches."""
    ordinary = np.sort(chances[truth == 0])
    if not len(ordinary):
        return 0.5
    allowed = int(lost * len(ordinary))
    return float(min(0.5, np.nextafter(ordinary[len(ordinary) - 1 - allowed], 1)))


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    read = Reader()
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            codes = np.concatenate([[START], read(text)])
            columns = [codes[:-2], codes[1:-1], codes[2:], np.full(len(codes) - 2, toxic, dtype=np.int32)]
            yield pa.record_batch([pa.array(c) for c in columns], schema=_TRIPLES_ARROW)
    del read
    release()


def fitting(sizes: list[int], most: int) -> list[bool]:
    """Which of some texts are taken, in their order: each one that still fits into ``most`` characters."""
    taken, held = [], 0
    for size in sizes:
        taken.append(held + size <= most)
        held += size if taken[-1] else 0
    return taken


def sample(docs: DataFrame, labels: DataFrame, max_docs: int, max_chars: int) -> DataFrame:
    """``text, toxic, calibrates``: at most ``max_docs`` texts and ``max_chars`` characters of each class.

    ``labels`` has ``doc_id, toxic``; a document labelled twice is toxic if either says so.
    Only labels of documents with a text take up a place; copies of a text under one id are
    one.  Texts come in the order of the hash of their id, those of more than a hundredth of
    ``max_chars`` after all others, and one that does not fit is skipped by itself.  If no
    text of a class fits although there are some, that is an error.
    """
    known = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    found = docs.filter("text is not null").withColumns({"chars": F.length("text"), "code": F.xxhash64("text")})
    labelled = written(
        found.select("doc_id", "code", "chars").join(known, "doc_id").dropDuplicates(["doc_id", "code"]), "toxicity-labels"
    )
    long = F.col("chars") > max_chars // 100
    order = W.partitionBy("toxic").orderBy(long, F.xxhash64("doc_id"), "doc_id", "code")
    # At most 2 * max_docs rows, of numbers.
    few = near_smallest(labelled, "toxic", F.xxhash64("doc_id"), max_docs, ~long)
    ranked = few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= max_docs).collect()
    picked = []
    for toxic in (0, 1):
        rows = sorted((r for r in ranked if r.toxic == toxic), key=lambda r: r.place)
        taken = [r for r, fits in zip(rows, fitting([r.chars for r in rows], max_chars), strict=True) if fits]
        if rows and not taken:
            raise ValueError(f"no text labelled {toxic} has at most {max_chars} characters")
        picked += [(r.doc_id, r.code, toxic, place % 4 == 3) for place, r in enumerate(taken, 1)]
    frame = small_frame(docs.sparkSession, picked, _PICKED_ARROW)
    texts = found.select("doc_id", "code", "text").join(F.broadcast(frame), ["doc_id", "code"]).dropDuplicates(["doc_id", "code"])
    return written(texts.select("text", "toxic", "calibrates"), "toxicity-sample")


def train(
    docs: DataFrame, labels: DataFrame, max_docs: int = 3000, max_chars: int = 30_000_000, caution: float = 3.0,
    windows: tuple[int, ...] = (1, 2, 4), discounts: tuple[float, ...] = (1, 2, 4, 8, 16, 32, 64), lost: float = 0.04,
) -> Judge:
    """Models from three quarters of a bounded sample of labelled texts; the rest from the last quarter.

    ``docs`` has ``doc_id, text``.  Without labelled texts of both classes the judge knows
    nothing and scores 0.  The pairs of words are counted by Spark; their number is
    bounded by the sample.  Window and discount are those of the smallest loss on the last
    quarter.  There and in the weights, wrongly accusing the ordinary class counts
    ``caution`` times as much as missing the toxic one.  ``lost`` is the share of the
    ordinary texts of that quarter that may reach the threshold of the judge.
    """
    texts = sample(docs, labels, max_docs, max_chars)
    best, least = Judge(None, windows[0], np.zeros(3)), np.inf
    if texts.select("toxic").distinct().count() < 2:
        return best
    triples = texts.filter("not calibrates").select("text", "toxic").mapInArrow(_triples, _TRIPLES).distinct()
    pairs = written(
        triples.groupBy("left", "right").agg(
            F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("ordinary")
        ),
        "toxicity-pairs",
    )
    # A row for each word, and the pairs frequent enough to matter: both bounded by the sample.
    behind = pairs.groupBy(F.col("right").alias("word")).agg(
        F.count_if(F.col("toxic") > 0).alias("t"), F.count_if(F.col("ordinary") > 0).alias("o")
    )
    before = pairs.groupBy(F.col("left").alias("word")).agg(
        F.sum("toxic").alias("after_t"), F.sum("ordinary").alias("after_o")
    )
    got = behind.join(before, "word", "full").fillna(0).orderBy("word").toArrow()
    if not len(got):
        return best
    words = got.column("word").to_numpy()
    kinds = np.column_stack([got.column(n).to_numpy() for n in ("t", "o")])
    after = np.column_stack([got.column(n).to_numpy() for n in ("after_t", "after_o")])
    got = pairs.filter(F.greatest("toxic", "ordinary") > min(discounts)).toArrow()
    left, right = got.column("left").to_numpy(), got.column("right").to_numpy()
    counts = np.column_stack([got.column(n).to_numpy() for n in ("toxic", "ordinary")])
    read = Reader()
    rest = texts.filter("calibrates").select("text", "toxic").toArrow()
    codes = [read(t) for t in rest.column("text").to_pylist()]
    truth = rest.column("toxic").to_numpy()
    share = shares(truth, caution)
    for discount in discounts:
        models = ClassModels(words, kinds, after, left, right, counts, discount)
        ratios = [models.ratios(c) for c in codes]
        for window in windows:
            found = np.array([evidence(r, window) for r in ratios]).reshape(-1, 2)
            judge = Judge(models, window, logistic(found, truth, share))
            p = np.clip(judge.chances(found), 1e-6, 1 - 1e-6)
            loss = -(share * np.log(np.where(truth > 0, p, 1 - p))).sum()
            if loss < least:
                best, least = replace(judge, threshold=threshold(p, truth, lost)), loss
    return best


def scored(docs: DataFrame, judge: Judge, text_col: str = "text", name: str = "toxic_score") -> DataFrame:
    """``docs`` with the score of each whole text in a column ``name``, which it may not have yet.

    No shuffle; the models are broadcast, and bounded by the sample they come from.
    """
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(judge)

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        read = Reader()
        for batch in batches:
            found = [shared.value.scores([read(t.as_py())])[0] for t in batch.column(text_col)]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, name])
        del read
        release()

    kept = docs.schema
    return docs.mapInArrow(score_batches, T.StructType([*kept.fields, T.StructField(name, T.DoubleType())]))


def score(docs: DataFrame, judge: Judge, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score``: how likely each whole text is toxic, from 0 to 1.

    Null and empty texts are scored as texts without evidence; repeated rows are scored each;
    an empty table gives an empty one.  A judge trained without texts of both classes gives
    0 everywhere.  Other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return scored(rows, judge, name="score").select("doc_id", "score")
