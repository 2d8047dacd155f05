"""A gated recurrent language model in numpy, over corpus counts from Spark.

The model predicts the class of the next word and then the word within its class; words
outside its shortlist form one class, in which a word has its share of the corpus counts.
Every task trains on its part of the corpus by truncated backpropagation, carrying the state
from window to window of a document; the trained parts are averaged.  Scoring carries the
state through whole documents in the same way.
"""

from __future__ import annotations

import heapq
import struct
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.llm.common import bounded_batches, written

CLASSES, PER_CLASS, HIDDEN = 32, 32, 8
SHORTLIST = CLASSES * PER_CLASS
REST = SHORTLIST  # the number of every word outside the shortlist
LANES, WINDOW = 1024, 16
LONGEST = 128  # steps of a window that only few lanes last through
# Words whose counts go to every task.  Others are looked up by a join.
HEAVY = 65_536
END = xxhash.xxh3_64_intdigest(b"") - (1 << 63)  # the code of no word, as none is empty

_COUNT = "code bigint, n bigint"
_COUNT_ARROW = pa.schema([("code", pa.int64()), ("n", pa.int64())])
_PART = "tokens bigint, weights array<float>"
_PART_ARROW = pa.schema([("tokens", pa.int64()), ("weights", pa.list_(pa.float32()))])
_PIECE = (
    "key bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, model double, rest bigint, "
    "code bigint, times bigint"
)
_PIECE_ARROW = pa.schema(
    [
        ("key", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base", pa.float64()), ("model", pa.float64()), ("rest", pa.int64()), ("code", pa.int64()),
        ("times", pa.int64()),
    ]
)


def code_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


class _Known(dict):
    """What is to be known of each word, as bytes that can be joined."""

    def __init__(self, describe: Callable[[bytes], bytes]):
        self.describe = describe

    def __missing__(self, word: bytes) -> bytes:
        value = self[word] = self.describe(word)
        return value


class Tokens:
    """The words of whole texts and their end as an array; remembers a bounded number of words."""

    def __init__(self, describe: Callable[[bytes], bytes], kind, memory: int = 250_000):
        self.known, self.kind, self.memory = _Known(describe), np.dtype(kind), memory

    def __call__(self, text: bytes | None) -> np.ndarray:
        if len(self.known) > self.memory:
            self.known.clear()
        # On bytes, lower() and split() know just A-Z and the ASCII blanks.
        words = (text or b"").lower().split()
        words.append(b"")
        return np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype=self.kind)


_COUNTED: dict[bytes, int] = {}  # codes, kept by a worker from task to task


def _counted(limit: int = 400_000):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            if len(_COUNTED) > limit:
                _COUNTED.clear()
            codes = [_COUNTED.get(w) or _COUNTED.setdefault(w, code_of(w)) for w in counts]
            return pa.record_batch([pa.array(codes, pa.int64()), pa.array([*counts.values()], pa.int64())], schema=_COUNT_ARROW)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update((text or b"").lower().split())
            counts[b""] += batch.num_rows
            if len(counts) > limit:
                yield flush()
                counts.clear()
        if counts:
            yield flush()

    return count


@dataclass(frozen=True)
class Vocabulary:
    """Totals of the training tokens, and the counts of the most frequent of them."""

    tokens: int
    kinds: int
    codes: np.ndarray  # sorted, at most HEAVY
    counts: np.ndarray
    numbers: np.ndarray  # in the shortlist, or REST
    bias: np.ndarray = field(repr=False)  # log share of each shortlisted word, then of the rest

    @property
    def whole(self) -> int:
        return self.tokens + self.kinds + 1

    def end(self) -> int:
        """The number of the end of a text."""
        return int(self.numbers[self.codes == END][0]) if (self.codes == END).any() else REST

    def reader(self, kind: str) -> Tokens:
        """Texts as shortlist ``numbers``, or as ``places`` among the frequent words (or -1) and codes.

        A worker keeps its readers from task to task.
        """
        key = (kind, self.tokens, self.kinds)
        if key not in _READERS:
            if len(_READERS) > 1:
                _READERS.clear()
            place = dict(zip(self.codes.tolist(), range(len(self.codes)), strict=True))
            if kind == "numbers":
                forms = [np.int32(n).tobytes() for n in range(REST + 1)]
                numbers = dict(zip(self.codes.tolist(), self.numbers.tolist(), strict=True))
                _READERS[key] = Tokens(lambda w: forms[numbers.get(code_of(w), REST)], np.int32)
            else:
                pack = struct.Struct("<qi").pack
                _READERS[key] = Tokens(lambda w: pack(c := code_of(w), place.get(c, -1)), _PLACED)
        return _READERS[key]


_PLACED = [("code", "<i8"), ("place", "<i4")]
_READERS: dict[tuple, Tokens] = {}


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From a table ``code, n``: totals, and at most HEAVY rows of it."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("kinds")).first()
    top = counts.orderBy(F.desc("n"), "code").limit(HEAVY).toArrow()
    codes, n = top.column("code").to_numpy(), top.column("n").to_numpy()
    order = np.argsort(codes)
    numbers = np.where(np.arange(len(codes)) < SHORTLIST, np.arange(len(codes)), REST)
    whole = total["n"] + total["kinds"] + 1
    share = np.zeros(SHORTLIST + 1)
    share[: min(SHORTLIST, len(n))] = (n[:SHORTLIST] + 1) / whole
    share[REST] = max(1 - share[:SHORTLIST].sum(), 1 / whole)
    # Places without a word have a share too small to matter, but not none.
    bias = np.log(np.maximum(share, 1e-12))
    return Vocabulary(total["n"], total["kinds"], codes[order], n[order], numbers[order], bias)


def _shares(h: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """softmax(w h + b), row by row."""
    e = h @ w.T
    e += b
    np.exp(np.minimum(e, 60, out=e), out=e)
    e /= (e @ np.ones(e.shape[1], dtype=e.dtype))[:, None]
    return e


class GatedModel:
    """State, gates and outputs.

    ``z, r = sigmoid(eg[x] + h ug)``, the update and the reset gate, ``c = tanh(eh[x] + (r * h) uh)``,
    ``h = (1 - z) * h + z * c``; each unit sees the whole last state.  The class of the next word is
    softmax(wc h + bc), the word within it softmax(ww h + bw).
    """

    SHAPES = {
        "eg": (SHORTLIST + 1, 2 * HIDDEN), "eh": (SHORTLIST + 1, HIDDEN), "ug": (HIDDEN, 2 * HIDDEN), "uh": (HIDDEN, HIDDEN),
        "wc": (CLASSES + 1, HIDDEN), "bc": (CLASSES + 1,), "ww": (SHORTLIST, HIDDEN), "bw": (SHORTLIST,),
    }

    def __init__(self, weights: np.ndarray):
        self.weights, at = np.asarray(weights, dtype=np.float32).copy(), 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, self.weights[at : at + size].reshape(shape))  # views
            at += size

    @classmethod
    def start(cls, bias: np.ndarray, seed: int = 11) -> GatedModel:
        """Small random weights, and the words' shares as biases: no worse than counts alone."""
        random = np.random.default_rng(seed)
        model = cls(random.normal(0, 0.3, sum(int(np.prod(s)) for s in cls.SHAPES.values())))
        share = np.exp(bias)
        model.bw[:] = bias[:SHORTLIST]
        model.bc[:CLASSES] = np.log(share[:SHORTLIST].reshape(CLASSES, PER_CLASS).sum(1))
        model.bc[CLASSES] = bias[REST]
        model.wc[:] *= 0.1
        model.ww[:] *= 0.1
        return model

    def states(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray):
        """States before and after each step of a window (steps by lanes), between them both gates and the candidates."""
        steps = len(x)
        before, c, after = (np.empty((steps, *h.shape), dtype=np.float32) for _ in range(3))
        gates, eh = self.eg[x], self.eh[x]
        begins = fresh.any(axis=1)
        for t in range(steps):
            old, g = before[t], gates[t]
            old[:] = h if not begins[t] else np.where(fresh[t][:, None], np.float32(0), h)
            g += old @ self.ug
            np.exp(np.negative(g, out=g), out=g)
            g += 1
            np.reciprocal(g, out=g)
            np.tanh(eh[t] + (g[:, HIDDEN:] * old) @ self.uh, out=c[t])
            after[t] = old + g[:, :HIDDEN] * (c[t] - old)
            h = after[t]
        return before, gates, c, after

    def outputs(self, h: np.ndarray, y: np.ndarray, backward: bool):
        """Natural log-likelihood of the words ``y`` after the states ``h``; gradients if wanted."""
        rows = np.arange(len(y))
        kind = np.minimum(y // PER_CLASS, CLASSES)
        e = _shares(h, self.wc, self.bc)
        out = np.log(e[rows, kind])
        if backward:
            e[rows, kind] -= 1
            grads = {"wc": e.T @ h, "bc": e.sum(0), "ww": np.zeros_like(self.ww), "bw": np.zeros_like(self.bw)}
            dh = e @ self.wc
        order = np.argsort(kind.astype(np.int16), kind="stable")  # by counting, as the numbers are short
        ends = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        order = order[: ends[CLASSES]]  # words of the shortlist, class by class
        states, within = h[order], y[order] % PER_CLASS
        likely, back = np.empty(len(order), dtype=np.float32), np.empty_like(states)
        for k in np.flatnonzero(np.diff(ends)):
            part, words = slice(ends[k], ends[k + 1]), slice(k * PER_CLASS, (k + 1) * PER_CLASS)
            p = _shares(states[part], self.ww[words], self.bw[words])
            mine = rows[: len(p)], within[part]
            likely[part] = p[mine]
            if backward:
                p[mine] -= 1
                grads["ww"][words] = p.T @ states[part]
                grads["bw"][words] = p.sum(0)
                back[part] = p @ self.ww[words]
        out[order] += np.log(np.maximum(likely, 1e-30))
        if backward:
            dh[order] += back
        return (out, grads, dh) if backward else (out, None, None)

    def gradients(self, x, fresh, before, gates, c, dh, grads) -> np.ndarray:
        """Back through the window; one vector in the order of the weights."""
        steps = len(x)
        z, r = gates[..., :HIDDEN], gates[..., HIDDEN:]
        # How a state's gradient reaches its update gate and its candidate, and that of r * h the reset gate.
        to_z, to_c, keep, to_r = (c - before) * z * (1 - z), z * (1 - c * c), 1 - z, before * r * (1 - r)
        dg, dc = np.empty_like(gates), np.empty_like(c)
        flow = np.zeros_like(dh[0])
        begins = fresh.any(axis=1)
        back_g, back_c = np.ascontiguousarray(self.ug.T), np.ascontiguousarray(self.uh.T)
        for t in range(steps - 1, -1, -1):
            total = dh[t] + flow
            np.multiply(total, to_z[t], out=dg[t, :, :HIDDEN])
            np.multiply(total, to_c[t], out=dc[t])
            reset = dc[t] @ back_c
            np.multiply(reset, to_r[t], out=dg[t, :, HIDDEN:])
            flow = total * keep[t] + reset * r[t] + dg[t] @ back_g
            if begins[t]:
                flow[fresh[t]] = 0
        dg, dc, old = dg.reshape(-1, 2 * HIDDEN), dc.reshape(-1, HIDDEN), before.reshape(-1, HIDDEN)
        grads["ug"], grads["uh"] = old.T @ dg, (r.reshape(-1, HIDDEN) * old).T @ dc
        # The rows of each word, one run after another.
        flat = x.ravel()
        order = np.argsort(flat.astype(np.int16), kind="stable")
        words, starts = np.unique(flat[order], return_index=True)
        for name, d in (("eg", dg), ("eh", dc)):
            grads[name] = np.zeros((SHORTLIST + 1, d.shape[1]), dtype=d.dtype)
            grads[name][words] = np.add.reduceat(d[order], starts, axis=0)
        return np.concatenate([np.asarray(grads[name], dtype=np.float32).ravel() for name in self.SHAPES])


class Lanes:
    """Documents laid end to end in lanes of like length, longest lane first."""

    def __init__(self, docs: list[np.ndarray], lanes: int = LANES):
        # Enough steps for some hundred windows, however few the documents.
        lanes = max(1, min(lanes, len(docs), sum(map(len, docs)) // (100 * WINDOW))) if docs else 0
        heap = [(0, lane) for lane in range(lanes)]
        self.lanes: list[list[int]] = [[] for _ in range(lanes)]
        for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            held, lane = heap[0]
            self.lanes[lane].append(i)
            heapq.heapreplace(heap, (held + len(docs[i]), lane))
        lengths = [sum(len(docs[i]) for i in lane) for lane in self.lanes]
        self.lanes = [self.lanes[k] for k in np.argsort([-n for n in lengths], kind="stable")]
        self.lengths = np.sort(lengths)[::-1].astype(np.int64)
        self.steps = int(self.lengths[0]) if lanes else 0
        laid = [i for lane in self.lanes for i in lane]
        self.y = np.concatenate([docs[i] for i in laid]) if laid else np.zeros(0, dtype=np.int32)
        self.owner = np.repeat(np.array(laid, dtype=np.int32), [len(docs[i]) for i in laid])
        # The word before each word; before the first one of a document, the end of nothing.
        self.fresh = np.ones(len(self.y), dtype=bool)
        self.fresh[1:] = self.owner[1:] != self.owner[:-1]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def windows(self, end: int, size: int = WINDOW, longest: int = LONGEST):
        """Windows of steps by the lanes that last through them; ``x`` is the word before ``y``.

        The first word of a document follows the end of nothing, with a fresh state.  The fewer
        lanes are left, the longer the windows, so that each has about as many words.
        """
        before = np.empty_like(self.y)
        before[1:] = self.y[:-1]
        before[self.fresh] = end
        start = 0
        while start < self.steps:
            active = int(np.searchsorted(-self.lengths, -start))
            steps = max(size, min(longest, size * len(self.lanes) // active))
            # A window ends where a lane does, so that all its lanes are whole.
            stop = start + int(min(steps, self.lengths[active - 1] - start))
            at = self.starts[:active] + np.arange(start, stop)[:, None]
            yield before[at], self.y[at], self.owner[at], self.fresh[at]
            start = stop


def train_on(model: GatedModel, docs: list[np.ndarray], end: int, memory: np.ndarray, rate: float) -> None:
    """One pass over some documents, an Adagrad step a window; the state flows from window to window."""
    lanes = Lanes(docs)
    h = np.zeros((len(lanes.lanes), HIDDEN), dtype=np.float32)
    for x, y, _, fresh in lanes.windows(end):
        before, z, c, after = model.states(x, fresh, h[: x.shape[1]])
        _, grads, dh = model.outputs(after.reshape(-1, HIDDEN), y.ravel(), True)
        g = model.gradients(x, fresh, before, z, c, dh.reshape(after.shape), grads)
        g /= len(lanes.lanes) * WINDOW  # a window of few lanes counts for little
        memory += g * g
        model.weights -= rate * g / np.sqrt(memory + 1e-10)
        h = after[-1]


def score_of(model: GatedModel, docs: list[np.ndarray], end: int) -> np.ndarray:
    """The natural log-likelihood of each whole document's shortlist numbers."""
    total = np.zeros(len(docs))
    lanes = Lanes(docs)
    h = np.zeros((len(lanes.lanes), HIDDEN), dtype=np.float32)
    for x, y, owner, fresh in lanes.windows(end):
        after = model.states(x, fresh, h[: x.shape[1]])[-1]
        found, _, _ = model.outputs(after.reshape(-1, HIDDEN), y.ravel(), False)
        total += np.bincount(owner.ravel(), weights=found, minlength=len(docs))
        h = after[-1]
    return total


def _chunks(batches: Iterator[pa.RecordBatch], read: Tokens, limit: int):
    """Runs of rows with about ``limit`` tokens: ids and tokens."""
    ids, docs, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids.append(doc_id)
            docs.append(read(text))
            held += len(docs[-1])
            if held >= limit:
                yield ids, docs
                ids, docs, held = [], [], 0
    if docs:
        yield ids, docs


def _trainer(shared, rate: float, limit: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Vocabulary = shared.value
        model = GatedModel.start(words.bias)
        memory, tokens, end = np.zeros_like(model.weights), 0, words.end()
        for _, docs in _chunks(batches, words.reader("numbers"), limit):
            train_on(model, docs, end, memory, rate)
            tokens += sum(map(len, docs))
        if tokens:
            yield pa.record_batch([pa.array([tokens]), pa.array([model.weights], pa.list_(pa.float32()))], schema=_PART_ARROW)

    return train


def _scorer(shared, weights, limit: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Vocabulary = shared.value
        model, end = GatedModel(weights.value), words.end()
        logs = np.log10((words.counts + 1) / words.whole)
        key = TaskContext.get().partitionId() << 33
        for ids, docs in _chunks(batches, words.reader("places"), limit):
            n = len(docs)
            owner = np.repeat(np.arange(n), [len(d) for d in docs])
            tokens = np.concatenate(docs)
            codes, places = tokens["code"], tokens["place"]
            numbers = np.append(words.numbers, REST)[places].astype(np.int32)
            ends = np.cumsum([len(d) for d in docs])[:-1]
            likely = score_of(model, np.split(numbers, ends), end) / np.log(10)
            frequent = places >= 0
            known = np.bincount(owner[frequent], minlength=n)
            base = np.where(frequent, logs[places] if len(logs) else 0.0, 0.0)
            rest = numbers == REST
            # A frequent word outside the shortlist has its share of the rest.
            likely += np.bincount(owner[rest], weights=base[rest], minlength=n)
            rows = [
                pa.array(key + np.arange(n)), pa.array(ids, pa.int64()), pa.array(np.bincount(owner, minlength=n)),
                pa.array(known), pa.array(np.bincount(owner, weights=base, minlength=n)), pa.array(likely),
                pa.array(np.bincount(owner[rest], minlength=n)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
            ]
            yield pa.record_batch(rows, schema=_PIECE_ARROW)
            rare = np.flatnonzero(~frequent)
            order = rare[np.lexsort((codes[rare], owner[rare]))]
            o, c = owner[order], codes[order]
            first = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (c[1:] != c[:-1])])) if len(o) else np.zeros(0, int)
            m = len(first)
            empty = [pa.nulls(m, f.type) for f in list(_PIECE_ARROW)[1:7]]
            times = np.diff(np.append(first, len(o)))
            yield pa.record_batch(
                [pa.array(key + o[first]), *empty, pa.array(c[first]), pa.array(times)], schema=_PIECE_ARROW
            )
            key += n

    return score


def score(
    docs: DataFrame, learns: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.2,
    chunk_tokens: int = 1_500_000,
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    Counts and model are learned from all of ``learns``.  Tokens are what stands between
    blanks (a space, U+0009 to U+000D), with A-Z in lower case, and one end for each text.
    ``base_score`` sums log10((c + 1) / (N + V + 1)) over a text's tokens; ``score`` is the
    model's log10 probability of the whole text.  Both probabilities sum to one over the V
    kinds of the training tokens and one unknown kind.

    Words travel as 64-bit codes.  The 65536 most frequent go to every task, as does the
    model, which has a fixed size; the counts of others, however many, are joined.  Every
    task trains on all of its texts from the same start; the parts are averaged by their
    tokens and depend on how the input is split, so other splits give slightly other scores.
    Null texts are empty: one end.  Repeated rows are scored each, and train each.  With
    nothing to learn from, every kind is unknown; empty ``docs`` give an empty table.  Texts
    of any length are scored whole, with the state carried through.  Other columns are
    ignored, whatever their names.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    learning = plain(learns)
    counts = written(
        learning.select("text").mapInArrow(_counted(), _COUNT).groupBy("code").agg(F.sum("n").alias("n")), "token-counts"
    )
    words = vocabulary(counts)
    shared = spark.sparkContext.broadcast(words)
    parts = written(learning.mapInArrow(_trainer(shared, rate, chunk_tokens), _PART), "model-parts")
    averaged = (
        parts.select("tokens", F.posexplode("weights").alias("place", "weight"))
        .groupBy("place").agg((F.sum(F.col("weight") * F.col("tokens")) / F.sum("tokens")).alias("weight"))
        .orderBy("place").toArrow()
    )
    model = averaged.column("weight").to_numpy() if len(averaged) else GatedModel.start(words.bias).weights
    weights = spark.sparkContext.broadcast(np.asarray(model, dtype=np.float32))
    pieces = written(plain(docs).mapInArrow(_scorer(shared, weights, chunk_tokens), _PIECE), "score-pieces")
    log = F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(words.whole)))
    rare = (
        pieces.filter("code is not null").select("key", "code", "times").join(counts, "code", "left")
        .groupBy("key").agg(
            F.sum(F.col("times") * log).alias("rare_base"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    rare_base = F.coalesce("rare_base", F.lit(0.0))
    # The share of the rest: what the counts leave to words outside the shortlist.
    left = float(words.bias[REST] / np.log(10))
    return (
        pieces.filter("code is null").drop("code", "times").join(rare, "key", "left")
        .select(
            "doc_id", "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(words.tokens).cast("bigint").alias("train_tokens"),
            (F.col("base") + rare_base).alias("base_score"),
            (F.col("model") + rare_base - F.col("rest") * left).alias("score"),
        )
    )
