"""Near-duplicates: SuperMinHash signatures, banding, exact verification, union-find groups.

Nothing of the size of a group ever sits in one task, and no pairs of a group are emitted:
every step gives at most one edge per member.

1. Equal shingle sets are one class; its smallest id stands for it.
2. Classes that share a band are candidates.  Within a bucket, those whose signatures agree
   enough are joined by a spanning forest.  A bucket that is too large for a task is joined
   as a whole: a superset of its links.
3. The components of these edges are clusters: two linked classes share a cluster.
4. Clusters are verified on full shingle sets.  A large cluster is cut into blocks, each
   compared with itself and with one anchor block; whatever is then still outside the
   cluster's main component is compared with every block.
5. The components of the verified links are the groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.llm.common import bounded_batches, forget, groups, release, written
from veriledger.llm.components import EDGES, components, edge_batch, spanning

WIDTH = 5
SLOTS = 128
ROWS = 4
# A link is verified where intersection >= 3/4 of the union.
PART, WHOLE = 75, 100
# Signatures of linked sets agree in 3/4 of the slots, give or take 0.038 (one deviation);
# candidates may fall short of that by over four deviations.
AGREEMENT = 0.58

_SIGNATURE_ROW = "doc_id bigint, n_shingles bigint, digest binary, signature binary"
_SIGNATURE_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("signature", pa.binary())]
)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Distinct hashed shingles of texts; remembers the hashes of a bounded number of words."""

    def __init__(self, width: int = WIDTH, memory: int = 500_000):
        self.width, self.memory = width, memory
        self.hashes = _WordHashes()

    def __call__(self, text: bytes | None) -> np.ndarray:
        # On bytes, lower() and split() know just A-Z and the ASCII blanks.
        words = (text or b"").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.hashes) > self.memory:
            self.hashes.clear()
        h = np.array([self.hashes[w] for w in words], dtype=np.uint64)
        width = min(self.width, len(h))
        out = np.full(len(h) - width + 1, len(words) if len(words) < self.width else 0, dtype=np.uint64)
        for k in range(width):
            out = mixed(out ^ h[k : len(h) - width + 1 + k])
        return np.unique(out)


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash: a row of 16-bit slot values for each set; rows of empty sets mean nothing.

    Element e draws in round j a value in [j, j + 1) and the next slot of its own random
    permutation.  A set is done once all its slots are filled, since later rounds give only
    larger values; large sets stop after a few rounds.
    """
    lowest = np.full((len(sets), slots), np.inf)
    flat = lowest.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    order = None
    for j in range(slots):
        if not len(element):
            break
        draw = mixed(element + np.uint64((j + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
        value = (draw >> np.uint64(32)).astype(np.float64) * 2.0**-32 + j
        at = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = at
        else:
            row = np.arange(len(element))
            slot = order[row, at]
            order[row, at] = order[row, j]
        np.minimum.at(flat, owner * slots + slot, value)
        open_sets = np.isinf(lowest).any(axis=1)
        if j == 0 or open_sets[owner].mean() < 0.7:
            keep = open_sets[owner]
            element, owner = element[keep], owner[keep]
            if order is None:
                order = np.empty((len(element), slots), dtype=np.uint8)
                order[:] = np.arange(slots, dtype=np.uint8)
                order[np.arange(len(element)), at[keep]] = 0  # the swap of the first round
            else:
                order = order[keep]
    return (mixed(lowest.view(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def _signed(slice_words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shingle = Shingler()
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            start, held, sets = 0, 0, []
            for i, text in enumerate(texts):
                sets.append(shingle(text))
                held += len(sets[-1])
                if held >= slice_words or i == len(texts) - 1:
                    rows = signatures(sets)
                    digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                    yield pa.record_batch(
                        [
                            ids.slice(start, len(sets)),
                            pa.array([len(s) for s in sets], pa.int64()),
                            pa.array(digests, pa.binary()),
                            pa.array([r.tobytes() if len(s) else b"" for r, s in zip(rows, sets, strict=True)], pa.binary()),
                        ],
                        schema=_SIGNATURE_ARROW,
                    )
                    start, held, sets = i + 1, 0, []
        del shingle
        release()

    return sign


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_words: int = 300_000) -> DataFrame:
    """``doc_id, n_shingles, digest, signature`` of every row; the digest is that of the whole set."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(_signed(slice_words), _SIGNATURE_ROW)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket, the spanning forest of the members whose signatures agree enough."""
    a: list[int] = []
    b: list[int] = []
    for bucket in groups(batches, "bucket"):
        ids = bucket.column("id").to_numpy()
        rows = np.frombuffer(b"".join(bucket.column("signature").to_pylist()), dtype=np.uint16).reshape(len(ids), -1)
        if len(ids) == 2:
            if (rows[0] == rows[1]).mean() >= AGREEMENT:
                a.append(int(ids[0]))
                b.append(int(ids[1]))
        else:
            links = np.stack([(rows == row).mean(axis=1) >= AGREEMENT for row in rows])
            more = spanning(links, ids)
            a += more[0]
            b += more[1]
        if len(a) > 50_000:
            yield edge_batch(a, b)
            a, b = [], []
    yield edge_batch(a, b)


def candidates(classes: DataFrame, largest: int = 512) -> DataFrame:
    """Edges ``a, b`` that join any two classes sharing a band and agreeing in their signatures."""
    # The values of a band's slots, together with its number, are the bucket.
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(SLOTS // ROWS - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("signature"), i * (2 * ROWS) + 1, F.lit(2 * ROWS))),
    )
    members = classes.select(F.col("rep").alias("id"), F.explode(bands).alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("id").alias("least")).filter("size > 1")
    shared = written(members.join(sizes, "bucket"), "buckets")
    whole = shared.filter(f"size > {largest} and id > least").select(F.col("id").alias("a"), F.col("least").alias("b"))
    small = (
        shared.filter(f"size <= {largest}").select("bucket", "id")
        .join(classes.select(F.col("rep").alias("id"), "signature"), "id")
        .repartition("bucket").sortWithinPartitions("bucket")
    )
    return whole.unionByName(small.mapInArrow(_agreeing, EDGES))


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingle = Shingler()
    for batch in batches:
        sets = [shingle(t).tobytes() for t in batch.column("text").to_pylist()]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.record_batch([*(batch.column(n) for n in names), pa.array(sets, pa.binary())], names=[*names, "shingles"])
    del shingle
    release()


def _crossing(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Which sets on the left are linked to which on the right, on all their elements."""
    def coded(sets, vocabulary):
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values = np.concatenate(sets)
        at = np.searchsorted(vocabulary, values)
        at[at == len(vocabulary)] = 0
        known = vocabulary[at] == values
        order = np.argsort(at[known], kind="stable")
        return rows[known][order], at[known][order]

    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    if len(shared):
        (lr, lc), (rr, rc) = coded(left, shared), coded(right, shared)
        for start in range(0, len(shared), columns):
            # Counts below 2**24 are exact in 32-bit floats.
            x = np.zeros((len(left), columns), dtype=np.float32)
            y = np.zeros((len(right), columns), dtype=np.float32)
            i, j = np.searchsorted(lc, [start, start + columns])
            x[lr[i:j], lc[i:j] - start] = 1
            i, j = np.searchsorted(rc, [start, start + columns])
            y[rr[i:j], rc[i:j] - start] = 1
            common += x @ y.T
    both = common.astype(np.int64)
    union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None] - both
    return WHOLE * both >= PART * union


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the blocks of a stream sorted by block.

    Rows with ``asks`` are compared with the others only; without any such row, all are
    compared with all.
    """
    a: list[int] = []
    b: list[int] = []
    for block in groups(batches, "block"):
        ids = block.column("id").to_numpy()
        asks = block.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in block.column("shingles").to_pylist()]
        if len(ids) < 2:
            continue
        if asks.any():
            mine, others = np.flatnonzero(asks), np.flatnonzero(~asks)
            if not len(others):
                continue
            links = np.zeros((len(ids), len(ids)), dtype=bool)
            links[np.ix_(mine, others)] = _crossing([sets[i] for i in mine], [sets[i] for i in others])
            links |= links.T
        else:
            links = _crossing(sets, sets)
        more = spanning(links, ids)
        a += more[0]
        b += more[1]
        if len(a) > 50_000:
            yield edge_batch(a, b)
            a, b = [], []
    yield edge_batch(a, b)


def _compared(blocks: DataFrame) -> DataFrame:
    return (
        blocks.select("block", "id", "asks", "shingles")
        .repartition("block").sortWithinPartitions("block").mapInArrow(_verified, EDGES)
    )


def links(docs: DataFrame, clusters: DataFrame, block_docs: int = 512, block_shingles: int = 1_000_000) -> DataFrame:
    """Verified links ``a, b`` that join whatever the links within each cluster join.

    ``docs`` has ``id, text``, ``clusters`` has ``id, root, n_shingles``.
    """
    sizes = clusters.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    parts = F.greatest(F.ceil(F.col("n") / block_docs), F.ceil(F.col("total") / block_shingles)).cast("bigint")
    placed = clusters.join(sizes.select("root", parts.alias("parts")), "root").select("id", "root", "parts")
    fields = "id bigint, root bigint, parts bigint, shingles binary"
    sets = written(
        placed.join(docs, "id").select("id", "root", "parts", "text").mapInArrow(_shingled, fields), "shingle-sets"
    )
    # A block has a bounded number of rows but for uneven hashing; block 0 anchors its cluster.
    own = F.pmod(F.xxhash64("id"), F.col("parts"))
    here = sets.withColumn("part", own)
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    anchored = here.withColumn("part", F.explode(F.when(F.col("part") == 0, every).otherwise(F.array("part"))))
    block = F.xxhash64("root", "part").alias("block")
    first = written(
        _compared(anchored.select("id", "shingles", block, F.lit(False).alias("asks"))), "links"
    )
    large = here.filter("parts > 1").select("id", "root", "parts", "part")
    if large.isEmpty():
        return first
    # The rest: whatever is outside the main component of a large cluster asks every block.
    found = components(first)
    parts_of = large.join(found.withColumnRenamed("root", "top"), "id", "left").withColumn("top", F.coalesce("top", "id"))
    main = (
        parts_of.groupBy("root", "top").agg(F.count("*").alias("n"))
        .groupBy("root").agg(F.max_by("top", F.struct("n", "top")).alias("main"))
    )
    outside = parts_of.join(main, "root").filter("top <> main").select("id")
    asking = sets.join(outside, "id").withColumns(
        {"chunk": F.pmod(F.xxhash64("id"), F.col("parts")), "part": F.explode(every)}
    )
    chunks = asking.select("root", "chunk").distinct()
    answering = here.filter("parts > 1").join(chunks, "root")
    key = F.xxhash64("root", "part", "chunk").alias("block")
    rest = _compared(
        asking.select("id", "shingles", key, F.lit(True).alias("asks"))
        .unionByName(answering.select("id", "shingles", key, F.lit(False).alias("asks")))
    )
    return first.unionByName(written(rest, "links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Words are what stands between blanks (a space, U+0009 to U+000D), with A-Z in lower
    case; a document's set holds its distinct shingles of five words, or its whole sequence
    if it is shorter.  Documents are linked where the intersection of their sets is at least
    three quarters of the union, as counted on the full sets; ``component_id`` is the
    smallest id that links reach.

    Banding finds a pair of similarity 3/4 with a probability of 1 - (1 - 0.75**4)**32, all
    but five in a million.  Null and empty texts have no shingles and are linked with
    nothing.  A row without id takes no part: it has no component and is kept.  Rows that
    repeat an id share its result, which takes all their texts into account.  An empty table
    gives an empty one.  Texts of any length are read whole.  Other columns are ignored,
    whatever their names.
    """
    bounded_batches(docs.sparkSession)
    rows = written(sign(docs, id_col, text_col), "signatures")
    classes = written(
        rows.filter("n_shingles > 0 and doc_id is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")),
        "classes",
    )
    near = components(candidates(classes))
    reps = classes.groupBy("rep").agg(F.max("n_shingles").alias("n_shingles"))
    members = near.select("id", "root").unionByName(near.select(F.col("root").alias("id"), "root").distinct())
    clusters = members.join(reps.withColumnRenamed("rep", "id"), "id")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text")).filter(
        "id is not null and text is not null"
    )
    same = rows.filter("doc_id is not null and n_shingles > 0").select("doc_id", "digest").join(
        classes.select("digest", "rep"), "digest"
    ).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    groups = components(links(texts, clusters).unionByName(same))
    return (
        rows.select("doc_id", "n_shingles").join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
