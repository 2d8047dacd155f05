"""Nearest neighbours by lists and an adaptive scan of dimensions.

Vectors are rotated at random, so that any first few dimensions are a fair sample of a
distance.  Within a probed list they lie in blocks of columns; after each block of columns a
hypothesis test compares the partial distance with the best found so far, and candidates
that are most likely too far are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriledger.llm.common import groups, smallest, written

_INDEX = "vec_id bigint, list int, vector binary"
_INDEX_ARROW = pa.schema([("vec_id", pa.int64()), ("list", pa.int32()), ("vector", pa.binary())])
_PROBES = "query_id bigint, nearest boolean, list int, vector binary"
_PROBES_ARROW = pa.schema(
    [("query_id", pa.int64()), ("nearest", pa.bool_()), ("list", pa.int32()), ("vector", pa.binary())]
)
_FOUND = "query_id bigint, vec_id bigint, score double"
_FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


@dataclass(frozen=True)
class Coarse:
    """Rotation and list centres, learned on a bounded sample, and how many lists to probe."""

    rotation: np.ndarray
    centres: np.ndarray
    probes: int

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances to the centres, of unrotated vectors."""
        x = vectors @ self.rotation
        return np.maximum(0, (x**2).sum(1)[:, None] + (self.centres**2).sum(1)[None] - 2 * x @ self.centres.T)


def _stacked(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, width)


def _packed(vectors: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in vectors], pa.binary())


def taking_part(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part.

    Left out: null ids and vectors, vectors of zeros, vectors with null or non-finite
    components, and vectors of another length than the most frequent one (the larger of
    equally frequent ones), to which distances are not defined.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    usable = (
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    rows = rows.filter(F.coalesce(usable, F.lit(False)))
    lengths = rows.groupBy(F.size("embedding").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return rows.filter(F.size("embedding") == (usual["length"] if usual else 0))


def learn(rows: DataFrame, n: int, k: int, recall: float, sample_values: int = 1_500_000, seed: int = 7) -> Coarse:
    """Centres by k-means, and the number of lists that holds ``recall`` of the neighbours.

    Both on a sample of at most ``sample_values`` components, the rows of smallest hash; the
    number of lists is the square root of ``n``, an eighth of the sample at most.
    """
    width = len(rows.first()["embedding"])
    size = max(64, min(20_000, sample_values // width))
    got = smallest(rows, F.xxhash64("vec_id"), ["vec_id"], n, size).select("embedding").toArrow()
    x = np.array(got.column("embedding").to_pylist(), dtype=np.float64)
    random = np.random.default_rng(seed)
    rotation = np.linalg.qr(random.standard_normal((width, width)))[0]
    x = x @ rotation
    distinct = np.unique(x, axis=0)
    lists = max(1, min(int(round(n**0.5)), len(distinct), max(1, len(x) // 8)))
    centres = distinct[random.choice(len(distinct), lists, replace=False)].copy()

    def nearest(points: np.ndarray) -> np.ndarray:
        return np.argsort((centres**2).sum(1)[None] - 2 * points @ centres.T, axis=1, kind="stable")

    for _ in range(8):
        own = nearest(x)[:, 0]
        counts = np.bincount(own, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    asked = x[:256]
    square = (x**2).sum(1)[None] - 2 * asked @ x.T
    square[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    close = np.argsort(square, axis=1, kind="stable")[:, : min(k, max(0, len(x) - 1))]
    rank = np.argsort(nearest(asked), axis=1)  # of each list, as seen from each query
    ranks = np.sort(rank[np.arange(len(asked))[:, None], nearest(x)[:, 0][close]].ravel())
    probes = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))]) + 1 if len(ranks) else lists
    return Coarse(rotation, centres, probes)


def scan(
    columns: list[np.ndarray], query: np.ndarray, k: int, limit: float, epsilon: float, vectors: np.ndarray,
    exact_query: np.ndarray, step: int = 256, names: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list that may be among the ``k`` nearest, with exact distances.

    ``columns`` are the rotated vectors in blocks of columns, ``vectors`` the original ones.
    ``limit`` is a distance beyond which nothing is wanted.  With ``names`` rows of the same
    name are one candidate, at its smallest distance.
    """
    width, count = len(query), len(vectors)
    rows, scores = np.zeros(0, dtype=np.int64), np.zeros(0)
    for start in range(0, count, step):
        alive = np.arange(start, min(count, start + step))
        partial = np.zeros(len(alive))
        seen = 0
        for block in columns:
            part = block[:, alive] if len(alive) < step else block[:, start : start + step]
            partial = partial + ((part - query[seen : seen + len(block), None]) ** 2).sum(axis=0)
            seen += len(block)
            if seen < width and np.isfinite(limit):
                # Would a vector within the limit show so large a part of its distance?
                keep = partial <= limit**2 * seen / width * (1 + epsilon / seen**0.5) ** 2 + 1e-12
                alive, partial = alive[keep], partial[keep]
                if not len(alive):
                    break
        if len(alive):
            exact = np.sqrt(((vectors[alive] - exact_query) ** 2).sum(axis=1))
            rows, scores = np.concatenate([rows, alive]), np.concatenate([scores, exact])
            best = np.lexsort((rows, scores))
            if names is not None:
                best = best[np.sort(np.unique(names[rows[best]], return_index=True)[1])]
            best = best[:k]
            rows, scores = rows[best], scores[best]
            if len(rows) == k:
                limit = min(limit, scores[-1])
    return rows, scores


def _searched(coarse, k: int, epsilon: float, block: int = 16):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation = coarse.value.rotation
        width = len(rotation)
        for group in groups(batches, "key"):
            asks = group.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            if asks.all() or not asks.any():
                continue
            ids = group.column("id").to_numpy()
            limits = group.column("limit").to_numpy()
            every = _stacked(group.column("vector"), width)
            order = np.flatnonzero(~asks)[np.argsort(ids[~asks], kind="stable")]  # ties go to smaller ids
            vectors, names = every[order], ids[order]
            turned = np.ascontiguousarray((vectors @ rotation).T)
            columns = [turned[i : i + block] for i in range(0, width, block)]
            repeated = names if (names[1:] == names[:-1]).any() else None
            out: tuple[list, list, list] = ([], [], [])
            for q in np.flatnonzero(asks):
                # One more than wanted, as the query may find itself.
                rows, scores = scan(
                    columns, every[q] @ rotation, k + 1, limits[q], epsilon, vectors, every[q], names=repeated
                )
                other = names[rows] != ids[q]
                found = names[rows][other][:k]
                out[0].append(np.full(len(found), ids[q]))
                out[1].append(found)
                out[2].append(scores[other][:k])
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in out], schema=_FOUND_ARROW)

    return search


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest ids of each query, each at its smallest distance."""
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_neighbours(
    vectors: DataFrame, every: int = 100, k: int = 10, recall: float = 0.99, epsilon: float = 3.0,
    block_rows: int = 4096, chunk_queries: int = 2048,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of each row with ``vec_id % every == 0``.

    ``score`` is the Euclidean distance of the original vectors in double precision, ties go
    to the smaller id; a query finds all other rows if they are fewer than ``k``.  See
    ``taking_part`` for the rows that are left out.  Rows that repeat an id are one
    candidate or one query, at the smallest distance, and never their own neighbour.  An
    empty table gives an empty one; other columns have no part, whatever their names.

    Every row is indexed.  A list is searched in blocks of about ``block_rows`` rows and
    chunks of about ``chunk_queries`` of the queries that probe it, so that neither a list
    with a third of all rows nor one that many queries probe has to fit in a task, and a
    list is copied only as often as its own queries ask for.  Each query searches its
    nearest list first; its k-th distance there bounds the scan of the other lists.  Lists
    are probed up to the calibrated number, and on until they hold more than ``k`` rows.
    """
    spark = vectors.sparkSession
    rows = taking_part(vectors)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    coarse = spark.sparkContext.broadcast(learn(rows, n, k, recall))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("embedding").to_pylist(), dtype=np.float64)
            lists = coarse.value.distances(x).argmin(axis=1).astype(np.int32)
            yield pa.record_batch([batch.column("vec_id"), pa.array(lists), _packed(x)], schema=_INDEX_ARROW)

    index = written(rows.mapInArrow(assign, _INDEX), "vector-lists")
    sizes = dict(index.groupBy("list").count().collect())  # a row for each list
    held = spark.sparkContext.broadcast(sizes)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = coarse.value
        counts = np.array([held.value.get(i, 0) for i in range(len(model.centres))])
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _stacked(batch.column("vector"), len(model.rotation))
            order = np.argsort(model.distances(x), axis=1, kind="stable")
            for i, query in enumerate(batch.column("vec_id").to_pylist()):
                lists = order[i][counts[order[i]] > 0]
                enough = 1 + int(np.searchsorted(np.cumsum(counts[lists]), k + 1))
                lists = lists[: max(model.probes, enough)]
                m = len(lists)
                yield pa.record_batch(
                    [
                        pa.array(np.full(m, query)), pa.array(np.arange(m) == 0),
                        pa.array(lists.astype(np.int32)), _packed(np.broadcast_to(x[i], (m, x.shape[1]))),
                    ],
                    schema=_PROBES_ARROW,
                )

    queries = index.filter(F.col("vec_id") % every == 0)
    probes = queries.select("vec_id", "vector").mapInArrow(probe, _PROBES)
    asked = {(r["nearest"], r["list"]): r["count"] for r in probes.groupBy("nearest", "list").count().collect()}  # two rows a list

    def searched(asking: DataFrame, nearest: bool) -> DataFrame:
        """``asking`` has ``query_id, list, vector, limit``."""
        plan = [(i, -(-n // block_rows), -(-asked[nearest, i] // chunk_queries)) for i, n in sizes.items() if (nearest, i) in asked]
        lists = F.broadcast(spark.createDataFrame(plan, "list int, blocks int, chunks int"))
        candidates = index.join(lists, "list").select(
            "list", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
            F.lit(False).alias("asks"), F.col("vec_id").alias("id"), F.lit(0.0).alias("limit"), "vector",
        )
        placed_asking = asking.join(lists, "list").select(
            "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int").alias("chunk"),
            F.lit(True).alias("asks"), F.col("query_id").alias("id"), "limit", "vector",
        )
        both = candidates.unionByName(placed_asking).withColumn("key", F.xxhash64("list", "block", "chunk"))
        ordered = both.select("key", "asks", "id", "limit", "vector").repartition("key").sortWithinPartitions("key")
        return ordered.mapInArrow(_searched(coarse, k, epsilon), _FOUND)

    first = written(
        _best(searched(probes.filter("nearest").withColumn("limit", F.lit(float("inf"))), True), k), "nearest-list"
    )
    limits = first.filter(F.col("rank") == k).select("query_id", F.col("score").alias("limit"))
    others = probes.filter("not nearest").join(limits, "query_id", "left").withColumn(
        "limit", F.coalesce("limit", F.lit(float("inf")))
    )
    every_found = first.select("query_id", "vec_id", "score").unionByName(searched(others, False))
    return _best(every_found, k).select("query_id", "rank", "vec_id", "score")
