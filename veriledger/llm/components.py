"""Connected components of an undirected graph, distributed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.llm.common import written

EDGES = "a bigint, b bigint"
EDGE_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def edge_batch(a, b) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=EDGE_ARROW)


class UnionFind:
    """Sets of numbers; the smallest number of a set is its root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        parent.setdefault(x, x)
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def stars(self) -> tuple[list[int], list[int]]:
        """Every number that is no root, with its root."""
        pairs = [(x, top) for x in list(self.parent) if (top := self.root(x)) != x]
        return [p[0] for p in pairs], [p[1] for p in pairs]


def _contract(limit: int):
    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = UnionFind()
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                sets.join(a, b)
            if len(sets.parent) > limit:  # bounds the memory of a task; a star keeps its set joined
                yield edge_batch(*sets.stars())
                sets = UnionFind()
        yield edge_batch(*sets.stars())

    return contract


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame, limit: int = 500_000, rounds: int = 100) -> DataFrame:
    """``id, root``: for every node that is not the smallest of its component, that smallest node.

    ``edges`` has columns ``a`` and ``b`` without nulls, in any order and number.  Each task
    first contracts its edges by union-find; then large and small stars alternate until the
    graph consists of stars.  A hub's edges are spread by the join, never gathered.  Every
    round is written to the shared folder.
    """
    oriented = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    now = written(oriented.mapInArrow(_contract(limit), EDGES).distinct(), "components")
    mark = None
    for _ in range(rounds):
        now = written(_small_star(_large_star(now).distinct()).distinct().mapInArrow(_contract(limit), EDGES).distinct(), "components")
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if tuple(row) == mark:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
        mark = tuple(row)
    raise RuntimeError("the components did not settle")


def spanning(links: np.ndarray, ids: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges that join what a symmetric matrix of links joins, each set to its smallest id."""
    left = np.ones(len(ids), dtype=bool)
    a: list[int] = []
    b: list[int] = []
    while left.any():
        seen = np.zeros(len(ids), dtype=bool)
        new = np.zeros(len(ids), dtype=bool)
        new[np.argmax(left)] = True
        while new.any():
            seen |= new
            new = links[new].any(axis=0) & ~seen
        left &= ~seen
        found = ids[seen]
        root = found.min()
        rest = found[found != root]
        a += rest.tolist()
        b += [int(root)] * len(rest)
    return a, b
