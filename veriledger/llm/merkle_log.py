"""A Merkle manifest of a dataset as a postorder append log.

The rows of a group (say a language) are the leaves of a tree; the roots of the groups are
the leaves of one more tree.  Every two neighbouring nodes become their parent; a last one
without neighbour is hashed by itself, until one node is left.

A builder has one aligned block of a tree: 2 ** ``levels`` nodes and what is above them.  It
writes its nodes as they are completed, children right before their parent, and hands its
top to the builders above.  The place of a node in the log of its tree follows from the sizes
of the subtrees before it, so a proof finds its siblings by their places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.common import groups, written

# The number of a block within its tree is below this; with that of the tree it makes a key.
_BLOCKS = 1 << 40
# What a builder says of a node: it is in the log, it was handed up instead, it is a root in the log.
INNER, HANDED_UP, ROOT = 0, 1, 2
_LOG = "tree bigint, position bigint, level int, idx bigint, digest string, size bigint, kind int"
_LOG_ARROW = pa.schema(
    [
        ("tree", pa.int64()), ("position", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()),
        ("digest", pa.string()), ("size", pa.int64()), ("kind", pa.int32()),
    ]
)
_PROOF = T.ArrayType(T.StringType())


def height(leaves: int) -> int:
    """How often a level of nodes is halved, rounding up, until one is left."""
    return (leaves - 1).bit_length()


def position(level: int, idx: np.ndarray, leaves: int) -> np.ndarray:
    """The places of nodes of a level in the postorder of their tree, from 0.

    Before the first leaf of a node come all whole aligned subtrees that end there.  Then
    comes its own subtree, of which it is the last.
    """
    idx = np.asarray(idx, dtype=np.int64)
    first = idx << level
    before = sum(first >> i for i in range(height(leaves) + 1))
    held = np.minimum(1 << level, leaves - first)
    own = sum((held + (1 << i) - 1) >> i for i in range(level + 1))
    return before + own - 1


def joined(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def leaf_digest(*fields: str | Column) -> Column:
    """The digest of a row: ``-`` for a null field, else its number of UTF-8 bytes, a colon and its text."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(rows: DataFrame, by: list[str], order: list[str], place: str, size: str) -> DataFrame:
    """``rows`` with their place among those of the same ``by`` (from 0) and the number of these.

    Nulls come first.  The rows are range-partitioned, so a group of any size is numbered by
    many tasks, and rows that agree in everything are dealt out too; a row for each task and
    group says where the task begins.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*by, *order]]
    spread = rows.withColumn("__tie", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys)
    placed = written(ranged.drop("__tie").withColumn("__at", F.monotonically_increasing_id()), "merkle-rows")
    placed = placed.withColumn("__task", F.call_function("shiftright", "__at", F.lit(33)))
    tasks = placed.groupBy(*by, "__task").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    earlier = W.partitionBy(*by).orderBy("__task").rowsBetween(W.unboundedPreceding, -1)
    offsets = tasks.select(
        *[F.col(c).alias(f"__{c}") for c in by], F.col("__task").alias("__of"), "__first",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(W.partitionBy(*by)).alias(size),
    )
    same = F.col("__task") == F.col("__of")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    found = placed.join(offsets, same).withColumn(place, F.col("__at") - F.col("__first") + F.col("__before"))
    return found.select(*rows.columns, place, size)


def _blocks(level: Column | int, base: int, levels: int) -> Column:
    """The key of the block that nodes of a level belong to, in the round from level ``base`` on."""
    up = (F.lit(base + levels) - level).cast("int")
    return F.col("tree") * _BLOCKS + F.call_function("shiftright", F.col("idx"), up)


def _built(base: int, levels: int):
    """Builders of a round, over the blocks of nodes of level ``base``."""

    def block_log(tree: int, size: int, first: int, digests: list[str]) -> pa.RecordBatch:
        last = height(size)
        up = min(levels, last - base)
        found: list[tuple[int, int, str]] = []
        waiting: list[list[str]] = [[] for _ in range(up + 1)]  # nodes whose neighbour is yet to come
        done = [first >> level for level in range(up + 1)]

        def complete(level: int, digest: str) -> None:
            found.append((level, done[level], digest))
            done[level] += 1
            if level < up:
                waiting[level].append(digest)
                if len(waiting[level]) == 2:
                    pair, waiting[level] = waiting[level], []
                    complete(level + 1, joined(*pair))

        for digest in digests:
            complete(0, digest)
        for level in range(up):
            if waiting[level]:
                alone, waiting[level] = waiting[level], []
                complete(level + 1, joined(*alone))
        level, idx = np.array([f[0] for f in found]), np.array([f[1] for f in found], dtype=np.int64)
        place = np.zeros(len(found), dtype=np.int64)
        for one in range(up + 1):
            place[level == one] = position(base + one, idx[level == one], size)
        kind = np.where(level < up, INNER, ROOT if base + up == last else HANDED_UP)
        n = len(found)
        return pa.record_batch(
            [
                pa.array(np.full(n, tree)), pa.array(place), pa.array((base + level).astype(np.int32)), pa.array(idx),
                pa.array([f[2] for f in found]), pa.array(np.full(n, size)), pa.array(kind.astype(np.int32)),
            ],
            schema=_LOG_ARROW,
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, "key"):
            tree, size, first = (block.column(c)[0].as_py() for c in ("tree", "size", "idx"))
            yield block_log(tree, size, first, block.column("digest").to_pylist())

    return build


def append_log(leaves: DataFrame, most: int, levels: int = 12) -> list[DataFrame]:
    """The logs of the rounds of builders over ``tree, idx, digest, size``; together they hold every node once.

    ``most`` is the largest ``size``.  Round r holds the nodes from level r * ``levels`` to below the
    first level of the next, and the root of a tree that ends there.
    """
    rounds, nodes = [], leaves
    for base in range(0, max(1, height(most)), levels):
        keyed = nodes.select("tree", "idx", "digest", "size", _blocks(F.lit(base), base, levels).alias("key"))
        ordered = keyed.repartition("key").sortWithinPartitions("key", "idx")
        log = written(ordered.mapInArrow(_built(base, levels), _LOG), "merkle-log")
        rounds.append(log.filter(F.col("kind") != HANDED_UP))
        nodes = log.filter(F.col("kind") == HANDED_UP)
    return rounds


def roots(rounds: list[DataFrame]) -> DataFrame:
    """``tree, digest``: the roots of the trees of a log."""
    found = [log.filter(F.col("kind") == ROOT).select("tree", "digest") for log in rounds]
    for more in found[1:]:
        found[0] = found[0].unionByName(more)
    return found[0]


def _proving(base: int, levels: int, carried: bool):
    """Proofs from the log of a block and the proof of its top, for its lowest nodes or the rows that stand for them."""

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, "key"):
            what = block.column("what").to_numpy()
            places, levels_, idx = (block.column(c).to_numpy(zero_copy_only=False)[what == 1] for c in ("position", "level", "at"))
            if not len(places):
                continue
            digests = block.filter(pa.array(what == 1)).column("digest").to_pylist()
            above = block.filter(pa.array(what == 0)).column("above").to_pylist()[0]
            tree, size = block.column("tree")[0].as_py(), int(block.filter(pa.array(what == 1)).column("size")[0].as_py())
            # The run of this block, by place.
            order = np.argsort(places, kind="stable")
            places = places[order].astype(np.int64)
            lowest = idx[levels_ == base].astype(np.int64)
            first, last = int(lowest.min()), int(lowest.max())
            beside = []  # of each level the siblings, looked up by their places
            for level in range(min(levels, height(size) - base)):
                siblings = np.arange(first >> level, (last >> level) + 1) ^ 1
                real = siblings < -(-size // (1 << (base + level)))
                at = np.searchsorted(places, position(base + level, siblings[real], size))
                row = [""] * len(siblings)
                for i, j in zip(np.flatnonzero(real), order[at], strict=True):
                    row[i] = digests[j]
                beside.append(row)
            rows = block.filter(pa.array(what == 2)) if carried else None
            wanted = rows.column("at").to_pylist() if carried else range(first, last + 1)
            for start in range(0, len(wanted), 1024):
                some = wanted[start : start + 1024]
                proofs = [[s[(i >> level) - (first >> level)] for level, s in enumerate(beside)] + above for i in some]
                proof = pa.array(proofs, pa.list_(pa.string()))
                if carried:
                    kept = rows.slice(start, len(some)).combine_chunks()
                    yield pa.record_batch([kept.column("row").combine_chunks(), proof], names=["row", "proof"])
                else:
                    n = len(some)
                    yield pa.record_batch([pa.array([tree] * n, pa.int64()), pa.array(some, pa.int64()), proof], names=["tree", "idx", "proof"])

    return prove


def with_proofs(rows: DataFrame, rounds: list[DataFrame], above: DataFrame, levels: int = 12) -> DataFrame:
    """``row, proof``: each of ``rows(tree, idx, row)`` with the siblings of its leaf, from the lowest level up.

    The sibling is ``""`` where a node has none.  ``above`` has ``tree, proof``: how the proof goes on
    behind the root of a tree.  From the last round to the first, a block reads its own run of
    the log and the proof of its top; no node is looked up for more than one block.
    """
    row_type = rows.schema["row"].dataType
    whole = above.select("tree", F.lit(0).cast("bigint").alias("idx"), "proof")
    tops = whole
    for number in reversed(range(len(rounds))):
        base, last = number * levels, number == 0
        empty = {
            "position": F.lit(None).cast("bigint"), "level": F.lit(None).cast("int"), "digest": F.lit(None).cast("string"),
            "size": F.lit(None).cast("bigint"), "above": F.lit(None).cast(_PROOF), "row": F.lit(None).cast(row_type if last else "int"),
        }

        def kind(what: int, frame: DataFrame, key: Column, **given: Column) -> DataFrame:
            columns = {**empty, **given}  # noqa: B023
            return frame.select("tree", key.alias("key"), F.lit(what).alias("what"), F.col("idx").alias("at"), *[v.alias(k) for k, v in columns.items()])

        both = kind(0, tops, F.col("tree") * _BLOCKS + F.col("idx"), above=F.col("proof")).unionByName(
            kind(
                1, rounds[number], _blocks(F.col("level"), base, levels),
                **{c: F.col(c) for c in ("position", "level", "digest", "size")},
            )
        )
        if last:
            both = both.unionByName(kind(2, rows, _blocks(F.lit(0), 0, levels), row=F.col("row")))
        ordered = both.repartition("key").sortWithinPartitions("key", "what", "at")
        if last:
            out = T.StructType([T.StructField("row", row_type), T.StructField("proof", _PROOF)])
            return ordered.mapInArrow(_proving(base, levels, True), out)
        found = written(ordered.mapInArrow(_proving(base, levels, False), "tree bigint, idx bigint, proof array<string>"), "merkle-proofs")
        # Trees that end below this round have had no part in it.
        tops = found.unionByName(tops.join(found.select("tree").distinct(), "tree", "left_anti").select(found.columns))
    raise AssertionError("a log has at least one round")


@dataclass(frozen=True)
class Manifest:
    """Log, roots and leaves of a dataset.

    ``leaves`` has ``group, leaf, row, tree, idx, size``; ``trees`` has ``tree, group, size, subroot``.
    Tree 0 is that of the groups.
    """

    leaves: DataFrame
    trees: DataFrame
    root: str | None
    rounds: list[DataFrame]
    upper: list[DataFrame]
    count: int
    levels: int

    def proofs(self) -> DataFrame:
        """``row, leaf, group, tree, idx, proof, subroot``: a row for each leaf, its siblings up to the root.

        ``proof`` holds the siblings in the tree of the group, then those of its root.
        """
        spark = self.leaves.sparkSession
        if not self.count:
            return self.leaves.select("row", "leaf", "group", "tree", "idx", F.lit(None).cast(_PROOF).alias("proof"), F.lit("").alias("subroot"))
        none = spark.range(1).select(F.lit(0).cast("bigint").alias("tree"), F.array().cast(_PROOF).alias("proof"))
        trees = self.trees.select(F.lit(0).cast("bigint").alias("tree"), (F.col("tree") - 1).alias("idx"), F.struct("tree").alias("row"))
        above = written(
            with_proofs(trees, self.upper, none, self.levels).select("row.tree", "proof"), "merkle-proofs"
        )
        rows = self.leaves.select("tree", "idx", F.struct("row", "leaf", "group", "tree", "idx").alias("row"))
        found = with_proofs(rows, self.rounds, above, self.levels).select("row.*", "proof")
        return found.join(self.trees.select("tree", "subroot"), "tree")

    def folded(self, leaf: str, idx: str = "idx", tree: str = "tree", proof: str = "proof") -> Column:
        """The root that a leaf, its place and its siblings give; equal to ``root`` if nothing was changed."""
        over = height(self.count) if self.count else 0
        within = F.slice(proof, 1, F.size(proof) - over)
        behind = F.slice(proof, F.size(proof) - over + 1, over) if over else F.array().cast(_PROOF)

        def odd(number: Column, level: Column) -> Column:
            return F.call_function("shiftright", number, level).bitwiseAND(1) == 1

        steps = F.concat(
            F.transform(within, lambda s, i: F.struct(s.alias("sibling"), odd(F.col(idx), i).alias("right"))),
            F.transform(behind, lambda s, i: F.struct(s.alias("sibling"), odd(F.col(tree) - 1, i).alias("right"))),
        )
        return F.aggregate(
            steps,
            F.col(leaf),
            lambda node, s: F.sha2(
                F.when(s["right"], F.concat(s["sibling"], node)).otherwise(F.concat(node, s["sibling"])).cast("binary"), 256
            ),
        )


def manifest(rows: DataFrame, group: Column, order: list[Column], leaf: Column, keep: Column, levels: int = 12) -> Manifest:
    """The manifest of ``rows``: ``leaf`` is the digest of a row, ``keep`` a struct that comes back with its proof.

    Groups go by their value, null first, text by its UTF-8 bytes; leaves by ``order``, null
    first, then by digest, which also settles repeated ids.  Repeated rows are a leaf each.
    Null and empty fields have different digests; texts are digested whole.  Other columns of
    ``rows``, whatever their names, have no part.  An empty table has no root and no leaves.

    Leaves are numbered by many tasks however large a group is; no task holds more than a
    block.  A row for each group and the number of groups go through the driver's plans only.
    """
    keys = [f"order_{i}" for i in range(len(order))]
    leaves = rows.select(group.alias("group"), *[c.alias(k) for c, k in zip(order, keys, strict=True)], leaf.alias("leaf"), keep.alias("row"))
    placed = numbered(leaves, ["group"], [*keys, "leaf"], "idx", "size").drop(*keys)
    sizes = placed.groupBy("group").agg(F.max("size").alias("leaves"))
    trees = written(
        numbered(sizes, [], ["group"], "tree", "trees").select((F.col("tree") + 1).alias("tree"), "group", "leaves", "trees"), "merkle-trees"
    )
    known = trees.agg(F.count("*").alias("count"), F.max("leaves").alias("most")).first()
    named = trees.select("tree", F.col("group").alias("__group"))
    placed = placed.join(named, F.col("group").eqNullSafe(F.col("__group"))).drop("__group")
    if not known["count"]:
        return Manifest(placed, trees.withColumn("subroot", F.lit("")), None, [], [], 0, levels)
    rounds = append_log(placed.select("tree", "idx", F.col("leaf").alias("digest"), "size"), known["most"], levels)
    trees = written(
        trees.join(roots(rounds), "tree").select("tree", "group", F.col("leaves").alias("size"), F.col("digest").alias("subroot")), "merkle-trees"
    )
    tops = trees.select(
        F.lit(0).cast("bigint").alias("tree"), (F.col("tree") - 1).alias("idx"), F.col("subroot").alias("digest"),
        F.lit(known["count"]).cast("bigint").alias("size"),
    )
    upper = append_log(tops, known["count"], levels)
    root = roots(upper).first()["digest"]
    return Manifest(placed, trees, root, rounds, upper, known["count"], levels)
