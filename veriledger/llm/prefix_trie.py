"""The trie of the beginnings that conversations share, by digests of blocks of turns.

A conversation is cut into blocks of a fixed number of turns.  Each block has the digest of
everything before it, so conversations with the same beginning form groups block by block.
Where all members of a group go on with the same block, its nodes are read off one of them;
turns are told apart one by one only in blocks where members of a group diverge.

What is below a node is summed within its block, and from block to block by pointers that
double their reach each round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.llm.common import bounded_batches, written

START = b"\0" * 16  # the node of no turns
_SPINE = "conv_id bigint, block int, start binary, path array<binary>, sizes array<bigint>, ends boolean"
_SPINE_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("block", pa.int32()), ("start", pa.binary()), ("path", pa.list_(pa.binary())),
        ("sizes", pa.list_(pa.int64())), ("ends", pa.bool_()),
    ]
)
_ENDS = "node binary, ends_sha256 string"
_ENDS_ARROW = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _turn(before: bytes, role: str, text: bytes) -> bytes:
    """The digest of a beginning, from that of all but its last turn."""
    name = role.encode()
    return hashlib.blake2b(before + len(name).to_bytes(8) + name + text, digest_size=16).digest()


class _Spine:
    """The blocks of the conversations of a stream, one conversation open at a time."""

    def __init__(self, per_block: int):
        self.per_block, self.rows = per_block, []

    def open(self, conv: int) -> None:
        self.conv, self.block, self.start, self.path, self.sizes = conv, 0, START, [], []

    def add(self, role: str, text: bytes, size: int) -> None:
        if len(self.path) == self.per_block:  # it goes on behind a full block
            self._write(False)
            self.block, self.start, self.path, self.sizes = self.block + 1, self.path[-1], [], []
        self.path.append(_turn(self.path[-1] if self.path else self.start, role, text))
        self.sizes.append(size)

    def close(self) -> None:
        self._write(True)

    def _write(self, ends: bool) -> None:
        self.rows.append((self.conv, self.block, self.start, self.path, self.sizes, ends))

    def take(self) -> pa.RecordBatch | None:
        rows, self.rows = self.rows, []
        if rows:
            columns = zip(zip(*rows, strict=True), _SPINE_ARROW, strict=True)
            return pa.record_batch([pa.array(c, f.type) for c, f in columns], schema=_SPINE_ARROW)
        return None


def _spines(per_block: int):
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Turns come by family, its first conversation before the others."""
        spine = _Spine(per_block)
        family = conv = None
        shared: list[tuple[str, bytes, int]] = []  # the first turns of the family's first conversation
        for batch in batches:
            for base, this, lent, role, text, size in zip(
                *[batch.column(c).to_pylist() for c in ("base", "conv_id", "lent", "role", "text", "size")], strict=True
            ):
                if this != conv:
                    if conv is not None:
                        spine.close()
                    if base != family:
                        family, shared = base, []
                    conv, own = this, 0
                    spine.open(this)
                    for turn in shared[:lent] if this != base else ():
                        spine.add(*turn)
                own += 1
                if this == base:
                    if own <= 8:
                        shared.append((role, text, size))
                    spine.add(role, text, size)
                elif own > lent:
                    spine.add(role, text, size)
            if (found := spine.take()) is not None:
                yield found
        if conv is not None:
            spine.close()
            yield spine.take()

    return spell


def _rebuilt(conversations: DataFrame, per_block: int) -> DataFrame:
    """The blocks of the rebuilt conversations."""
    conv = F.col("conv_id").cast("bigint")
    text = F.coalesce("text", F.lit(""))
    turns = conversations.filter(conv.isNotNull()).select(
        (conv - conv % 5).alias("base"), conv.alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int").alias("lent"),
        F.coalesce("role", F.lit("")).alias("role"), F.unhex(F.sha2(text, 256)).alias("text"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    ordered = turns.repartition("base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "role", "text"
    )
    return written(ordered.mapInArrow(_spines(per_block), _SPINE), "trie-spines")


def _ends(spines: DataFrame) -> DataFrame:
    """``node, ends_sha256``: the ids of the conversations that end at a node, digested in order as a stream."""
    last = F.coalesce(F.try_element_at("path", F.lit(-1)), "start")
    ids = spines.filter("ends").select(last.alias("node"), "conv_id")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = state = None
        for batch in batches:
            found = []
            for this, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if this == node:
                    state.update(f",{conv}".encode())
                    continue
                if node is not None:
                    found.append((node, state.hexdigest()))
                node, state = this, hashlib.sha256(str(conv).encode())
            if found:
                yield pa.record_batch([pa.array(c) for c in zip(*found, strict=True)], schema=_ENDS_ARROW)
        if node is not None:
            yield pa.record_batch([pa.array([node]), pa.array([state.hexdigest()])], schema=_ENDS_ARROW)

    return ids.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(digest, _ENDS)


def _under(blocks: DataFrame, deepest: int) -> DataFrame:
    """``start, leaves, saved`` summed over each group of blocks and all that hang below it.

    ``blocks`` has ``start, up, leaves, saved``; each round adds the sums of the groups 2^k blocks below.
    """
    for _ in range(deepest.bit_length()):
        below = blocks.filter("up is not null").groupBy(F.col("up").alias("start")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        higher = blocks.select(F.col("start").alias("up"), F.col("up").alias("further"))
        blocks = written(
            blocks.join(below, "start", "left").join(higher, "up", "left").select(
                "start", F.col("further").alias("up"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "trie-sums",
        )
    return blocks.select("start", "leaves", "saved")


def prefix_trie(conversations: DataFrame, per_block: int = 8) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations.

    ``node, parent`` (digests), ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.  ``conversations`` has ``conv_id, turn, role, text``: conversation c
    begins with the first crc32(c) % 9 turns of conversation c - c % 5 (none if there is no such one),
    in the place of its own first turns.

    Turns go by ``turn``, null first, then by role and the SHA-256 of the text, which also
    settles ties; repeated rows are turns each.  Null roles and texts are empty.  Rows
    without an id are left out, other columns have no part, whatever their names.  Texts are
    digested whole and not shuffled.  An empty table has no node, not even the root.

    The turns of a conversation are digested in order, so they stream through one task, as
    digests, in bounded memory; so do the ids of the conversations that end at a node.
    Everything else is aggregated before it is shuffled.
    """
    bounded_batches(conversations.sparkSession, rows=10_000)
    spines = _rebuilt(conversations, per_block)
    # Blocks by their content: the beginnings they follow and make.
    kinds = written(
        spines.filter(F.size("path") > 0).groupBy("block", "start", "path", "sizes").agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")
        ),
        "trie-blocks",
    )
    ways = kinds.groupBy("start").agg(F.count("*").alias("ways"))
    kinds = kinds.join(ways, "start")
    last = F.element_at("path", -1)
    straight = kinds.filter("ways = 1").select(
        "block", "start", "path", "sizes", "n_convs", "conv_id", last.alias("node"), (F.size("path") == per_block).alias("full")
    )
    # Turn by turn only where the members of a group diverge.
    place = F.posexplode("path").alias("at", "node")
    turns = kinds.filter("ways > 1").select("block", "start", "path", "sizes", "n_convs", "conv_id", place)
    forked = written(
        turns.groupBy(
            "block", "start", "at", "node", F.slice("path", F.lit(1), F.col("at")).alias("above"), F.get("sizes", "at").alias("size")
        ).agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")),
        "trie-forks",
    )

    # Children: within a block from its nodes, behind it from the first nodes of the group there.
    inner = forked.filter("at > 0").groupBy(F.element_at("above", -1).alias("node")).agg(F.count("*").alias("inner"))
    following = forked.filter("at = 0").groupBy("start").agg(F.count("*").alias("outer")).unionByName(
        straight.select("start", F.lit(1).cast("bigint").alias("outer"))
    ).withColumnRenamed("start", "node")
    forked = forked.join(inner, "node", "left").join(following, "node", "left")
    forked = forked.withColumn("n_children", F.coalesce("inner", "outer", F.lit(0)))
    straight = straight.join(following, "node", "left").withColumn("behind", F.coalesce("outer", F.lit(0)))
    saved = (F.col("n_convs") - 1) * F.col("size")
    forked = written(
        forked.select(
            "block", "start", "at", "node", "above", "n_convs", "conv_id", "n_children",
            (F.col("n_children") == 0).cast("bigint").alias("leaf"), saved.alias("own"), (F.col("at") == per_block - 1).alias("full"),
        ),
        "trie-forks",
    )
    straight = written(
        straight.select(
            "block", "start", "path", "node", "n_convs", "conv_id", "behind", "full", (F.col("behind") == 0).cast("bigint").alias("leaf"),
            F.transform("sizes", lambda s: s * (F.col("n_convs") - 1)).alias("owns"),
        ),
        "trie-straight",
    )

    # Sums of what is below, from block to block.
    whole = F.aggregate("owns", F.lit(0).cast("bigint"), lambda a, b: a + b)
    local = forked.groupBy("start").agg(F.sum("leaf").alias("leaves"), F.sum("own").alias("saved")).unionByName(
        straight.select("start", F.col("leaf").alias("leaves"), whole.alias("saved"))
    )
    ends = forked.filter("full").select("node", "start", "conv_id").unionByName(
        straight.filter("full").select("node", "start", "conv_id")
    )
    pointers = ends.select(F.col("node").alias("start"), F.col("start").alias("up"))
    deepest = kinds.agg(F.max("block")).first()[0] or 0
    under = written(_under(written(local.join(pointers, "start", "left"), "trie-sums"), deepest), "trie-sums")
    behind = under.select(F.col("start").alias("node"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))

    # Within blocks: each node counts for itself and for those above it.
    more = [F.coalesce("more_leaves", F.lit(0)), F.coalesce("more_saved", F.lit(0))]
    carried = forked.join(behind, "node", "left").select(
        F.explode(F.array_append("above", F.col("node"))).alias("node"),
        (F.col("leaf") + more[0]).alias("leaves"), (F.col("own") + more[1]).alias("saved"),
    )
    sums = carried.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parent = F.coalesce(F.try_element_at("above", F.lit(-1)), "start")
    of_forks = forked.join(sums, "node").select(
        "node", parent.alias("parent"), "conv_id", (F.col("block") * per_block + F.col("at") + 1).alias("depth"),
        F.lit(None).cast("bigint").alias("known_parent"), "n_convs", "n_children", "n_leaves", "saved_tokens",
    )
    index = F.col("at")
    rest = F.aggregate(F.slice("owns", index + 1, F.size("owns")), F.col("below_saved"), lambda a, b: a + b)
    of_straight = (
        straight.join(behind, "node", "left")
        .withColumns({"below_leaves": F.col("leaf") + more[0], "below_saved": more[1]})
        .drop("node").select("*", F.posexplode("path").alias("at", "node"))
        .select(
            "node", F.coalesce(F.get("path", index - 1), "start").alias("parent"), "conv_id",
            (F.col("block") * per_block + index + 1).alias("depth"),
            F.when(index > 0, F.col("conv_id")).alias("known_parent"), "n_convs",
            F.when(index + 1 < F.size("path"), F.lit(1)).otherwise(F.col("behind")).cast("bigint").alias("n_children"),
            F.col("below_leaves").alias("n_leaves"), rest.alias("saved_tokens"),
        )
    )

    # The root: one row, put together from what is known of it.
    nothing = {c: F.lit(None).cast("bigint") for c in ("n_convs", "conv_id", "outer", "more_leaves", "more_saved")}

    def of_root(frame: DataFrame) -> DataFrame:
        return frame.select(*[F.col(c) if c in frame.columns else v.alias(c) for c, v in nothing.items()])

    everyone = spines.filter("block = 0").groupBy().agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    known = of_root(everyone).unionByName(of_root(following.filter(F.col("node") == START))).unionByName(
        of_root(behind.filter(F.col("node") == START))
    )
    top = known.groupBy().agg(*[F.max(c).alias(c) for c in nothing]).filter("n_convs > 0").withColumn("node", F.lit(START))
    root = top.select(
        "node", F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(0).alias("depth"),
        F.lit(None).cast("bigint").alias("known_parent"), "n_convs", F.coalesce("outer", F.lit(0)).alias("n_children"),
        F.coalesce("more_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("more_saved", F.lit(0)).alias("saved_tokens"),
    )
    parents = (
        forked.select("node", "conv_id").unionByName(straight.filter("full").select("node", "conv_id"))
        .unionByName(top.select("node", "conv_id"))
        .select(F.col("node").alias("parent"), F.col("conv_id").alias("found_parent"))
    )
    ask = of_forks.unionByName(of_straight.filter("known_parent is null")).unionByName(root)
    nodes = ask.join(parents, "parent", "left").withColumn("parent_conv_id", F.col("found_parent")).unionByName(
        of_straight.filter("known_parent is not null").withColumns(
            {"found_parent": F.col("known_parent"), "parent_conv_id": F.col("known_parent")}
        )
    )
    return nodes.join(_ends(spines), "node", "left").select(
        "node", "parent", "conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
