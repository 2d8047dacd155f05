"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Time is counted in slots of one block of rows.  With a share of s out of W, block i of a
source (from 0) is released at slot floor(i * W / s) and due by slot ceil((i + 1) * W / s).
Each slot goes to the released block that is due first.  At every slot each source is then
less than one block away from its target.
"""

from __future__ import annotations

import uuid
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriledger.llm.common import written

# Rows of a source are dealt over this many parts of equal chance before they are numbered.
PARTS = 4096
# Columns in use on the way.
_OWN = {"offset", "share", "turns", "sizes"}
# The schedule repeats after as many slots as all shares together, so shares have a bound.
MOST_SLOTS = 10_000


def reduced(shares: dict[str, int], rest: int) -> tuple[list[str], list[int]]:
    """Names and shares in lowest terms; the last share, without a name, is that of all other sources."""
    names, values = sorted(shares), [shares[n] for n in sorted(shares)] + [rest]
    if any(v < 1 or v != int(v) for v in values):
        raise ValueError("shares are whole numbers from 1 on")
    divisor = gcd(*values)
    values = [v // divisor for v in values]
    if sum(values) > MOST_SLOTS:
        raise ValueError(f"the shares add up to more than {MOST_SLOTS}")
    return names, values


def pattern(shares: list[int]) -> Column:
    """One period of the schedule: an array with the number of the source of each slot.

    Earliest deadline first over the blocks released so far; the lower number wins a tie.
    """
    total = sum(shares)
    share = F.array(*[F.lit(s) for s in shares])

    def at(slot: Column, done: Column) -> Column:
        """The source whose next block is due first among those released."""
        due = F.transform(
            done,
            lambda i, k: F.when(
                F.floor(i * total / F.get(share, k)) <= slot,
                F.struct(F.ceil((i + 1) * total / F.get(share, k)).alias("due"), k.alias("k")),
            ),
        )
        return F.array_min(due)["k"]

    def step(state: Column, slot: Column) -> Column:
        chosen = at(slot, state["done"])
        # A let: the chosen source as an array of one, so that it is worked out once.
        return F.transform(
            F.array(chosen),
            lambda c: F.struct(
                F.transform(state["done"], lambda i, k: F.when(k == c, i + 1).otherwise(i)).alias("done"),
                F.concat(state["slots"], F.array(c)).alias("slots"),
            ),
        )[0]

    start = F.struct(
        F.array(*[F.lit(0) for _ in shares]).alias("done"), F.slice(F.array(F.lit(0)), 1, 0).alias("slots")
    )
    return F.aggregate(F.sequence(F.lit(0), F.lit(total - 1)), start, step, lambda s: s["slots"])


def mixed(
    rows: DataFrame, shares: dict[str, int], rest: int = 1, block_rows: int = 64, id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """``rows`` with ``mix_block, mix_slot, mix_position``: where each row stands in the mixture.

    ``shares`` are whole numbers: the target weights of the named sources; all other sources
    and rows without one are mixed as one, with the share ``rest``.  Every row gets a place.
    The rows of a source come in blocks of ``block_rows``, in an order shuffled by the md5
    of their id.  Until the first source runs out, after each slot each source has had its
    weight of all blocks so far, give or take less than one block.  From then on the slots
    of that source stay empty, so the others keep their proportions.  ``mix_position``
    counts rows from 0 without gaps.

    Numbering a source does not gather it: rows are numbered within 4096 parts of a source
    and moved up by the counts of the parts before.  The schedule is an expression over the
    shares, whose sum is bounded.  Rows with the same id stand next to each other in an
    order given by their other columns; a null id comes first in its part.  An empty table
    gives an empty one.  Input columns whose names begin with ``mix_`` come back as
    ``kept_`` and their place, and underscores if there is such a column too.  Texts of any
    length are carried, not looked at.
    """
    if any(c.lower().startswith("mix_") or c.lower() in _OWN for c in rows.columns):
        clash = {c: f"__{uuid.uuid4().hex}" for c in rows.columns}
        inner = mixed(rows.withColumnsRenamed(clash), shares, rest, block_rows, clash[id_col], clash[source_col])
        taken, back = {c.lower() for c in rows.columns}, {}
        for i, (name, aside) in enumerate(clash.items()):
            if name.lower().startswith("mix_"):
                name = f"kept_{i}"
                while name in taken:
                    name += "_"
            back[aside] = name
        return inner.withColumnsRenamed(back)
    names, values = reduced(shares, rest)
    spark, total = rows.sparkSession, sum(values)
    number = F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(n) for n in names]).cast("array<string>"), F.col(source_col)), F.lit(0)),
        F.lit(len(names) + 1),
    ).cast("int")
    part = F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 3), 16, 10).cast("int")
    placed = rows.withColumn("mix_source", number - 1).withColumn("mix_part", part)

    # A row for each part of each source: how many rows come before it, and in all.
    counts = placed.groupBy("mix_source", "mix_part").agg(F.count("*").alias("n"))
    before = W.partitionBy("mix_source").orderBy("mix_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = written(counts.select("mix_source", "mix_part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "mix-offsets")
    sizes = offsets.groupBy("mix_source").agg(F.sum("n").alias("size"))

    # A row for each share: its slots in a period, each with the slots that every source had
    # before, and the sizes and shares of all.
    period = spark.range(1).select(pattern(values).alias("period"))
    every = F.sequence(F.lit(0), F.lit(len(values) - 1))
    slots = period.select(F.posexplode("period").alias("slot", "mix_source"), "period").withColumn(
        "earlier",
        F.transform(every, lambda k: F.size(F.filter(F.slice("period", F.lit(1), F.col("slot")), lambda s: s == k))),
    )
    turns = slots.groupBy("mix_source").agg(F.sort_array(F.collect_list(F.struct("slot", "earlier"))).alias("turns"))
    all_sizes = sizes.agg(F.map_from_entries(F.collect_list(F.struct("mix_source", "size"))).alias("known")).select(
        F.transform(every, lambda k: F.coalesce(F.try_element_at("known", k), F.lit(0).cast("bigint"))).alias("sizes")
    )
    share = F.array(*[F.lit(v) for v in values])
    plan = (
        turns.join(F.broadcast(all_sizes.withColumn("mix_source", F.explode(every))), "mix_source")
        .withColumn("share", F.get(share, F.col("mix_source")))
    )

    others = F.xxhash64(*[c for c in rows.columns if not _is_map(rows, c)])
    within = W.partitionBy("mix_source", "mix_part").orderBy(id_col, others)
    numbered = (
        placed.withColumn("mix_place", F.row_number().over(within) - 1)
        # As many rows as shares times parts.
        .join(F.broadcast(offsets.select("mix_source", "mix_part", "offset")), ["mix_source", "mix_part"])
        .withColumn("mix_place", F.col("mix_place") + F.col("offset"))
        .withColumn("mix_block", F.floor(F.col("mix_place") / block_rows))
        .join(F.broadcast(plan), "mix_source")
        .withColumn("mix_cycle", F.floor(F.col("mix_block") / F.col("share")))
        .withColumn("mix_turn", F.get("turns", (F.col("mix_block") % F.col("share")).cast("int")))
    )
    earlier = F.zip_with(
        F.zip_with("mix_turn.earlier", share, lambda e, s: block_rows * (F.col("mix_cycle") * s + e)),
        "sizes",
        lambda slots_before, size: F.least(size, slots_before),
    )
    start = F.aggregate(earlier, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return numbered.select(
        *rows.columns, "mix_block", (F.col("mix_cycle") * total + F.col("mix_turn.slot")).alias("mix_slot"),
        (start + F.col("mix_place") % block_rows).alias("mix_position"),
    )


def _is_map(rows: DataFrame, column: str) -> bool:
    return "map<" in dict(rows.dtypes)[column]
