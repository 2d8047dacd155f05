"""Exact duplicates by sorting content.

Sampled splitters range-partition the rows by their normalised bytes, the external sort of
each partition puts equal texts next to each other, and neighbours are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriledger.llm.common import BLANKS, bounded_batches, small_frame, written

_ROWS = (
    "row_id bigint, text_sha256 string, keep_id bigint, group_size bigint, head boolean, "
    "part int, run bigint, first_run boolean, last_run boolean, edge_text string"
)
_ARROW = pa.schema(
    [
        ("row_id", pa.int64()),
        ("text_sha256", pa.string()),
        ("keep_id", pa.int64()),
        ("group_size", pa.int64()),
        ("head", pa.bool_()),
        ("part", pa.int32()),
        ("run", pa.int64()),
        ("first_run", pa.bool_()),
        ("last_run", pa.bool_()),
        ("edge_text", pa.string()),
    ]
)
_FOLLOWING = pa.schema([("part", pa.int32()), ("next_part", pa.int32())])
_FIXES = pa.schema(
    [
        ("part", pa.int32()),
        ("run", pa.int64()),
        ("whole_keep", pa.int64()),
        ("whole_size", pa.int64()),
        ("whole_head", pa.bool_()),
    ]
)


def normalised(text: str | Column) -> Column:
    """Every stretch of blanks as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), BLANKS, " ")


class _Runs:
    """Runs of equal neighbours in one sorted partition, fed batch by batch.

    Holds the ids of the run that is still open and its text once.
    """

    def __init__(self, part: int):
        self.part = part
        self.number = 0
        self.ids: list[pa.Array] = []
        self.text = self.digest = None

    def feed(self, ids: pa.Array, digests: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        if not len(ids):
            return
        # Digests first: full texts are compared only where the digests agree.
        same = pc.and_(
            pc.equal(digests.slice(1), digests.slice(0, len(digests) - 1)),
            pc.equal(texts.slice(1), texts.slice(0, len(texts) - 1)),
        )
        starts = 1 + np.flatnonzero(~same.to_numpy(zero_copy_only=False))
        if self.ids and not (digests[0].as_py() == self.digest and texts[0].as_py() == self.text):
            yield self.close(last=False)
        bounds = [0, *starts.tolist(), len(ids)]
        rest = bounds[-2]
        if len(bounds) > 2:
            # The open run ends within this batch; then come whole runs; the last stays open.
            self.open(ids.slice(0, bounds[1]), digests[0], texts[0])
            yield self.close(last=False)
            if len(bounds) > 3:
                yield self.inner(ids, digests, np.array(bounds[1:-1]))
        self.open(ids.slice(rest), digests[rest], texts[rest])

    def open(self, ids: pa.Array, digest, text) -> None:
        if not self.ids:
            self.digest, self.text = digest.as_py(), text.as_py()
        self.ids.append(ids)

    def inner(self, ids: pa.Array, digests: pa.Array, bounds: np.ndarray) -> pa.RecordBatch:
        """Whole runs strictly inside the partition, so touching neither of its ends."""
        sizes = np.diff(bounds)
        first, count = int(bounds[0]), int(sizes.sum())
        runs = np.repeat(np.arange(len(sizes)), sizes)
        at = bounds[:-1] - first
        part_ids = ids.slice(first, count)
        head = np.zeros(count, dtype=bool)
        head[at] = True
        batch = self._batch(
            part_ids, digests.slice(first, count), part_ids.take(pa.array(at[runs])),
            sizes[runs], head, self.number + runs, False, False, None,
        )
        self.number += len(sizes)
        return batch

    def close(self, last: bool) -> pa.RecordBatch:
        """The open run; it may touch an end of the partition and then carries its text."""
        ids = pa.concat_arrays(self.ids)
        count, first = len(ids), self.number == 0
        head = np.zeros(count, dtype=bool)
        head[0] = True
        batch = self._batch(
            ids, pa.array([self.digest] * count, pa.string()), pa.array([ids[0].as_py()] * count, pa.int64()),
            np.full(count, count), head, np.full(count, self.number), first, last,
            self.text if first or last else None,
        )
        self.number += 1
        self.ids = []
        return batch

    def _batch(self, ids, digests, keep, sizes, head, runs, first, last, text) -> pa.RecordBatch:
        n = len(ids)
        return pa.record_batch(
            [
                ids, digests, keep, pa.array(sizes, pa.int64()), pa.array(head),
                pa.array(np.full(n, self.part, dtype=np.int32)), pa.array(runs, pa.int64()),
                pa.array(np.full(n, first)), pa.array(np.full(n, last)),
                pa.array([text] + [None] * (n - 1), pa.string()),
            ],
            schema=_ARROW,
        )


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = _Runs(TaskContext.get().partitionId())
    for batch in batches:
        yield from runs.feed(batch.column("row_id"), batch.column("digest"), batch.column("norm"))
    if runs.ids:
        yield runs.close(last=True)


def _stitched(runs: DataFrame) -> DataFrame:
    """What the runs at partition ends become when equal runs of neighbouring partitions join.

    At most two rows per partition.  The texts are compared by a join between neighbours;
    only the flags of the outcome come to the driver, which follows the chains.
    """
    spark = runs.sparkSession
    ends = runs.filter("head and (first_run or last_run)")
    parts = sorted(r.part for r in ends.select("part").distinct().collect())
    following = small_frame(spark, list(zip(parts, parts[1:], strict=False)), _FOLLOWING)
    joined = (
        ends.filter("last_run").select("part", "edge_text")
        .join(F.broadcast(following), "part")
        .join(
            ends.filter("first_run").select(F.col("part").alias("next_part"), F.col("edge_text").alias("next_text")),
            "next_part",
        )
        .filter("edge_text = next_text")
        .select("part", "next_part")
    )
    continues = {r.part: r.next_part for r in joined.collect()}
    firsts, lasts = {}, {}
    for r in ends.select("part", "run", "keep_id", "group_size", "first_run", "last_run").collect():
        if r.first_run:
            firsts[r.part] = r
        if r.last_run:
            lasts[r.part] = r
    fixes, inside = [], set(continues.values())
    for part in parts:
        if part not in continues or (part in inside and lasts[part].first_run):
            continue  # no chain begins at the last run of this partition
        chain = [lasts[part]]
        while chain[-1].part in continues:
            chain.append(firsts[continues[chain[-1].part]])
            if not chain[-1].last_run:
                break
        total = sum(r.group_size for r in chain)
        fixes += [(r.part, r.run, chain[0].keep_id, total, i == 0) for i, r in enumerate(chain)]
    return small_frame(spark, fixes, _FIXES)


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after ``normalised``.  Rows are dealt out by the first
    ``prefix`` characters, then by a digest that stands for the remaining bytes (so the
    sampled splitters stay small however long the texts are), then by id, which splits a
    group of copies of any size over tasks.  Each task compares full neighbouring texts and
    holds one text and the ids of one run.  Runs that meet at partition ends are compared
    and joined; that is two rows per partition.

    Null texts count as empty; empty texts form one group.  A null id sorts last and is the
    kept id only of a group without any other.  Of fully repeated rows the first stays.
    Other columns are ignored, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("row_id"), normalised(text_col).alias("norm"))
    rows = rows.withColumn("digest", F.sha2(F.col("norm"), 256))
    order = [F.substring("norm", 1, prefix), F.col("digest"), F.col("row_id").asc_nulls_last()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = written(ordered.mapInArrow(_compare_neighbours, _ROWS), "content-sort")
    whole = _stitched(runs)
    return (
        runs.join(F.broadcast(whole), ["part", "run"], "left")
        .select(
            F.col("row_id").alias("doc_id"),
            F.when(F.col("whole_size").isNull(), F.col("keep_id")).otherwise(F.col("whole_keep")).alias("keep_id"),
            F.coalesce("whole_size", "group_size").alias("group_size"),
            (F.col("head") & F.coalesce("whole_head", F.lit(True))).alias("kept"),
            "text_sha256",
        )
    )
