"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.session import shared_folder

# The white space of the text contracts, a blank and U+0009 to U+000D.
BLANKS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; the fold of a row."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Let the batches that tasks exchange with Python hold few rows: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def release() -> None:
    """Give memory that a finished task has freed back to the system: workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# What this worker keeps from task to task.
_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept for later tasks of the same worker; only one thing is kept at a time."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Drop what another operator's tasks have kept: its memory would be held besides that of the task in hand."""
    if _KEPT:
        _KEPT.clear()
        release()


def small_frame(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """A few rows of the driver as a frame; unlike a list, an Arrow table takes no Python workers of its own."""
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))


def written(frame: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """``frame`` written to the shared folder and read back.

    Cuts the lineage: what follows survives lost executors without repeating the work, and
    several readers share it.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.option("compression", compression).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _bound(n: int, size: int) -> int:
    """A 64-bit hash below which more than ``size`` of ``n`` rows are to be expected; the largest if few are more."""
    most = (1 << 63) - 1
    return most if n <= 4 * size else min(most, int(-(1 << 63) + (2 * size + 1000) / n * (1 << 64)))


def smallest(rows: DataFrame, code: Column, then: list[str], n: int, size: int) -> DataFrame:
    """The ``size`` rows of smallest 64-bit hash ``code``, out of ``n``.

    Only hashes below a threshold that leaves some more rows than wanted are sorted at all, so
    the task that merges them does not receive ``size`` rows from each of all others.  If
    the threshold has left too few, as with many equal hashes, all rows are sorted.
    """
    close = rows.filter(code <= _bound(n, size))
    few = close if n <= 4 * size or close.count() >= size else rows
    return few.orderBy(code, *then).limit(size)


def near_smallest(rows: DataFrame, kind: str, code: Column, size: int, first: Column | None = None) -> DataFrame:
    """``rows`` without most of those that are not among the ``size`` of smallest hash of their kind.

    ``kind`` is a column of few values.  Rows that satisfy ``first`` come before all others of
    their kind.  What stays is enough to rank: a small multiple of ``size`` for each kind,
    or the whole kind where it is small or its hashes are too unevenly spread.
    """
    early = F.lit(True) if first is None else first
    counts = {r[kind]: r["n"] for r in rows.groupBy(kind).agg(F.count_if(early).alias("n")).collect()}
    bounds = {k: _bound(n, size) for k, n in counts.items() if n > 4 * size}
    if not bounds:
        return rows
    close = {k: early & (code <= bound) for k, bound in bounds.items()}
    left = rows.agg(*[F.count_if((F.col(kind) == k) & c).alias(f"k{i}") for i, (k, c) in enumerate(close.items())]).first()
    keep = F.lit(True)
    for i, (k, c) in enumerate(close.items()):
        if left[i] >= size:
            keep &= (F.col(kind) != k) | c
    return rows.filter(keep)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The groups of a stream sorted by ``key``, one at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(1 + np.flatnonzero(keys[1:] != keys[:-1])).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if held and held[-1].column(key)[0].as_py() != keys[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)
