"""Removal of processed inputs."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from veriledger.sources.feeds import feed_files, feed_pattern
from veriledger.sources.run_tables import consumed_files

log = logging.getLogger(__name__)


def delete_feed(spark: SparkSession, path: str, prefix: bool = False) -> int:
    """Delete a processed feed; returns the entries removed.

    The path means what it means to the reader: a directory, or with ``prefix`` everything
    whose name begins so.  Only the entries directly matching are listed; directories go as
    a whole.  Files that land while a run is working would go too: ``delete_consumed`` takes
    only those that finished runs have read.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(feed_pattern(path, prefix))
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = 0
    for status in fs.globStatus(pattern) or []:
        removed += bool(fs.delete(status.getPath(), True))
    log.info("deleted %d entries of %s", removed, path)
    return removed


def delete_consumed(spark: SparkSession, path: str, table: str, prefix: bool = False) -> int:
    """Delete the files of a feed that finished runs of ``table`` have read; returns how many.

    A file that landed later, or was written anew after it had been read, stays.
    """
    files = feed_files(spark, path, prefix)
    read = files.join(consumed_files(spark, table), files.columns, "left_semi")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    removed = 0
    for row in read.select("path").toLocalIterator():
        where = hadoop.Path(row.path)
        fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        removed += bool(fs.delete(where, False))
    log.info("deleted %d files of %s that %s has read", removed, path, table)
    return removed


def delete_prefix(spark: SparkSession, prefix: str) -> int:
    """Delete everything whose path starts with ``prefix``."""
    return delete_feed(spark, prefix, prefix=True)
