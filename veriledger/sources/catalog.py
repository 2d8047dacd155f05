"""Namespaces and named tables in the session catalog."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.functions.times import GRANULARITIES, bucket

log = logging.getLogger(__name__)

_FIELD, _GRANULARITY = "veriledger.partition.field", "veriledger.partition.granularity"


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> bool:
    """Create a database unless it exists; true if it was there already."""
    if spark.catalog.databaseExists(name):
        log.info("namespace %s already exists", name)
        return True
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    log.info("namespace %s created", name)
    return False


def bucket_column(field: str, granularity: str) -> str:
    """Name of the directory column: ``upload_time`` by HOUR is ``upload_hour``."""
    return f"{field.removesuffix('_time')}_{GRANULARITIES[granularity]}"


def ensure_table(
    spark: SparkSession,
    name: str,
    ddl: str,
    partition_field: str | None = None,
    granularity: str | None = None,
) -> bool:
    """Create a Parquet table unless it exists; true if it was there already.

    It may be partitioned by the HOUR or DAY of a timestamp column.  Any other granularity
    is logged and gives an unpartitioned table.
    """
    if spark.catalog.tableExists(name):
        log.info("table %s already exists", name)
        return True
    clause = ""
    if partition_field and granularity in GRANULARITIES:
        derived = bucket_column(partition_field, granularity)
        ddl = f"{ddl}, {derived} timestamp"
        clause = (
            f" PARTITIONED BY ({derived}) TBLPROPERTIES "
            f"('{_FIELD}'='{partition_field}', '{_GRANULARITY}'='{granularity}')"
        )
    elif partition_field:
        log.info("unknown partitioning %s: table %s is not partitioned", granularity, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{clause}")
    log.info("table %s created", name)
    return False


def _partitioning(spark: SparkSession, name: str) -> tuple[str, str] | None:
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if _FIELD in properties:
        return properties[_FIELD], properties[_GRANULARITY]
    return None


def append_rows(df: DataFrame, name: str) -> None:
    """Append a frame to an existing table, columns matched by name.

    This is a plain append: repeating it adds the rows again.  ``run_tables.write_run``
    is the repeatable way.
    """
    spark = df.sparkSession
    log.info("appending to %s", name)
    try:
        partitioning = _partitioning(spark, name)
        if partitioning:
            field, granularity = partitioning
            derived = bucket_column(field, granularity)
            df = df.withColumn(derived, bucket(F.col(field), granularity))
        df.select(*spark.table(name).columns).write.insertInto(name)
    except Exception as error:
        log.error("append to %s failed: %s", name, error)
        raise
    log.info("appended to %s", name)


def keep_registered(
    spark: SparkSession, name: str, location: str, ddl: str, levels: Sequence[str], run_id: str, attempt: str
) -> None:
    """A catalog table over a run table, with the directories of one more run.

    The table is created on first use.  Only the directories below ``attempt``, the folder of the
    attempt that counts, are listed; those of an earlier attempt are taken out.
    """
    if "." in name:
        ensure_namespace(spark, name.rpartition(".")[0])
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
            f"PARTITIONED BY ({', '.join(levels)}) LOCATION '{location}'"
        )
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(attempt + "/*=*" * (len(levels) - 1))
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    held = spark.sql(f"SHOW PARTITIONS {name} PARTITION ({levels[0]}='{run_id}')").collect()
    for row in held:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_partition(row[0], unescape)})")
    for status in fs.globStatus(top) or []:
        folder = status.getPath().toString()
        parts = "/".join([f"{levels[0]}={run_id}", *folder.split("/")[1 - len(levels) :]])
        spark.sql(
            f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({_partition(parts, unescape)}) LOCATION '{folder}'"
        )
    log.info("run %s registered in %s", run_id, name)


def _partition(path: str, unescape) -> str:
    """The partition of a directory such as ``a=1/b=2`` as SQL."""
    pairs = [part.split("=", 1) for part in path.split("/")]
    return ", ".join(f"{level}='{unescape(value)}'" for level, value in pairs)
