"""JSON-lines feeds read under a declared schema."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.operators.cleaning import mark_malformed
from veriledger.schemas import CUSTOMER_DDL, TRANSACTION_DDL, retyped, with_raw_line

log = logging.getLogger(__name__)


def feed_pattern(path: str, prefix: bool = False) -> str:
    """What a feed path stands for: a directory, or with ``prefix`` all names that begin so.

    Reading and deleting share this rule.
    """
    return f"{path}*" if prefix and not path.endswith("/") else path


def feed_files(spark: SparkSession, path: str, prefix: bool = False) -> DataFrame:
    """``path, length, modified`` of the files of a feed as they are now; their content is not read."""
    try:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        files = reader.load(feed_pattern(path, prefix))
        return files.select("path", "length", F.col("modificationTime").alias("modified"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")


def _literal(path: str) -> str:
    """A path as a pattern that matches just it."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_feed(spark: SparkSession, path: str | Sequence[str], ddl: str, prefix: bool = False) -> DataFrame:
    """All JSON lines below a directory, at any depth, or those of a list of files.

    With ``prefix`` the path is a name prefix instead: ``.../customers`` then also takes
    in ``.../customers_2``.  Spark lists the files itself, in parallel when there are
    many.  A path without files gives an empty frame of the same schema and a warning.
    """
    if not isinstance(path, str):
        if not path:
            return spark.createDataFrame([], ddl)
        return spark.read.schema(ddl).json([_literal(p) for p in path])
    try:
        reader = spark.read.schema(ddl).option("recursiveFileLookup", "true")
        return reader.json(feed_pattern(path, prefix))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            log.error("cannot read feed %s: %s", path, error)
            raise
        log.warning("no files found in %s", path)
        return spark.createDataFrame([], ddl)


def read_customers(spark: SparkSession, path: str, prefix: bool = False) -> DataFrame:
    return read_feed(spark, path, CUSTOMER_DDL, prefix)


def transaction_ddl(double_amounts: bool = False) -> str:
    """The declared feed schema, in which amounts are floats, or the same with doubles.

    A float amount keeps about seven digits: 10.1 becomes 10.100000381469727 once widened.
    """
    doubles = {"amount": "double", "total_amount": "double"}
    return retyped(TRANSACTION_DDL, doubles) if double_amounts else TRANSACTION_DDL


def read_transactions(
    spark: SparkSession, path: str, prefix: bool = False, double_amounts: bool = False
) -> DataFrame:
    return read_feed(spark, path, transaction_ddl(double_amounts), prefix)


def read_customers_with_raw(spark: SparkSession, path: str | Sequence[str], prefix: bool = False) -> DataFrame:
    return mark_malformed(read_feed(spark, path, with_raw_line(CUSTOMER_DDL), prefix))


def read_transactions_with_raw(
    spark: SparkSession, path: str | Sequence[str], prefix: bool = False, double_amounts: bool = False
) -> DataFrame:
    """Transactions plus the raw text of lines that are no JSON at all."""
    ddl = with_raw_line(transaction_ddl(double_amounts))
    return mark_malformed(read_feed(spark, path, ddl, prefix))


def read_currencies(spark: SparkSession, source: str, table: bool | None = None) -> DataFrame:
    """The valid codes from a table or a Parquet path; unless said which, a slash makes a path."""
    if table is None:
        table = "/" not in source
    rows = spark.read.table(source) if table else spark.read.parquet(source)
    return rows.select("currency_code")


def write_feed(records: DataFrame, path: str, mode: str = "append", compressed: bool = False) -> None:
    """Records as JSON lines, the landing format of both feeds.

    NULL fields are written out, so every record carries all its keys.  ``compressed`` files are
    read like others, take a small part of the room, and are read by one task each.
    """
    codec = "gzip" if compressed else "none"
    records.write.mode(mode).option("ignoreNullFields", "false").option("compression", codec).json(path)

