"""Tables written run by run, so that repeating a run replaces just that run.

Layout: ``<table>/run_id=<run>/attempt=<attempt>/<verdict=…/upload_hour=…>/part-*.parquet``
and, for each run, one small file ``<table>/_manifests/run-<run>.json``.

Every attempt of a run writes a folder of its own.  The run's manifest names the attempt
that counts, and is put in place by one rename: a reader sees the rows of the old attempt or
those of the new one, and of two writers one wins.  What no manifest names is never read.
Manifests are read as one table, which tells the attempts of a time range without listing
or opening any others.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from itertools import count
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.functions.times import instant, lookback_start, start_of_hour
from veriledger.operators.clustering import searchable_times

# Spark's readers skip names that begin with an underscore.
_MANIFESTS, _CONSUMED = "_manifests", "_consumed"
MANIFEST_DDL = (
    "run_id string, attempt string, owner string, source string, written bigint, "
    "from_time timestamp, to_time timestamp, counts map<string,bigint>, merged_into string"
)
# A count of runs that are kept after they were merged: their rows may have to be taken away again.
GENERATION = "generation"
FILES_DDL = "path string, length bigint, modified timestamp"

Attempts = Sequence[tuple[str, str]]


class RunTaken(RuntimeError):
    """The run was written by somebody else and is not replaced."""


def run_path(table: str, run_id: str) -> str:
    return f"{table.rstrip('/')}/run_id={run_id}"


def attempt_path(table: str, run_id: str, attempt: str) -> str:
    return f"{run_path(table, run_id)}/attempt={attempt}"


def _manifest_path(table: str, run_id: str) -> str:
    return f"{table.rstrip('/')}/{_MANIFESTS}/run-{quote(run_id, safe='')}.json"


def _hadoop(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    where, fs = _hadoop(spark, path)
    return fs.exists(where)


def _is(error: Py4JJavaError, *names: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in names


def put_file(spark: SparkSession, path: str, text: str, replace: bool) -> bool:
    """Put a small file in place by a rename; false if there is one and it is not to be replaced."""
    jvm = spark.sparkContext._jvm
    where, fs = _hadoop(spark, path)
    folder, _, name = path.rpartition("/")
    temporary = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}.{uuid.uuid4().hex}")
    # A local file with a checksum beside it could not be replaced by one rename.
    plain = fs.getRaw() if fs.getUri().getScheme() == "file" else fs
    stream = plain.create(temporary, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if replace else kind.NONE
    try:
        files.rename(fs.makeQualified(temporary), fs.makeQualified(where), how)
    except Py4JJavaError as error:
        fs.delete(temporary, False)
        if _is(error, "FileAlreadyExistsException"):
            return False
        raise
    return True


def read_manifest(spark: SparkSession, table: str, run_id: str) -> dict | None:
    """The manifest of one run, if it has been written to its end."""
    where, fs = _hadoop(spark, _manifest_path(table, run_id))
    try:
        stream = fs.open(where)
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return None
        raise
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def manifests(spark: SparkSession, table: str, since: datetime | None = None, retired: bool = False) -> DataFrame:
    """The manifests of a table's finished runs; with ``since`` only of those that reach to that time.

    A run that states no times may hold any.  Runs whose rows are in another run by now are
    left out, unless ``retired`` ones are asked for too.
    """
    folder = f"{table.rstrip('/')}/{_MANIFESTS}"
    if _exists(spark, folder):
        found = spark.read.schema(MANIFEST_DDL).json(folder)
    else:
        found = spark.createDataFrame([], MANIFEST_DDL)
    if not retired:
        found = found.where(F.col("merged_into").isNull())
    if since is not None:
        found = found.where(F.col("to_time").isNull() | (F.col("to_time") >= F.lit(str(since)).cast("timestamp")))
    return found


def attempts(
    spark: SparkSession, table: str, run_ids: Sequence[str] | None = None, since: datetime | None = None
) -> list[tuple[str, str]]:
    """Finished runs and the attempts that count, in order: all, the named ones, or those of a time range.

    The driver learns two short texts for each of them, which Spark's own file index also holds.
    """
    if run_ids is not None:
        found = [(r, read_manifest(spark, table, r)) for r in run_ids]
        return [(r, m["attempt"]) for r, m in found if m and not m["merged_into"]]
    rows = manifests(spark, table, since).select("run_id", "attempt").collect()
    return sorted((r.run_id, r.attempt) for r in rows)


def read_attempts(spark: SparkSession, table: str, ddl: str, chosen: Attempts) -> DataFrame:
    """The rows of some attempts under the declared schema of the table."""
    if not chosen:
        return spark.createDataFrame([], ddl)
    paths = [attempt_path(table, *pair) for pair in chosen]
    reader = spark.read.schema(f"{ddl}, attempt string").option("basePath", table)
    return reader.parquet(*paths).drop("attempt")


def read_runs(
    spark: SparkSession,
    table: str,
    ddl: str,
    run_ids: Sequence[str] | None = None,
    since: datetime | None = None,
) -> DataFrame:
    """The finished runs of a table: all, the named ones, or those that reach to a time.

    Only the folders of these are listed.  A run that was not written to its end, or has no
    files, reads as empty.
    """
    return read_attempts(spark, table, ddl, attempts(spark, table, run_ids, since))


def has_run(spark: SparkSession, table: str, run_id: str) -> bool:
    """Has the run been written to its end?"""
    return read_manifest(spark, table, run_id) is not None


def finished_runs(spark: SparkSession, table: str) -> list[str]:
    """Ids of the runs of a table that were written to their end, in order."""
    return [run_id for run_id, _ in attempts(spark, table)]


def free_run_id(spark: SparkSession, table: str, wanted: str) -> str:
    """``wanted`` unless there is a finished run of that id, else the first free ``wanted-2``, ``wanted-3``, …"""
    for number in count(1):
        run_id = wanted if number == 1 else f"{wanted}-{number}"
        if not has_run(spark, table, run_id):
            return run_id


def check_owner(spark: SparkSession, table: str, run_id: str, owner: str | None) -> dict | None:
    """The manifest of the run, which is ours or nobody's; an error if it is somebody else's."""
    held = read_manifest(spark, table, run_id)
    if held and held["owner"] and owner and held["owner"] != owner:
        raise RunTaken(f"run {run_id} of {table} belongs to {held['owner']}")
    if held and held["merged_into"]:
        raise RunTaken(f"run {run_id} of {table} has become part of {held['merged_into']}")
    return held


def _commit(spark: SparkSession, table: str, manifest: dict) -> None:
    """Let the attempt count, unless a run of another owner has come first."""
    path, text = _manifest_path(table, manifest["run_id"]), json.dumps(manifest)
    while True:
        held = check_owner(spark, table, manifest["run_id"], manifest["owner"])
        # Put where there is none; replace only what is ours, and look again if one appeared.
        if put_file(spark, path, text, replace=held is not None):
            return


def write_run(
    df: DataFrame,
    table: str,
    run_id: str,
    partition_by: Sequence[str] = (),
    max_records_per_file: int = 5_000_000,
    owner: str | None = None,
    times: tuple[datetime, datetime] | None = None,
    counts: Callable[[], dict[str, int]] | None = None,
    source: str | None = None,
    consumed: DataFrame | None = None,
    beside: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    order: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Write the rows of one run as a new attempt and let it count; returns the attempt's folder.

    It replaces an earlier attempt of the same run.  With an ``owner`` the run is signed, and a
    run signed by another one is not replaced.  ``times`` are the first and last time of
    the rows, ``counts`` says at the end how many there are of each kind, ``source`` from
    what they were made, and ``consumed`` which input files (``path, length, modified``).
    ``beside`` makes further tables, by name, from the rows as they were stored; see
    ``read_beside``.  All this counts from the same moment as the rows.  With an ``order`` they
    are first written as they come, as an attempt that never counts, and then in that order.
    """
    spark = df.sparkSession
    check_owner(spark, table, run_id, owner)
    attempt = uuid.uuid4().hex
    path = attempt_path(table, run_id, attempt)

    def write(rows: DataFrame, where: str) -> None:
        rows.write.options(maxRecordsPerFile=max_records_per_file, compression="zstd").partitionBy(*partition_by).parquet(where)

    if order is None:
        write(df, path)
    else:
        loose = attempt_path(table, run_id, uuid.uuid4().hex)
        write(df, loose)
        with searchable_times(spark):
            write(order(spark.read.schema(df.schema).parquet(loose)), path)
        where, fs = _hadoop(spark, loose)
        fs.delete(where, True)
    if consumed is not None:
        consumed.write.parquet(f"{table.rstrip('/')}/{_CONSUMED}/attempt={attempt}")
    for name, make in (beside or {}).items():
        stored = spark.read.schema(df.schema).parquet(path)
        make(stored).write.parquet(f"{table.rstrip('/')}/{name}/attempt={attempt}")
    first, last = times or (None, None)
    manifest = {
        "run_id": run_id, "attempt": attempt, "owner": owner, "source": source, "written": int(time.time() * 1000),
        "from_time": first and str(first), "to_time": last and str(last), "counts": counts() if counts else {},
        "merged_into": None,
    }
    _commit(spark, table, manifest)
    return path


def retire_run(spark: SparkSession, table: str, run_id: str, attempt: str, into: str) -> None:
    """The rows of an attempt are in another run by now: it is read no more, and the run is not repeated."""
    held = read_manifest(spark, table, run_id)
    if held and held["attempt"] == attempt:
        put_file(spark, _manifest_path(table, run_id), json.dumps({**held, "merged_into": into}), replace=True)


def read_beside(spark: SparkSession, table: str, what: str, ddl: str) -> DataFrame:
    """What attempts have written beside their rows, with their ``attempt``, whether they count or not."""
    folder, ddl = f"{table.rstrip('/')}/{what}", f"{ddl}, attempt string"
    return spark.read.schema(ddl).parquet(folder) if _exists(spark, folder) else spark.createDataFrame([], ddl)


def consumed_files(spark: SparkSession, table: str, but_run: str | None = None) -> DataFrame:
    """The input files that finished runs of a table have read: ``path, length, modified``.

    Lists of attempts that do not count have no part, nor that of the run ``but_run``.
    """
    lists = read_beside(spark, table, _CONSUMED, FILES_DDL)
    live = manifests(spark, table, retired=True)
    if but_run is not None:
        live = live.where(F.col("run_id") != but_run)
    return lists.join(live.select("attempt"), "attempt", "left_semi").drop("attempt")


def prune_attempts(spark: SparkSession, table: str, older_than: timedelta = timedelta(days=1)) -> int:
    """Delete the folders of attempts that do not count and were last written before that time; returns how many.

    Readers that began before a run was repeated still read its old attempt, and writers
    that are not done have no manifest yet: hence the age.
    """
    kept_on = F.col("merged_into").isNull() | F.col("counts")[GENERATION].isNotNull()
    known = manifests(spark, table, retired=True).select("attempt", kept_on.alias("kept_on")).collect()
    live, read = {r.attempt for r in known if r.kept_on}, {r.attempt for r in known}
    before = int((time.time() - older_than.total_seconds()) * 1000)
    removed = 0
    for pattern in (f"{run_path(table, '*')}/attempt=*", f"{table.rstrip('/')}/_*/attempt=*"):
        where, fs = _hadoop(spark, pattern)
        for status in fs.globStatus(where) or []:
            name = status.getPath().getName().removeprefix("attempt=")
            kept = read if status.getPath().getParent().getName() == _CONSUMED else live
            if name not in kept and status.getModificationTime() < before:
                removed += bool(fs.delete(status.getPath(), True))
    return removed


def lookback(
    table: DataFrame,
    now: datetime | str,
    hours: float = 6,
    time_column: str = "upload_time",
    hour_column: str | None = "upload_hour",
) -> DataFrame:
    """Rows uploaded within the last ``hours``: lower bound inclusive, no upper bound.

    The condition on the hour column selects directories before any file is opened.
    """
    start = lookback_start(now, hours)
    kinds = {f.name: f.dataType for f in table.schema}
    recent = F.col(time_column) >= instant(start, kinds[time_column])
    if hour_column:
        recent &= F.col(hour_column) >= instant(start_of_hour(start), kinds[hour_column])
    return table.where(recent)


def read_lookback(spark: SparkSession, table: str, ddl: str, now: datetime | str, hours: float = 6) -> DataFrame:
    """The lookback over a run table: only the folders of runs that reach into it are opened."""
    return lookback(read_runs(spark, table, ddl, since=lookback_start(now, hours)), now, hours)
