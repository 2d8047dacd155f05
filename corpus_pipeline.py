"""The documents made ready for training, stage by stage.

Each stage takes what the one before kept, written as Parquet and read again.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriledger.llm import bpe_tree, line_templates, pfair, superminhash, toxicity
from veriledger.llm.common import remainder, table, written
from veriledger.llm.queries import BLOCK_ROWS, OTHER_SHARE, SHARES, TOKENIZER

# Parameter: the share of ordinary documents that may be rejected with the toxic ones.
LOST = 0.04
# Parameter: stretches that an encoding worker remembers, beside all that earlier stages left in its executor.
STRETCHES = 200_000


def own_name() -> str:
    """A column name that no table has."""
    return f"__{uuid.uuid4().hex}"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score is below the judge's threshold, learned from labels outside the held-out fold.

    The threshold is chosen for a stated share of ordinary documents lost, on labelled texts
    that the models have not seen: ``LOST``.  Whole texts are scored; null and empty ones
    show nothing and stay, repeated rows share their fate, an empty table gives an empty
    one, and other columns come back as they are, whatever their names.
    """
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0)
    judge = toxicity.train(docs.select("doc_id", "text"), labels, lost=LOST)
    score = own_name()
    return toxicity.scored(docs, judge, name=score).filter(F.col(score) < judge.threshold).drop(score)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines stay in one document; a document that loses all of its text goes.

    Null and empty texts and rows without an id stay as they are; rows that repeat an id lose
    the same lines; lines of any length are told apart whole.  ``n_chars`` follows the text.
    An empty table gives an empty one; other columns come back, whatever their names.
    """
    # ``n_lines`` and ``n_dropped`` of the documents step aside for the counts of those names.
    aside = {c: own_name() for c in docs.columns if c.lower() in ("n_lines", "n_dropped")}
    clean = line_templates.without_recurring_lines(docs.withColumnsRenamed(aside))
    left = clean.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]") | F.col("text").isNull())
    n_chars = F.when(F.col("n_dropped") == 0, F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    left = left.withColumn("n_chars", n_chars).drop("n_lines", "n_dropped")
    return left.withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one of smallest id; of rows that repeat id and text, one.

    Documents without words are nobody's duplicates and stay, as do rows without an id.
    Links are confirmed on whole texts.  An empty table gives an empty one; other columns
    come back, whatever their names; of repeated rows that differ in them any one stays.
    """
    groups = written(
        superminhash.near_duplicates(docs.select("doc_id", "text")).filter("doc_id is not null")
        .groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("copies")).filter("not kept or copies > 1"),
        "pipeline-groups",
    )
    once = docs.join(groups, "doc_id", "left_anti")
    again = docs.join(groups.filter("kept").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.select(*docs.columns).unionByName(again.select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: file by file, row by row.

    Rows without a source are mixed with the sources not named; repeated rows stay next to
    each other; texts have no part, null, empty or long.  An empty table gives an empty
    one; other columns come back, whatever their names.
    """
    # The mixture takes some names for its own; all columns but the two it needs step aside.
    aside = {c: own_name() for c in docs.columns if c not in ("doc_id", "source")}
    mixed = pfair.mixed(docs.withColumnsRenamed(aside), SHARES, OTHER_SHARE, BLOCK_ROWS)
    ordered = mixed.repartitionByRange("mix_position").sortWithinPartitions("mix_position")
    return ordered.select("doc_id", "source", *aside.values()).withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``mix_position``: how many rows of its files come before each row, file by file, row by row.

    A scan may read the files in any order.  Rows that come from no file have no position.  A
    ``mix_position`` of ``docs`` is replaced.
    """
    docs = docs.drop("mix_position")
    file, at, start = (own_name() for _ in range(3))
    try:
        rows = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at))
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
        return docs.withColumn("mix_position", F.lit(None).cast("bigint"))  # rows of no file
    # A row for each file.  Writers number their files; from 100000 on the numbers have more digits.
    number = F.regexp_extract(file, "part-([0-9]+)[^/]*$", 1).try_cast("bigint")
    before = W.orderBy(number, file).rowsBetween(W.unboundedPreceding, -1)
    files = rows.groupBy(file).agg(F.count("*").alias("n"))
    starts = files.select(file, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    return rows.join(F.broadcast(starts), file).select(*docs.columns, (F.col(start) + F.col(at)).alias("mix_position"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their number, the digests of ids and decoded text, and its place.

    Whole texts are encoded; null counts as empty and has no ids; repeated rows are encoded
    each.  An empty table gives an empty one; other columns have no part, whatever their names.
    """
    rows = bpe_tree.encode_and_decode(placed(docs), TOKENIZER, keep=("mix_position",), memory=STRETCHES)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
        "mix_position",
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_recurring_lines),
    ("near-duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# SQL can express neither the models nor the merges of the tokenizer; tests/llm checks the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
