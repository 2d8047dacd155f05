"""Recurring lines by log-template trees, in DataFrame functions only.

Tokens with a digit are variable from the start.  A line's leaf in the tree is its number of
tokens and its leading tokens; a second tree goes by the trailing ones, for lines that vary
at their beginning.  Within a leaf, lines that agree in all tokens outside a short window
share a template, whose variable field lies in that window.  The windows of a line follow
from its number of tokens, so whether two lines share a template depends on no other line.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriledger.llm.common import BLANKS, written

VARIABLE = "<*>"
# A token with a digit, of tokens parted by single spaces.  Possessive, so never quadratic.
_DIGITS = "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"
# Bits of a row of a bitmap, and of a whole one at most.
_ROW_BITS, _MOST_BITS = 1 << 15, 1 << 28


def plain_line(line: Column) -> Column:
    """A line with single spaces between its tokens."""
    uneven = line.rlike("[\\x09-\\x0D]|  ")
    return F.trim(F.when(uneven, F.regexp_replace(line, BLANKS, " ")).otherwise(line))


def shape_of(plain: Column) -> Column:
    """A plain line with its tokens with digits masked."""
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, _DIGITS, VARIABLE)).otherwise(plain)


def token_count(shape: Column) -> Column:
    return F.length(shape) - F.length(F.replace(shape, F.lit(" "), F.lit(""))) + 1


def _lines(docs: DataFrame, depth: int, least_tokens: int) -> DataFrame:
    """``doc, line, shape, tokens, leaf, tail, code`` of every line that can be a template.

    Shapes are worked out inside the array that is exploded: once a line, however many
    columns and filters refer to them.
    """
    shapes = F.transform(F.transform(F.split("text", "\n"), plain_line), shape_of)
    counted = F.transform(shapes, lambda s, i: F.struct(i.alias("line"), s.alias("shape"), token_count(s).alias("tokens")))
    # A short line of nothing but variable tokens says nothing.
    nothing = [" ".join([VARIABLE] * n) for n in range(depth)]
    usable = F.filter(counted, lambda c: (c["tokens"] >= least_tokens) & ~c["shape"].isin(nothing))
    return (
        docs.filter("doc is not null").select("doc", F.explode(usable).alias("found")).select("doc", "found.*")
        .withColumn("leaf", F.xxhash64("tokens", F.substring_index("shape", " ", depth)))
        .withColumn("tail", F.xxhash64("tokens", F.substring_index("shape", " ", -depth)))
        .withColumn("code", F.xxhash64("shape"))
    )


def _bits_for(leaves: int) -> int:
    """Bits of a bitmap that so many leaves fill to an eighth at most; 32 MiB of them in the end."""
    return min(max(_ROW_BITS, 1 << (8 * leaves - 1).bit_length()), _MOST_BITS)


def _filter_of(leaves: DataFrame, bits: int) -> DataFrame:
    """A bitmap of the leaves, in rows of 4 KiB."""
    bit = F.pmod("leaf", F.lit(bits))
    return leaves.groupBy((bit / _ROW_BITS).cast("int").alias("bitmap_row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit % _ROW_BITS + 1)).alias("bitmap")
    )


def _passing(lines: DataFrame, leaf: str, bitmap: DataFrame, bits: int, name: str) -> DataFrame:
    """``lines`` with a flag: may the leaf be among those of the bitmap?  Keeps shuffles small, never decides."""
    place = F.pmod(leaf, F.lit(bits))
    byte = F.substring("bitmap", (place % _ROW_BITS / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    held = lines.withColumn("bitmap_row", (place / _ROW_BITS).cast("int")).join(F.broadcast(bitmap), "bitmap_row", "left")
    is_set = F.call_function("shiftright", value, (place % 8).cast("int")).bitwiseAND(1) == 1
    return held.withColumn(name, F.coalesce(is_set, F.lit(False))).drop("bitmap", "bitmap_row")


def _starts(first: Column, last: Column, step: Column) -> Column:
    """The places a window begins at, from ``first`` to ``last``."""
    none = F.array().cast("array<int>")
    return F.when(last < first, none).otherwise(F.array_distinct(F.array_append(F.sequence(first, last, step), last)))


def _windows(lines: DataFrame, depth: int, variable: int) -> DataFrame:
    """``leaf, key, code, first, last``: each line with its leaf and what is left outside each of its windows.

    A window holds ``variable`` per cent of the tokens, one at least, and overlaps the next by half:
    a variable field of half a window lies whole in one of them.  The tokens that make the
    leaf are in none.
    """
    n, m, words = F.col("tokens"), F.col("held"), F.col("words")
    sized = lines.withColumn("held", F.greatest(F.lit(1), F.floor(F.col("tokens") * variable / 100)).cast("int")).withColumn(
        "words", F.split("shape", " ")
    )
    step = F.ceil(m / 2).cast("int")
    leading = F.when(F.col("by_leaf"), _starts(F.lit(depth), n - m, step))
    trailing = F.when(F.col("by_tail"), _starts(F.lit(0), n - depth - m, step))
    every = F.concat(
        F.transform(F.coalesce(leading, F.array().cast("array<int>")), lambda s: F.struct(F.lit("leading").alias("kind"), s.alias("start"))),
        F.transform(F.coalesce(trailing, F.array().cast("array<int>")), lambda s: F.struct(F.lit("trailing").alias("kind"), s.alias("start"))),
    )
    placed = sized.withColumn("at", F.explode(every)).select("*", "at.kind", "at.start")
    head = F.array_join(F.slice(words, F.lit(1), F.col("start")), " ")
    rest = F.array_join(F.slice(words, F.col("start") + m + 1, n), " ")
    return placed.select(
        F.when(F.col("kind") == "leading", F.col("leaf")).otherwise(F.col("tail")).alias("place"),
        F.xxhash64("kind", "start", head, rest).alias("key"), "leaf", "code", "first", "last",
    )


def _generalised(shapes: DataFrame, lines: DataFrame, depth: int, variable: int) -> DataFrame:
    """``leaf, code, first`` of the different lines that share a template with others, and where it comes first."""
    flagged, candidates = lines, shapes
    for leaf, name in (("leaf", "by_leaf"), ("tail", "by_tail")):
        leaves = shapes.groupBy(F.col(leaf).alias("leaf")).agg(
            F.count("*").alias("different"), F.min("first").alias("first"), F.max("last").alias("last")
        )
        several = written(leaves.filter("different > 1 and first < last").select("leaf"), "leaves")
        bits = _bits_for(several.count())
        bitmap = _filter_of(several, bits)
        flagged, candidates = (_passing(rows, leaf, bitmap, bits, name) for rows in (flagged, candidates))
    # The text of each different line, from the document where it comes first.
    either = F.col("by_leaf") | F.col("by_tail")
    texts = flagged.filter(either & (F.col("tokens") > depth))
    found = (
        texts.select("leaf", "tail", "code", F.col("doc").alias("first"), "shape", "tokens", "by_leaf", "by_tail")
        .join(candidates.filter(either).select("leaf", "code", "first", "last"), ["leaf", "code", "first"])
        .dropDuplicates(["leaf", "code"])
    )
    windows = written(_windows(found, depth, variable), "template-windows", "zstd")
    templates = windows.groupBy("place", "key").agg(F.min("first").alias("start"), F.max("last").alias("end")).filter("start < end")
    return windows.join(templates, ["place", "key"]).groupBy("leaf", "code").agg(F.min("start").alias("first"))


def recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 3, least_tokens: int = 1,
    variable: int = 30,
) -> DataFrame:
    """``doc_id, dropped``: for each document with any, the numbers of its lines to drop, from 0.

    A line recurs if a document of a smaller id has a line of the same shape or template; it stays
    in the first document that has any and is dropped from all others.  Lines of up to
    ``depth`` tokens recur by their shape alone, and not if all of these are variable;
    blank lines never do.  ``variable`` is the length of a variable field in per cent of
    the tokens, see ``_windows``.  Lines of any length are compared whole.

    Different lines are counted by two 64-bit codes, in partial aggregates, so a line that
    a third of all documents have costs a row per task.  Only the text of leaves with
    several different lines is shuffled, behind a filter whose size follows their number.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    # Texts are split and masked once; what follows reads the columns it needs of this table.
    lines = written(_lines(plain, depth, least_tokens), "lines", "zstd")
    shapes = written(
        lines.groupBy("leaf", "tail", "code").agg(
            F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n")
        ),
        "shapes", "zstd",
    )
    exact = shapes.filter("first < last").select("leaf", "code", "first")
    recurring = exact.unionByName(_generalised(shapes, lines, depth, variable)).groupBy("leaf", "code").agg(F.min("first").alias("first"))
    # Lines that make up a thousandth of all are not dealt out by their code, as one of them may
    # be a third of all lines: they meet their few rows, a thousand at most, where they are.
    key = ["leaf", "code"]
    total = shapes.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(shapes.filter(F.col("n") > max(1000, total // 1000)).select(*key))
    placed = lines.select("doc", "line", *key)
    frequent = placed.join(F.broadcast(recurring.join(hot, key, "left_semi")), key)
    others = placed.join(hot, key, "left_anti").join(recurring, key)
    return (
        frequent.unionByName(others).filter("doc <> first")
        .groupBy("doc").agg(F.collect_set("line").alias("dropped"))  # at most the lines of one document
        .withColumnRenamed("doc", "doc_id")
    )


def without_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the text of the lines that stay, and ``n_lines, n_dropped``.

    The lines that stay are joined by a line feed as they were; a document that loses all of
    its lines keeps an empty text.  Null texts stay null and have no lines; an empty text is
    one empty line.  Rows without id neither count nor lose anything; rows that repeat an id
    are one document and lose the same line numbers.  An empty table gives an empty one.
    Other columns are kept as they are; ``n_lines`` and ``n_dropped`` replace columns of
    those names.
    """
    # Names of its own, whatever the columns of ``docs`` are called.
    gone_id, gone_lines = (f"__{uuid.uuid4().hex}" for _ in range(2))
    gone = recurring_lines(docs, id_col, text_col, **options).withColumnsRenamed({"doc_id": gone_id, "dropped": gone_lines})
    joined = docs.join(gone, docs[id_col] == F.col(gone_id), "left")
    source, dropped = docs[text_col], F.col(gone_lines)
    lines = F.split(source, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    text = F.when(dropped.isNull(), source).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    feeds = F.length(source) - F.length(F.replace(source, F.lit("\n"), F.lit("")))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(
        *[text.alias(c) if c == text_col else docs[c] for c in kept],
        F.coalesce(feeds + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
    )
