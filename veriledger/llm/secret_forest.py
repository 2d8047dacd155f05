"""Secrets in texts: broad candidates, and a random forest that removes the false ones.

The forest sees how long a candidate is, how its characters follow each other, how much of
it dictionary words cover, the path of its document and the words next to it.  It is
trained from labelled findings.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriledger.llm.common import bounded_batches, near_smallest, written

# A run of characters that keys are made of, long enough for one.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-]{16,}={0,2}")
# What names a value: a word for a credential, with or without a sign or a verb, or a sign alone.
_CREDENTIAL = re.compile(
    r"(?:passwords?|passwd|passphrase|pwd|secrets?|tokens?|keys?|credentials?)(?![A-Za-z0-9])"
    r"[\"'\])]{0,2}\s{0,8}(?P<sign>(?:=>|:=|={1,3}|:(?!//)|is\b|are\b)\s{0,8})?",
    re.IGNORECASE,
)
_SIGN = re.compile(r"(?:=>|:=|={1,3}|:(?!//))[ \t]{0,8}")
# A value: what stands in quotes, or else up to a blank.
_VALUE = re.compile(r"\"([^\"\s]++)\"|'([^'\s]++)'|([^\s]++)")
# The least characters of a value after a word for a credential, and of any other value.
NAMED, ASSIGNED = 4, 6
_WORD = re.compile(r"[^\W_]+")
# Characters of a path that say that its content is an example.
_EXAMPLE = re.compile(r"test|example|sample|doc|mock|fixture", re.IGNORECASE)
BEFORE, AFTER, EXTENSIONS = 24, 8, 4
DICTIONARY, SHORTEST, LONGEST = 20_000, 4, 12
# Alphabet of the transitions: 26 letters, digits as one, everything else as one.
_LETTERS = 28
_CLASS = np.full(256, _LETTERS - 1, dtype=np.int64)
_CLASS[ord("a") : ord("z") + 1] = np.arange(26)
_CLASS[ord("A") : ord("Z") + 1] = np.arange(26)
_CLASS[ord("0") : ord("9") + 1] = 26
# To letters in lower case and blanks; bytes of other scripts stay.
_ONLY_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_COUNT = "word string, pair int, n bigint"
_COUNT_ARROW = pa.schema([("word", pa.string()), ("pair", pa.int32()), ("n", pa.int64())])
_FINDING = "doc_id bigint, start int, end int, candidate string, before string, after string, features array<double>"
_FINDING_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("candidate", pa.string()),
        ("before", pa.string()), ("after", pa.string()), ("features", pa.list_(pa.float64())),
    ]
)


def _counted(limit: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        pairs = np.zeros(_LETTERS**2, dtype=np.int64)

        def flush() -> pa.RecordBatch:
            n = len(words)
            names = [w.decode(errors="replace") for w in words]
            return pa.record_batch(
                [
                    pa.array([*names, *[None] * len(pairs)], pa.string()),
                    pa.array([*[None] * n, *range(len(pairs))], pa.int32()),
                    pa.array([*words.values(), *pairs.tolist()], pa.int64()),
                ],
                schema=_COUNT_ARROW,
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                text = text or b""
                words.update(text.translate(_ONLY_LETTERS).split())
                kinds = _CLASS[np.frombuffer(text, dtype=np.uint8)]
                pairs += np.bincount(kinds[:-1] * _LETTERS + kinds[1:], minlength=_LETTERS**2)
                if len(words) > limit:
                    yield flush()
                    words.clear()
                    pairs[:] = 0
        yield flush()

    return count


class Language:
    """What ordinary text looks like: its frequent words, and how likely characters follow others."""

    def __init__(self, words: set[str], pairs: np.ndarray):
        self.words = words
        table = pairs.reshape(_LETTERS, _LETTERS) + 1.0
        self.likely = np.log(table / table.sum(axis=1, keepdims=True))

    def transitions(self, text: str) -> float:
        """The mean log-likelihood of a character after the one before it."""
        kinds = _CLASS[np.frombuffer(text.encode(), dtype=np.uint8)]
        return float(self.likely[kinds[:-1], kinds[1:]].mean()) if len(kinds) > 1 else 0.0

    def coverage(self, text: str) -> float:
        """The share of the characters that dictionary words cover, longest words first."""
        low, at, covered = text.lower(), 0, 0
        while at + SHORTEST <= len(low):
            for size in range(min(LONGEST, len(low) - at), SHORTEST - 1, -1):
                if low[at : at + size] in self.words:
                    covered += size
                    at += size
                    break
            else:
                at += 1
        return covered / len(text)


def language(docs: DataFrame, text_col: str = "text", limit: int = 400_000) -> Language:
    """Counted over all texts; the DICTIONARY most frequent words and a fixed table reach the driver."""
    rows = docs.select(F.col(text_col).cast("binary").alias("text"))
    counts = written(rows.mapInArrow(_counted(limit), _COUNT).groupBy("word", "pair").agg(F.sum("n").alias("n")), "language")
    words = (
        counts.filter(F.length("word").between(SHORTEST, LONGEST)).orderBy(F.desc("n"), "word").limit(DICTIONARY)
        .select("word").toArrow().column("word").to_pylist()
    )
    pairs = np.zeros(_LETTERS**2)
    for row in counts.filter("pair is not null").select("pair", "n").collect():
        pairs[row.pair] = row.n
    return Language(set(words), pairs)


def _bucket(word: str, size: int) -> int:
    return xxhash.xxh3_64_intdigest(word.lower()) % size


def _value(text: str, start: int, least: int) -> tuple[int, int] | None:
    """Where the value is that begins at ``start``, without quotes and closing punctuation."""
    m = _VALUE.match(text, start)
    if not m:
        return None
    begin, end = m.span(m.lastindex)
    if m.lastindex == 3:
        while begin < end and text[begin] in "\"'([{<":
            begin += 1
        while begin < end and text[end - 1] in "\"')]}>,;.":
            end -= 1
    return (begin, end) if end - begin >= least else None


def spans(text: str) -> list[tuple[int, int, bool]]:
    """Start and end of every candidate in order, and whether a word for a credential stands before it.

    Runs of key characters; and, whatever their characters, values after a word for a
    credential or a sign of assignment.  A sign within the value of another one names
    nothing of its own, so that the candidates are never much longer than the text.
    """
    found = {m.span(): False for m in CANDIDATE.finditer(text)}
    for pattern, least in ((_SIGN, ASSIGNED), (_CREDENTIAL, NAMED)):
        named, until = pattern is _CREDENTIAL, 0
        for m in pattern.finditer(text):
            start, signed = m.end(), not named or m["sign"] is not None
            if m.start() < until:
                continue
            # Without a sign the word stands alone and a blank follows it.
            if not signed and (not text[start - 1].isspace() or text[max(0, m.start() - 1) : m.start()].isalpha()):
                continue
            # A sign stands behind a name: on the same line, with few blanks between.
            if not named and not text[max(0, m.start() - 4) : m.start()].rpartition("\n")[2].strip():
                continue
            place = _value(text, start, least)
            if place:
                found[place] = found.get(place, False) or named
                until = place[1] if signed else until
    return [(*place, found[place]) for place in sorted(found)]


def features(text: str, start: int, end: int, path: str, speech: Language, named: bool = False) -> tuple[list[float], str, str]:
    """What the forest sees of a candidate, and the words before and after it."""
    found = text[start:end]
    n = len(found)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in found]
    letters = max((len(run) for run in re.findall("[A-Za-z]+", found)), default=0)
    lead, tail = text[max(0, start - 40) : start], text[end : end + 40]
    before = (_WORD.findall(lead) or [""])[-1]
    after = (_WORD.findall(tail) or [""])[0]
    close = lead.rstrip(" \"'")[-1:]
    out = [
        float(n), len(set(found)) / n, *(kinds.count(k) / n for k in "dul"),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n, letters / n,
        speech.transitions(found), speech.coverage(found),
        float(close in ("=", ":") and bool(close)), float(lead[-1:] in ("'", '"') and tail[:1] in ("'", '"') and bool(lead)),
        float(lead[-1:] in ("/", ".", "@")),
        float(path.count("/")), float(bool(_EXAMPLE.search(path))), float(named),
    ]
    for size, word in ((EXTENSIONS, path.rpartition(".")[2]), (BEFORE, before), (AFTER, after)):
        hot = [0.0] * size
        hot[_bucket(word, size)] = 1.0
        out += hot
    return out, before, after


def candidates(docs: DataFrame, speech: Language, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """``doc_id, start, end, candidate, before, after, features`` of every candidate in whole texts.

    Offsets count characters.  No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(speech)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(n).to_pylist() for n in ("doc_id", "text", "path"))
            for doc_id, text, path in zip(*columns, strict=True):
                for start, end, named in spans(text or ""):
                    seen, before, after = features(text, start, end, path or "", shared.value, named)
                    rows.append((doc_id, start, end, text[start:end], before, after, seen))
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _FINDING_ARROW, strict=True)], schema=_FINDING_ARROW)

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.col(path_col).cast("string").alias("path")
    )
    return rows.mapInArrow(find, _FINDING)


def known_formats(findings: DataFrame) -> Column:
    """A label where the form of a finding leaves no doubt: 1 a secret, 0 none, null where it does.

    Stands in for findings labelled by people, of which there is no table: access keys of a
    known issuer and long hexadecimal values assigned to a word for a credential are
    secrets, and so are values of three kinds of characters after a word for a password;
    words without a digit and bare numbers are none, unless they follow such a word.
    """
    credential = F.lower(F.col("before")).isin("token", "password", "passwd", "secret", "key", "apikey")
    password = F.lower(F.col("before")).rlike("^(password|passwd|passphrase|pwd)s?$")
    mixed = F.col("candidate").rlike(r"^(?=.*[A-Za-z])(?=.*[0-9])(?=.*[^A-Za-z0-9])[^<>{}()\[\]$]{8,}$")
    hexadecimal = F.col("candidate").rlike("^[0-9a-f]{18,}$")
    return (
        F.when(F.col("candidate").rlike("^AKIA[0-9A-Z]{16}$"), 1)
        .when(hexadecimal & credential, 1)
        .when(password & mixed, 1)
        .when(password, None)
        .when(F.col("candidate").rlike("^[0-9]+$") | ~F.col("candidate").rlike("[0-9]"), 0)
    )


def judged(
    findings: DataFrame, label: Column, learn: Column, most: int = 20_000, trees: int = 40, depth: int = 8, seed: int = 5
) -> DataFrame:
    """``findings`` with ``label``, ``score`` (the forest's share for a secret) and ``secret``.

    The forest learns from at most ``most`` findings of each label among those that satisfy
    ``learn``, those of smallest hash.  Without findings of both labels nothing can be told
    apart, and every candidate stays, with score 1.
    """
    labelled = written(findings.withColumn("label", label.cast("int")), "findings")
    order = W.partitionBy("label").orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start", "candidate")
    known = labelled.filter(learn & F.col("label").isNotNull())
    sample = written(
        near_smallest(known, "label", F.xxhash64("doc_id", "start"), most).withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= most).select(F.col("label").cast("double").alias("label"), "features"),
        "labelled-findings",
    )
    if sample.select("label").distinct().count() < 2:
        return labelled.withColumns({"score": F.lit(1.0), "secret": F.lit(True)}).drop("features")
    vectors = sample.select("label", array_to_vector("features").alias("features")).coalesce(4)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt", minInstancesPerNode=2
    ).fit(vectors)
    scored = forest.transform(labelled.withColumn("features", array_to_vector("features")))
    score = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select(
        *[c for c in labelled.columns if c != "features"], score.alias("score"), (score >= 0.5).alias("secret")
    )


def secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", learn: Column | None = None
) -> DataFrame:
    """Every candidate of every whole text, judged: ``doc_id, start, end, candidate, before, after,
    label, score, secret``.

    ``learn`` says which findings the forest may learn from, all by default.  Null and empty
    texts have no candidates, a null path counts as empty, repeated rows are searched each,
    an empty table gives an empty one.  Texts of any length are searched whole.  Other
    columns are ignored, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    found = written(candidates(docs, language(docs, text_col), id_col, text_col, path_col), "candidates")
    return judged(found, known_formats(found), F.lit(True) if learn is None else learn)
