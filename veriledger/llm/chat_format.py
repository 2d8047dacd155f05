"""Conversations as training texts, assembled as columns of bytes.

The turns of a batch become segments (marks, role, text, marks).  Segment lengths and their
running sums say where each segment begins; numpy index arrays then scatter marks and
contents into one preallocated Arrow buffer, which is the text column that comes out.

Control strings inside roles and texts get a backslash behind their first character, and one
more for each they have already; taking one away gives the original back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.llm.common import bounded_batches, written

_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_FORMATTED = (
    "known boolean, conv bigint, part bigint, whole boolean, n_turns bigint, text string, "
    "loss array<struct<start:bigint,end:bigint>>"
)
_FORMATTED_ARROW = pa.schema(
    [
        ("known", pa.bool_()), ("conv", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()),
        ("n_turns", pa.int64()), ("text", pa.string()), ("loss", pa.list_(_SPAN)),
    ]
)
_TURNS = "known boolean, conv bigint, part bigint, nr bigint, role string, text string, loss boolean"
_DIGESTS = (
    "known boolean, conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)
_DIGESTS_ARROW = pa.schema(
    [
        ("known", pa.bool_()), ("conv", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)


@dataclass(frozen=True)
class Template:
    """The marks around each turn.

    ``marks`` gives what opens and closes the turns of the named roles; ``other`` what comes
    before and after the name of any other role, and what closes its turn.  Each ``control``
    string begins with a character that occurs in no control string again, so that two of
    them never overlap.  A turn opens with a control string, but for the role ``bare``,
    whose opening is plain text, and closes with one after some plain text.
    """

    marks: tuple[tuple[str, str, str], ...] = (
        ("user", "<s>[INST] ", " [/INST]"),
        ("assistant", " ", " </s>"),
        ("system", "[SYS] ", " [/SYS]"),
    )
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE] ", " </s>")
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]")
    loss_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        first = {c[0] for c in self.controls}
        if any(f in c[1:] for c in self.controls for f in first) or "\\" in "".join(self.controls):
            raise ValueError("the first character of a control string may not occur in one again")

    def _family(self, slashes: str) -> str:
        return "|".join(re.escape(c[0]) + slashes + re.escape(c[1:]) for c in sorted(self.controls))

    def to_escape(self) -> re.Pattern[bytes]:
        """A control string or the escaped form of one."""
        return re.compile(self._family(r"\\*").encode())

    def unescape(self, text: str) -> str:
        if "\\" not in text:
            return text
        return re.sub(self._family(r"\\+"), lambda m: m[0][0] + m[0][2:], text)

    def parse(self, text: str) -> Iterator[tuple[str, str]]:
        """``role, text`` of the turns of a formatted text."""
        at, opening, between, closing = 0, *self.other
        marks = sorted(self.marks, key=lambda m: -len(m[1]))
        while at < len(text):
            for role, start, end in marks:
                if text.startswith(start, at):
                    at += len(start)
                    break
            else:
                if not text.startswith(opening, at):
                    raise ValueError(f"no turn begins at character {at}")
                stop = text.index(between, at)
                role, end = self.unescape(text[at + len(opening) : stop]), closing
                at = stop + len(between)
            stop = text.index(end, at)
            yield role, self.unescape(text[at:stop])
            at = stop + len(end)


LLAMA = Template()


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts and the bounds of its rows within them."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets.astype(np.int64) - offsets[0]


def _insertions(data: np.ndarray, bounds: np.ndarray, pattern: re.Pattern[bytes]) -> np.ndarray:
    """Before which bytes a backslash goes: behind the first one of each control string.

    The texts lie end to end; what begins in one and ends in the next is no control string.
    """
    found = [(m.start(), m.end()) for m in pattern.finditer(data)]
    if not found:
        return np.zeros(0, dtype=np.int64)
    starts, ends = np.array(found, dtype=np.int64).T
    row = np.searchsorted(bounds, starts, "right") - 1
    return starts[ends <= bounds[row + 1]] + 1


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, end to end."""
    total = int(lengths.sum())
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)


class _Content:
    """A column of texts as a segment of each turn, escaped on the way."""

    def __init__(self, column: pa.Array, pattern: re.Pattern[bytes], used: np.ndarray | None = None):
        self.data, self.bounds = _bytes(column)
        self.used = np.ones(len(column), dtype=bool) if used is None else used
        inserted = _insertions(self.data, self.bounds, pattern)
        row = np.searchsorted(self.bounds, inserted - 1, "right") - 1
        self.inserted, self.row = inserted[self.used[row]], row[self.used[row]]
        self.extra = np.bincount(self.row, minlength=len(column))
        self.lengths = np.where(self.used, np.diff(self.bounds) + self.extra, 0)

    def scatter(self, out: np.ndarray, at: np.ndarray) -> None:
        """Copy the texts to the places their rows begin at, and put the backslashes in."""
        # Pieces of the source: rows, cut again before each insertion.
        begins = np.concatenate([self.bounds[:-1], self.inserted])
        rows = np.concatenate([np.arange(len(at)), self.row])
        order = np.argsort(begins, kind="stable")
        begins, rows, is_cut = begins[order], rows[order], order >= len(at)
        lengths = np.diff(np.append(begins, self.bounds[-1]))
        before = np.cumsum(is_cut)  # insertions so far, over all rows
        of_row = before - (np.cumsum(self.extra) - self.extra)[rows]
        places = at[rows] + begins - self.bounds[rows] + of_row
        taken = self.used[rows]
        out[_ranges(places[taken], lengths[taken])] = self.data[_ranges(begins[taken], lengths[taken])]
        out[places[is_cut] - 1] = ord("\\")


class _Marks:
    """One of a few constant texts as a segment of each turn."""

    def __init__(self, texts: list[str], kind: np.ndarray):
        parts = [t.encode() for t in texts]
        self.data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        sizes = np.array([len(p) for p in parts])
        self.begins, self.lengths = (np.cumsum(sizes) - sizes)[kind], sizes[kind]

    def scatter(self, out: np.ndarray, at: np.ndarray) -> None:
        out[_ranges(at, self.lengths)] = self.data[_ranges(self.begins, self.lengths)]


def assembled(role: pa.Array, text: pa.Array, cuts: np.ndarray, template: Template) -> tuple[pa.Array, pa.Array]:
    """Formatted texts and loss spans of the conversations that begin at the turns ``cuts``.

    ``cuts`` ends with the number of turns.  Spans count code points within a formatted text.
    """
    names = pa.array([m[0] for m in template.marks], pa.string())
    kind = pc.fill_null(pc.index_in(role, names), len(names)).to_numpy(zero_copy_only=False)
    other = kind == len(names)
    pattern = template.to_escape()
    segments = [
        _Marks([m[1] for m in template.marks] + [template.other[0]], kind),
        _Content(role, pattern, other),
        _Marks([""] * len(names) + [template.other[1]], kind),
        _Content(text, pattern),
        _Marks([m[2] for m in template.marks] + [template.other[2]], kind),
    ]
    lengths = np.column_stack([s.lengths for s in segments]).astype(np.int64)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    starts = ends - lengths
    total = int(ends[-1, -1]) if len(ends) else 0
    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, dtype=np.uint8)
    for number, segment in enumerate(segments):
        segment.scatter(out, starts[:, number])
    offsets = np.append(starts[:, 0], total)[cuts]
    texts = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(offsets.astype(np.int32)), buffer)
    learned = pc.is_in(role, pa.array(template.loss_roles, pa.string())).to_numpy(zero_copy_only=False)
    points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80, dtype=np.int32)]).astype(np.int32)
    turn = np.flatnonzero(learned)
    base = points[offsets][np.searchsorted(cuts, turn, "right") - 1].astype(np.int64)
    spans = pa.StructArray.from_arrays(
        [pa.array(points[starts[turn, 3]] - base, pa.int64()), pa.array(points[ends[turn, 3]] - base, pa.int64())],
        names=["start", "end"],
    )
    at = np.concatenate([[0], np.cumsum(learned)])[cuts]
    return texts, pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans)


def _formatter(template: Template, part_bytes: int):
    def rows(turns: pa.Table, number: int, first: bool, last: bool) -> pa.RecordBatch:
        """Parts numbered from ``number``; the first or last conversation may go on outside."""
        known = turns.column("known").combine_chunks().to_numpy(zero_copy_only=False)
        conv = turns.column("conv").combine_chunks().to_numpy()
        inner = 1 + np.flatnonzero((conv[1:] != conv[:-1]) | (known[1:] != known[:-1]))
        cuts = np.array([0, *inner, len(conv)])
        role, text = (turns.column(c).combine_chunks() for c in ("role", "text"))
        texts, loss = assembled(role, text, cuts, template)
        whole = np.ones(len(cuts) - 1, dtype=bool)
        whole[0] &= not first
        whole[-1] &= not last
        return pa.record_batch(
            [
                pa.array(known[cuts[:-1]]), pa.array(conv[cuts[:-1]]), pa.array(number + np.arange(len(cuts) - 1)),
                pa.array(whole), pa.array(np.diff(cuts)), texts, loss,
            ],
            schema=_FORMATTED_ARROW,
        )

    def format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, cut = TaskContext.get().partitionId() << 32, None, True
        # ``cut``: the conversation at the start of what is held may have begun before.
        for batch in batches:
            if not batch.num_rows:
                continue
            turns = pa.Table.from_batches([batch])
            held = turns if held is None else pa.concat_tables([held, turns])
            last = held.slice(held.num_rows - 1)
            same = pc.and_(
                pc.equal(held.column("conv"), last.column("conv")[0]), pc.equal(held.column("known"), last.column("known")[0])
            )
            done = held.num_rows - int(pc.sum(same).as_py())  # the last conversation may go on
            if done:
                out = rows(held.slice(0, done), number, cut, False)
                number, held, cut = number + out.num_rows, held.slice(done), False
                yield out
            if held.nbytes > part_bytes:
                out = rows(held, number, True, True)
                number, held, cut = number + out.num_rows, None, True
                yield out
        if held is not None:
            yield rows(held, number, cut, True)

    return format_batches


def formatted(conversations: DataFrame, template: Template = LLAMA, part_bytes: int = 8 << 20) -> DataFrame:
    """``known, conv, part, whole, n_turns, text, loss``: the conversations as texts, written and read back.

    ``conversations`` has ``conv_id, turn, role, text``; turns go by ``turn``, null first,
    then by role and text, which also orders repeated rows; null roles and texts are empty.
    Rows without an id are one conversation (``known`` is false and ``conv`` 0).  Other
    columns are ignored, whatever their names.  An empty table gives an empty one.

    ``loss`` holds the spans, in code points of ``text``, of what the loss is taken over:
    the text of each turn of a ``loss_roles``, escaped as it stands there.

    Rows are range-partitioned, so that a conversation of any length is spread over tasks.
    One that reaches over an end of a task, or is longer than ``part_bytes``, comes as
    several rows (``whole`` is false) whose texts, in the order of ``part``, make it up;
    a turn is never cut.  A task holds a batch and at most ``part_bytes`` more.
    """
    bounded_batches(conversations.sparkSession)
    turns = conversations.select(
        F.col("conv_id").isNotNull().alias("known"),
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = turns.repartitionByRange("known", "conv", "turn", "role", F.substring("text", 1, 64))
    ordered = ordered.sortWithinPartitions("known", "conv", "turn", "role", "text")
    parts = ordered.select("known", "conv", "role", "text").mapInArrow(_formatter(template, part_bytes), _FORMATTED)
    return written(parts, "chat-format")


def _in_order(parts: DataFrame) -> list[DataFrame]:
    """Whole conversations where they are, and the parts of the others brought together."""
    split = parts.filter("not whole").repartition("known", "conv").sortWithinPartitions("known", "conv", "part")
    return [parts.filter("whole"), split]


def read_turns(parts: DataFrame, template: Template = LLAMA) -> DataFrame:
    """The turns of formatted texts: ``known, conv, part, nr, role, text, loss``, in order of ``part, nr``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = list(template.parse(row["text"]))
                n = len(found)
                yield pa.record_batch(
                    [
                        pa.array([row["known"]] * n, pa.bool_()), pa.array([row["conv"]] * n, pa.int64()),
                        pa.array([row["part"]] * n, pa.int64()), pa.array(range(n), pa.int64()),
                        pa.array([r for r, _ in found], pa.string()), pa.array([t for _, t in found], pa.string()),
                        pa.array([r in template.loss_roles for r, _ in found], pa.bool_()),
                    ],
                    names=["known", "conv", "part", "nr", "role", "text", "loss"],
                )

    return parts.mapInArrow(read, _TURNS)


class _Conversation:
    """Digests of one conversation, fed part by part."""

    def __init__(self, known: bool, conv: int):
        self.key, self.turns, self.chars, self.learned = (known, conv), 0, 0, 0
        self.turns_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, loss: list[dict], template: Template) -> None:
        for role, said in template.parse(text):
            self.turns += 1
            self.turns_sha.update(f"{role}\n{said}\n".encode())
        for span in loss:
            said = template.unescape(text[span["start"] : span["end"]])
            self.learned += len(said)
            self.loss_sha.update(said.encode())
        self.chars += len(text)

    def row(self) -> tuple:
        return (*self.key, self.turns, self.turns_sha.hexdigest(), self.learned, self.loss_sha.hexdigest(), self.chars)


def digests(parts: DataFrame, template: Template = LLAMA) -> DataFrame:
    """A row for each conversation: ``known, conv``, counts and digests of what formatted texts hold.

    Digests of a conversation run over all of it in order, so its parts stream through one
    task, one at a time; conversations in one part are digested where they lie.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(zip(*rows, strict=True), _DIGESTS_ARROW, strict=True)
            return pa.record_batch([pa.array(c, f.type) for c, f in columns], schema=_DIGESTS_ARROW)

        current = None
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("known", "conv", "whole", "text", "loss")}
                key = (row["known"], row["conv"])
                if current and (row["whole"] or current.key != key):
                    rows.append(current.row())
                    current = None
                current = current or _Conversation(*key)
                current.feed(row["text"], row["loss"], template)
            if rows:
                yield batch_of(rows)
        if current:
            yield batch_of([current.row()])

    whole, split = _in_order(parts)
    columns = ["known", "conv", "whole", "text", "loss"]
    return whole.select(columns).unionByName(split.select(columns)).mapInArrow(digest, _DIGESTS)
