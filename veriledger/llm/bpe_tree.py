"""Byte-pair encoding by a segment tree over the ranks of adjacent pairs, and decoding.

Each leaf of a word's tree holds the merge rank of one adjacent pair and its position; the
root is the lowest rank and, among equal ranks, the leftmost pair.  A merge updates three
leaves and their ancestors, until the root says that nothing can be merged.  The trees of
many words are advanced together as rows of numpy arrays.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.llm.common import bounded_batches, kept, release

NOTHING = np.iinfo(np.int64).max
STRETCHES = 400_000  # remembered by a worker, some 200 bytes each
_ROW = "doc_id bigint, ids array<int>, decoded string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
# Letters whose lower case came with Unicode 16 and 17, which Python's tables may lack.
LATER_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
_LATER = re.compile("[" + "".join(map(chr, LATER_LOWER)) + "]")
# Characters that Python's split() takes for blanks and Unicode's White_Space does not.
_NOT_BLANK = re.compile("[\x1c-\x1f]")
_BLANK = regex.compile(r"\p{White_Space}+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


def lowered(text: str) -> str:
    """Lower case letter by letter: the form of a sigma does not depend on its place."""
    if text.isascii():
        return text.lower()
    if _LATER.search(text):
        text = text.translate(LATER_LOWER)
    return "".join(c.lower() for c in text) if "\u03a3" in text else text.lower()


class Merges:
    """Rank and result of each mergeable pair of ids, looked up for whole arrays."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], size: int):
        self.size = size
        keys = np.array([a * size + b for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], NOTHING)
        ranks = np.array([r for r, _ in pairs.values()], dtype=np.int64)
        self.ranks = np.append(ranks[order], 0)
        self.results = np.zeros(int(ranks.max(initial=-1)) + 1, dtype=np.int32)
        for rank, result in pairs.values():
            self.results[rank] = result

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or NOTHING."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NOTHING)


class PairTrees:
    """Segment trees of words of up to ``width`` symbols (a power of two), one word a row.

    Node 1 of a row is the root, node ``width + p`` the leaf of the pair that starts at
    position ``p``.  A leaf holds ``rank * width + p``.
    """

    def __init__(self, words: list[list[int]], width: int, merges: Merges):
        self.width, self.merges = width, merges
        rows = len(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=rows)
        places = np.arange(width)
        self.alive = places < lengths[:, None]
        self.symbols = np.zeros((rows, width), dtype=np.int32)
        self.symbols[self.alive] = np.fromiter(chain.from_iterable(words), dtype=np.int32)
        # One place more than the word has, so that an end needs no case of its own.
        self.after = np.broadcast_to(places + 1, (rows, width)).copy()
        self.after[places + 1 >= lengths[:, None]] = width
        self.before = np.broadcast_to(places - 1, (rows, width)).copy()
        self.tree = np.full((rows, 2 * width), NOTHING, dtype=np.int64)
        has_pair = self.after < width
        at = np.nonzero(has_pair)
        self.tree[at[0], width + at[1]] = self._keys(at[0], at[1])
        level = width // 2
        while level:
            below = self.tree[:, 2 * level : 4 * level]
            self.tree[:, level : 2 * level] = np.minimum(below[:, ::2], below[:, 1::2])
            level //= 2

    def _keys(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The leaf values of the pairs that start at some places, which have a right neighbour."""
        ranks = self.merges.rank(self.symbols[rows, places], self.symbols[rows, self.after[rows, places]])
        return np.where(ranks == NOTHING, NOTHING, ranks * self.width + places)

    def _update(self, rows: np.ndarray, places: np.ndarray) -> None:
        """New leaf values at some places, then the minima on the way to the root."""
        keys = np.full(len(rows), NOTHING, dtype=np.int64)
        pair = np.flatnonzero(self.alive[rows, places] & (self.after[rows, places] < self.width))
        keys[pair] = self._keys(rows[pair], places[pair])
        node = self.width + places
        self.tree[rows, node] = keys
        while node.size and node[0] > 1:
            node = node >> 1
            self.tree[rows, node] = np.minimum(self.tree[rows, 2 * node], self.tree[rows, 2 * node + 1])

    def run(self) -> list[bytes]:
        """Merge until no pair can be merged; the ids of each word as 32-bit numbers."""
        rows = np.arange(len(self.tree))
        while len(rows := rows[self.tree[rows, 1] < NOTHING]):
            rank, left = np.divmod(self.tree[rows, 1], self.width)
            right = self.after[rows, left]
            beyond = self.after[rows, right]
            self.symbols[rows, left] = self.merges.results[rank]
            self.alive[rows, right] = False
            self.after[rows, left] = beyond
            inner = beyond < self.width
            self.before[rows[inner], beyond[inner]] = left[inner]
            self._update(rows, right)
            self._update(rows, left)
            has_left = np.flatnonzero(self.before[rows, left] >= 0)
            self._update(rows[has_left], self.before[rows, left][has_left])
        ids = self.symbols[self.alive].tobytes()
        ends = (4 * np.cumsum(self.alive.sum(axis=1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class WordBpe:
    """A tokenizer file of the word-end kind: lower-cased words, bytes, merges.

    Encodes stretch by stretch between blanks, and remembers at most ``memory`` stretches, or those of
    one call; where there are more, only those stay that the call in hand asks for.
    """

    def __init__(self, spec: str, memory: int = STRETCHES):
        data = json.loads(spec)
        model = data["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.added = {token: np.int32(number).tobytes() for token, number in added.items()}
        self.tokens = [""] * (1 + max([*vocab.values(), *added.values()]))
        for token, number in chain(vocab.items(), added.items()):
            self.tokens[number] = token
        names = byte_characters()
        self.inner = [vocab[c] for c in names]
        self.last = [vocab[c + end] for c in names]
        pairs = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            pairs[vocab[left], vocab[right]] = rank, vocab[left + right]
        self.merges = Merges(pairs, len(self.tokens))
        pattern = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(pattern)
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        self.memory = memory
        self.known: dict[str, bytes] = {}

    def stretches(self, text: str) -> list[str]:
        """What stands between blanks.  No word crosses a blank, before or after normalisation."""
        if _NOT_BLANK.search(text):
            return [s for s in _BLANK.split(text) if s]
        return text.split()

    def _words(self, stretch: str) -> list[str | bytes]:
        """The words of a stretch in order; a special token as its id."""
        if not self.special.search(stretch):
            if stretch.isascii():  # which NFC leaves as it is
                return self.word.findall(stretch.lower())
            return self.word.findall(lowered(unicodedata.normalize("NFC", stretch)))
        found: list[str | bytes] = []
        for piece in self.special.split(stretch):
            found += [self.added[piece]] if piece in self.added else self._words(piece)
        return found

    def _merged(self, words: list[str]) -> dict[str, bytes]:
        """The ids of some words, those of like length together."""
        by_width: dict[int, list[str]] = {}
        for word in words:
            by_width.setdefault(1 << max(1, (len(word.encode()) - 1).bit_length()), []).append(word)
        found = {}
        for width, some in by_width.items():
            step = max(1, (1 << 18) // width)  # bounds the arrays, whatever the length of a word
            for i in range(0, len(some), step):
                part = some[i : i + step]
                symbols = []
                for word in part:
                    code = word.encode()
                    symbols.append([self.inner[b] for b in code[:-1]] + [self.last[code[-1]]])
                found.update(zip(part, PairTrees(symbols, width, self.merges).run(), strict=True))
        return found

    def learn(self, stretches: set[str]) -> None:
        """Make sure that these stretches are known."""
        new = [s for s in stretches if s not in self.known]
        if len(self.known) + len(new) > self.memory:
            self.known = {s: self.known[s] for s in stretches.difference(new)}
        parts = [self._words(s) for s in new]
        words = self._merged([w for w in dict.fromkeys(chain.from_iterable(parts)) if isinstance(w, str)])
        words.update((b, b) for b in self.added.values())
        for stretch, part in zip(new, parts, strict=True):
            self.known[stretch] = words[part[0]] if len(part) == 1 else b"".join(map(words.__getitem__, part))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.stretches(t) for t in texts]
        self.learn(set(chain.from_iterable(split)))
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, s)), dtype=np.int32) for s in split]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by one space, as a file without a decoder asks for."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def _loaded(spec: str, memory: int = STRETCHES) -> WordBpe:
    return kept(("bpe", hash(spec), memory), lambda: WordBpe(spec, memory))


def _slices(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters, one text at least."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_and_decode(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", slice_chars: int = 500_000,
    keep: tuple[str, ...] = (), memory: int = STRETCHES,
) -> DataFrame:
    """``doc_id, ids, decoded`` for every row: the ids of the whole text, and what they decode to.

    The columns named in ``keep`` come after these as they are; their names differ from these.

    ``tokenizer`` is the path of a tokenizer file of bounded size, read on the driver and
    broadcast.  There is no shuffle; a task holds one Arrow batch and its encoding, and its
    worker remembers ``memory`` stretches between blanks, which only saves time.  A text is read whole however long it is, a word too.  Null texts count as empty and have no
    ids; repeated rows are encoded each; an empty table gives an empty one.  Other columns
    are ignored, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec.value, memory)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, end in _slices(texts, slice_chars):
                ids = bpe.encode(texts[start:end])
                flat = np.concatenate(ids)
                ends = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=ends[1:])
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(start, end - start),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        pa.array([bpe.decode(x) for x in ids], pa.string()),
                        *(batch.column(name).slice(start, end - start) for name in keep),
                    ],
                    names=[*_ARROW.names, *keep],
                )
        release()

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *keep
    )
    kept = dict(rows.dtypes)
    return rows.mapInArrow(encode, ", ".join([_ROW, *(f"{name} {kept[name]}" for name in keep)]))
