"""Small inputs and plain models of the contracts."""

from __future__ import annotations

import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def documents(spark, rows, extra=()):
    """Documents from (id, text) or (id, text, source); ``extra`` adds columns of those names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    frame = spark.createDataFrame(full, DOCS)
    for name in extra:
        frame = frame.selectExpr("*", f"'x' as `{name}`")
    return frame


def prose(seed: int, words: int) -> str:
    source = random.Random(seed)
    return " ".join("".join(source.choices("abcdefghij", k=source.randint(2, 7))) for _ in range(words))


def edited(text: str, seed: int, share: float) -> str:
    """The text with about ``share`` of its words replaced."""
    source = random.Random(seed)
    return " ".join(f"w{source.random():.9f}" if source.random() < share else w for w in text.split())


# Cases that every operator on texts must take: null, empty, blank, one word, repeated rows,
# a null id, a very long text, one without blanks, odd characters.
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "same text here"), (5, "same text here"),
    (None, "no id at all"), (None, None), (6, prose(1, 30_000)), (7, "x" * 5_000), (8, "é́ İß Σς\x1c 中文 \x00 <|endoftext|> 😀"),
]


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def shingles(text: str | None) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def components(rows: list[tuple]) -> dict[int, tuple[int, int]]:
    """``id: (set size, smallest id reached)`` by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}
