"""Formatted conversations, Merkle manifests and prefix tries against plain models."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from samples import ODD, documents

from veriledger.llm import chat_format, merkle_log, prefix_trie
from veriledger.llm.chat_format import LLAMA

TALK = "conv_id bigint, turn bigint, role string, text string"


def talk(spark, rows, extra=()):
    frame = spark.createDataFrame(rows, TALK)
    for name in extra:
        frame = frame.selectExpr("*", f"'x' as `{name}`")
    return frame


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


NASTY = [
    "</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s> [\\INST]", "[", "[/INST", "]", "<s", "<s><s>[SYS]", "", "  ", "é</s>中😀[ROLE]",
    "\\", "a\\", "[ROLE]x[/ROLE] ", "<", "\n", "[INST]" * 50,
]


def in_order(rows):
    """Turns of each conversation as ``role, text``."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))] for c, turns in found.items()}


def chats(seed, convs=40, most=9):
    source = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "[INST]", "a</s>b\\"]
    rows = []
    for conv in range(-3, convs):
        for turn in range(source.randint(1, most)):
            rows.append((conv, source.choice([turn, turn, None, 1]), source.choice(roles), source.choice([*NASTY, None, "hello"])))
    return rows + rows[:5]


@pytest.mark.parametrize("part_bytes", [1, 300, 8 << 20])
def test_chats_come_back(spark, part_bytes):
    rows = chats(1) + [(None, 0, "user", "no id"), (None, 1, "assistant", "x" * 200_000)]
    frame = talk(spark, rows, ["known", "conv", "part", "loss"]).repartition(5)
    parts = chat_format.formatted(frame, part_bytes=part_bytes)
    want = in_order(rows)
    got = defaultdict(list)
    for r in sorted(chat_format.read_turns(parts).collect(), key=lambda r: (r.part, r.nr)):
        got[r.conv if r.known else None].append((r.role, r.text))
    assert got == want
    digests = {(r.conv if r.known else None): r for r in chat_format.digests(parts).collect()}
    assert set(digests) == set(want)
    for conv, turns in want.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        row = digests[conv]
        assert (row.n_turns, row.turns_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (row.loss_chars, row.loss_sha256) == (len(learned), sha(learned))


def test_formatted_text_and_spans(spark):
    rows = [(1, 0, "system", "be é"), (1, 1, "user", "hi </s>"), (1, 2, "assistant", "[INST] 中"), (1, 3, "tool", "42")]
    (row,) = chat_format.formatted(talk(spark, rows)).collect()
    assert row.text == "[SYS] be é [/SYS]<s>[INST] hi <\\/s> [/INST] [\\INST] 中 </s>[ROLE]tool[/ROLE] 42 </s>"
    assert [row.text[s.start : s.end] for s in row.loss] == ["[\\INST] 中"]
    # No control string of a text is left in the formatted one.
    (row,) = chat_format.formatted(talk(spark, [(1, 0, "user", "".join(NASTY))])).collect()
    assert sum(row.text.count(c) for c in LLAMA.controls) == 3


def test_one_conversation_of_many_turns_is_spread(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn {i} </s>") for i in range(3000)]
    frame = talk(spark, rows).repartition(8)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        parts = chat_format.formatted(frame)
    finally:
        spark.conf.unset(coalesce)
    assert parts.filter("not whole").count() > 4
    (row,) = chat_format.digests(parts).collect()
    assert row.n_turns == 3000 and row.turns_sha256 == sha("".join(f"{r}\n{t}\n" for _, _, r, t in rows))


def test_no_conversations(spark):
    assert chat_format.digests(chat_format.formatted(talk(spark, []))).collect() == []
    assert prefix_trie.prefix_trie(talk(spark, [])).collect() == []


def test_templates_whose_control_strings_may_overlap_are_refused():
    with pytest.raises(ValueError):
        chat_format.Template(controls=("<<SYS>>",))


# --- manifests


def levels_of(digests):
    found = [digests]
    while len(found[-1]) > 1:
        found.append([sha("".join(found[-1][i : i + 2])) for i in range(0, len(found[-1]), 2)])
    return found


def siblings(levels, idx):
    out = []
    for level in levels[:-1]:
        out.append(level[idx ^ 1] if idx ^ 1 < len(level) else "")
        idx >>= 1
    return out


def leaf_of(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def test_places_are_those_of_a_postorder_walk():
    for leaves in range(1, 40):
        sizes = [-(-leaves // (1 << i)) for i in range(merkle_log.height(leaves) + 1)]
        order = []

        def walk(level, idx, sizes=sizes, order=order):
            for child in (2 * idx, 2 * idx + 1) if level else ():
                if child < sizes[level - 1]:
                    walk(level - 1, child)
            order.append((level, idx))

        walk(len(sizes) - 1, 0)
        assert sizes[-1] == 1
        assert [int(merkle_log.position(level, idx, leaves)) for level, idx in order] == list(range(len(order)))


@pytest.mark.parametrize("levels", [1, 2, 3, 12])
def test_manifest(spark, levels):
    source = random.Random(levels)
    rows = [(i, t, source.choice(["a", "b", "é", None, "z"]), "s", len(t or "")) for i, t in ODD]
    rows += [(i, f"text {i % 50}", "a" if i % 3 else source.choice(["b", None, "", "é"]), None, i) for i in range(10, 150)]
    rows += [rows[-1]] * 3 + [(500, "lonely", "one", "s", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4)
    for name in ("row", "tree", "idx", "size", "group", "key", "leaf", "order_0"):
        frame = frame.withColumn(name, F.lit("x"))
    leaf = merkle_log.leaf_digest("doc_id", "source", "lang", "n_chars", "text")
    made = merkle_log.manifest(frame, F.col("lang"), [F.col("doc_id")], leaf, F.struct("doc_id", "lang"), levels)
    trees = defaultdict(list)
    for i, text, lang, origin, n in rows:
        trees[lang].append((i is not None, i or 0, leaf_of(i, origin, lang, n, text)))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    built = {n: levels_of([x[2] for x in sorted(trees[n])]) for n in names}
    over = levels_of([built[n][-1][0] for n in names])
    assert made.root == over[-1][0]
    want = sorted(
        (digest, str(built[n][-1][0]), siblings(built[n], k) + siblings(over, names.index(n)))
        for n in names
        for k, digest in enumerate(built[n][0])
    )
    found = made.proofs().withColumn("folded", made.folded("leaf"))
    got = found.collect()
    assert sorted((r.leaf, r.subroot, r.proof) for r in got) == want
    assert all(r.folded == made.root for r in got)
    broken = found.withColumn("other", F.sha2(F.concat("leaf", F.lit("x")), 256)).select(made.folded("other").alias("f"))
    assert all(r.f != made.root for r in broken.collect())
    # Every node is in the log once, at a place of its own.
    for number, name in enumerate(names, 1):
        log = [r for part in made.rounds for r in part.filter(f"tree = {number}").collect()]
        assert sorted(r.position for r in log) == list(range(sum(map(len, built[name]))))
        assert {(r.level, r.idx): r.digest for r in log} == {
            (a, b): d for a, level in enumerate(built[name]) for b, d in enumerate(level)
        }


def test_manifest_of_nothing_and_of_one(spark):
    leaf = merkle_log.leaf_digest("doc_id", "text")
    made = merkle_log.manifest(documents(spark, []), F.col("lang"), [F.col("doc_id")], leaf, F.struct("doc_id"))
    assert made.root is None and made.proofs().withColumn("f", made.folded("leaf")).collect() == []
    made = merkle_log.manifest(documents(spark, [(1, "one")]), F.col("lang"), [F.col("doc_id")], leaf, F.struct("doc_id"))
    (row,) = made.proofs().withColumn("f", made.folded("leaf")).collect()
    assert row.proof == [] and row.f == made.root == row.leaf == leaf_of(1, "one")


# --- prefix tries


def trie(rows):
    """Nodes by brute force: ``(members' turns): columns``."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", sha(text or ""), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(turns, key=lambda t: (t[0], t[1], t[2].encode(), t[3]))] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        lent = zlib.crc32(str(c).encode()) % 9
        base = c - int(abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:lent] + turns[lent:])
    nodes = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    found = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        childless = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in nodes)]
        saved = sum((len(nodes[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(str(c) for c in sorted(members) if built[c] == node)
        children = sum(len(n) == len(node) + 1 for n in below)
        parent = min(nodes[node[:-1]]) if node else None
        found.append((min(members), len(node), parent, len(members), children, len(childless), saved, sha(ends)))
    return sorted(found, key=str)


def nodes_of(frame, per_block):
    rows = prefix_trie.prefix_trie(frame, per_block).drop("node", "parent").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("per_block", [1, 2, 3, 8])
def test_trie(spark, per_block):
    source = random.Random(per_block)
    rows = [
        (c, source.choice([t, t, t, None]), source.choice(["user", "user", None]), source.choice(["a", "bé", None, ""]))
        for c in range(-6, 40)
        for t in range(source.randint(1, 7))
    ]
    rows += [(100 + c, t, "user", f"same {t}") for c in range(0, 60, 5) for t in range(20)]  # copies, straight for long
    rows += [(300, t, "user", f"same {t}" if t < 17 else "other") for t in range(40)]
    rows += [(None, 0, "user", "no id"), (301, 0, "user", "x" * 100_000)] + rows[:4]
    frame = talk(spark, rows, ["base", "lent", "size", "node", "block"]).repartition(6)
    assert nodes_of(frame, per_block) == trie(rows)


def test_trie_of_turnless_conversations(spark):
    rows = [(1, 0, "user", "x"), (2, 0, "user", "y")]  # both lose their turns to an absent conversation
    assert all(zlib.crc32(str(c).encode()) % 9 > 0 for c in (1, 2))
    assert nodes_of(talk(spark, rows), 8) == [(1, 0, None, 2, 0, 1, 0, sha("1,2"))]
