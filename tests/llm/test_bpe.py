"""Encoding against the library itself."""

import gc
import hashlib
import random
import weakref

import public_tokenizers
import pytest
from samples import ODD, SF, documents, prose
from tokenizers import Tokenizer

from veriledger.llm import bpe_tree, queries, superminhash, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return bpe_tree.WordBpe(file.read(), memory=50)


def test_every_document(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op5_bpe_segment_tree(spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_documents(spark, library):
    frame = documents(spark, ODD, ["ids", "decoded"])
    found = bpe_tree.encode_and_decode(frame, PATH, slice_chars=100).collect()
    want = []
    for i, t in ODD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted([(r.doc_id, r.ids, r.decoded) for r in found], key=str) == sorted(want, key=str)
    assert bpe_tree.encode_and_decode(documents(spark, []), PATH).collect() == []


def test_random_texts(own, library):
    source = random.Random(3)
    letters = "abcABC 'sStT\t\n\x0b\x1c\x1f\x85\xa0é́Σσςİıßẞ½²Ⅷ١٢中文字日本😀👨‍👩 ​ﬁ각KÅ_-.,!12\x00�ͅ"
    for _ in range(3000):
        text = "".join(source.choices(letters, k=source.randint(0, 16)))
        if source.random() < 0.1:
            text = text[:5] + source.choice(["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>"]) + text[5:]
        ids = own.encode([text])[0]
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert own.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_every_character(own, library):
    for start in range(0, 0x30000, 0x4000):
        texts = [chr(c) for c in range(start, start + 0x4000) if not 0xD800 <= c < 0xE000]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in own.encode(texts)] == want


def test_one_long_word(own, library):
    text = "ab" * 700 + "the" * 300
    assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_still_in_use_are_not_merged_again_once_memory_is_full():
    with open(PATH, encoding="utf-8") as file:
        small = bpe_tree.WordBpe(file.read(), memory=50)
    merged, real = [], small._merged
    small._merged = lambda words: merged.extend(words) or real(words)
    for i in range(20):
        small.encode([" ".join(["common", "words", *(f"rare{chr(97 + i)}{chr(97 + j)}" for j in range(15))])])
    assert merged.count("common") == merged.count("words") == 1
    assert len(small.known) <= 50


def test_a_small_memory_changes_no_result(spark):
    frame = documents(spark, [*ODD, *((100 + i, prose(i, 200)) for i in range(40))])
    few, many = (bpe_tree.encode_and_decode(frame, PATH, slice_chars=500, memory=m).collect() for m in (20, 100_000))
    assert sorted(few, key=str) == sorted(many, key=str)


@pytest.mark.parametrize("task", [toxicity._triples, superminhash._signed(1000)])
def test_a_worker_drops_the_tokenizer_when_another_operator_takes_it(task):
    with open(PATH, encoding="utf-8") as file:
        spec = file.read()
    held = weakref.ref(bpe_tree._loaded(spec))
    assert bpe_tree._loaded(spec) is held()  # kept from task to task of its own
    assert list(task(iter([]))) == []
    gc.collect()
    assert held() is None
