from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.llm.text import gram_features, slices, word_hashes, words
from tablesync.llm.tokens import PLAIN, Encoder, tokenizer

TEXTS = ["a bb  a", None, "", " x", "É é y\nA", "zz " * 50, "中文 \U0001f600"]


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text()), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    found = words(pa.array(texts, pa.string()), False)
    names = [w.decode() for w in found.distinct.to_pylist()]
    got = [[] for _ in texts]
    for doc, code in zip(found.doc, found.code):
        got[doc].append(names[code])
    assert got == [plain_words(t) for t in texts]


def test_folding_touches_ascii_only():
    found = words(pa.array(["AbÉ"]), True)
    assert found.distinct.to_pylist() == ["abÉ".encode()]


def test_hashes_and_features_do_not_depend_on_the_batch():
    alone = words(pa.array(["hello"]), False)
    among = words(pa.array(["x", "yy hello", "z"]), False)
    at = among.distinct.to_pylist().index(b"hello")
    assert word_hashes(alone)[0] == word_hashes(among)[at]
    owner, bucket = gram_features(among, (2, 3), 18)
    first = gram_features(alone, (2, 3), 18)[1]
    assert sorted(bucket[owner == at]) == sorted(first)
    assert len(first) == 1 + 6 + 5  # the word, its framed pairs and triples


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "c"], "i": [0, 1, 2, 3]})
    parts = list(slices(batch, "text", 11))
    assert [x for part in parts for x in part.column("i").to_pylist()] == [0, 1, 2, 3]
    assert max(len(part) for part in parts) < 4


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def same_ids(path, texts):
    library = tokenizer(path)
    ids, ends = Encoder(path).batch(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids[ends[i] : ends[i + 1]].tolist() == expected, repr(text)


def test_ids_are_the_library_s(vocabulary):
    same_ids(vocabulary, TEXTS + ["it's  don't  '", "<|endoftext|>x", "\n\n a\t b", "'re're 9's"])


def test_every_plain_character_is_cut_as_the_library_does(vocabulary):
    points = [c for c in range(PLAIN) if not 0xD800 <= c < 0xE000]
    same_ids(vocabulary, [f"a{chr(c)}b1{chr(c)}2 {chr(c)}!{chr(c)}" for c in points])


def test_random_texts_have_the_library_s_ids(vocabulary):
    rng = random.Random(5)
    letters = "ab1'strvelmd  \n\t!. é 　-中ª٣"
    same_ids(vocabulary, ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(5000)])


def test_a_full_memory_of_pieces_starts_anew(vocabulary):
    library, encoder = tokenizer(vocabulary), Encoder(vocabulary, room=3)
    for text in ("a b c d e", "f g a", "a b"):
        ids, _ = encoder.batch(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert np.all(encoder.sizes >= 1)
