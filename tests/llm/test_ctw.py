from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablesync.llm import ctw


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", fold(text)) + [None]


def line(text):
    return b"".join(w.encode() + b" " for w in tokens(text)[:-1]) + b"\xff"


def brute_force(train, test, depth):
    """Context-tree weighting node by node, for natural logs of one text."""
    counts: dict = {}
    for text in train:
        data = b"\xfe" * depth + line(text)
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                context = data[i - d : i]
                for bit in range(8):
                    node = (context, data[i] >> (8 - bit), bit)
                    counts.setdefault(node, [0, 0])[data[i] >> (7 - bit) & 1] += 1
    children: dict = {}
    for context, prefix, bit in counts:
        if context:
            children.setdefault((context[1:], prefix, bit), []).append((context, prefix, bit))

    def own(node):
        zero, one = counts[node]
        lg = math.lgamma
        return lg(zero + 0.5) + lg(one + 0.5) - lg(zero + one + 1) - math.log(math.pi)

    mixed: dict = {}
    for node in sorted(counts, key=lambda n: -len(n[0])):
        if len(node[0]) == depth:
            mixed[node] = own(node)
        else:
            below = sum(mixed[c] for c in children[node])
            mixed[node] = np.logaddexp(own(node), below) - math.log(2)

    def chance(context, prefix, bit, value, d):
        node = (context[depth - d :], prefix, bit)
        if node not in counts:
            return 0.5
        zero, one = counts[node]
        kt = ((one if value else zero) + 0.5) / (zero + one + 1)
        if d == depth:
            return kt
        share = math.exp(own(node) - math.log(2) - mixed[node])
        return share * kt + (1 - share) * chance(context, prefix, bit, value, d + 1)

    data, total = b"\xfe" * depth + line(test), 0.0
    for i in range(depth, len(data)):
        for bit in range(8):
            value = data[i] >> (7 - bit) & 1
            total += math.log(chance(data[i - depth : i], data[i] >> (8 - bit), bit, value, 0))
    return total


TEXTS = ["the cat sat on the mat", "The dog sat", "", None, "été the cat", "zz zz", "a the"]


def test_scores_match_a_tree_walked_node_by_node(rows):
    frame = rows("doc_id long, text string", *enumerate(TEXTS))
    found = ctw.score_texts(frame, F.col("doc_id") < 4, depth=3, block_chars=20)
    got = {r.doc_id: r.score for r in found.collect()}
    for i, text in enumerate(TEXTS):
        expected = brute_force(TEXTS[:4], text, 3) / math.log(10)
        assert got[i] == pytest.approx(expected, rel=1e-9)


def test_bytes_after_a_context_add_up_to_one():
    keys, _ = ctw.stream(pa.array(["the cat sat on the mat"] * 5), 2)
    u, n = np.unique(keys, return_counts=True)
    trees = ctw.forest(u, n.astype(np.int64), 2, 0)
    for context in (int(u[3]) >> 8, 0x7A7A):
        every = np.array([context << 8 | x for x in range(256)], np.uint64)
        assert np.exp(ctw.predict(every, trees)).sum() == pytest.approx(1)


@pytest.mark.parametrize("depth", [2, 5, 7])
def test_streams_hold_words_spaces_and_ends(depth):
    texts = ["", None, "Ab", " Ab  c\n", "x y", "\t", "é"]
    keys, doc = ctw.stream(pa.array(texts), depth)
    for i, text in enumerate(texts):
        data = b"\xfe" * depth + line(text)
        expected = [int.from_bytes(data[j : j + depth + 1], "big") for j in range(len(data) - depth)]
        assert keys[doc == i].tolist() == expected


def test_large_counts_use_the_series():
    n = np.array([0, 1, 10, 4096, 4097, 10**6])
    got = ctw._log_rising(n)
    for i, value in enumerate(n):
        assert got[i] == pytest.approx(math.lgamma(value + 0.5) - math.lgamma(0.5), abs=1e-6)
        assert ctw._log_factorial(n)[i] == pytest.approx(math.lgamma(value + 1), abs=1e-6)


def test_the_base_is_exact(documents):
    found = {r.doc_id: r for r in ctw.score_documents(documents).collect()}
    own = {r.doc_id: tokens(r.text) for r in documents.collect()}
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(t for i, ts in own.items() if not out(i) for t in ts)
    n, v = sum(counts.values()), len(counts)
    for i, ts in own.items():
        row = found[i]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        assert row.held_out == out(i) and row.train_tokens == n
        assert (row.n_tokens, row.n_known) == (len(ts), sum(counts[t] > 0 for t in ts))
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score < 0 and row.bits_per_byte > 0


def test_awkward_rows(odd, clashing):
    found = ctw.score_documents(odd)
    assert found.count() == odd.count()
    same = {(r.score, r.n_tokens) for r in found.where("doc_id IN (1, 2, 3)").collect()}
    assert len(same) == 1
    assert ctw.score_documents(clashing).count() == odd.count()
    assert ctw.score_documents(odd.limit(0)).count() == 0


def test_nothing_to_learn_from(odd):
    for row in ctw.score_texts(odd.select("doc_id", "text"), F.lit(False)).collect():
        assert row.score == pytest.approx(-8 * row.n_bytes * math.log10(2))
        assert row.n_known == row.train_tokens == 0


def test_many_blocks_give_what_one_gives(documents):
    learned = F.col("doc_id") % 2 == 0
    few = documents.select("doc_id", "text").limit(60)
    one = {r.doc_id: r.score for r in ctw.score_texts(few, learned).collect()}
    many = {r.doc_id: r.score for r in ctw.score_texts(few, learned, block_chars=9000).collect()}
    assert many == pytest.approx(one)


@pytest.mark.parametrize("spread", [True, False])
def test_lookup_finds_every_string(spread):
    """Also where more strings share their upper bits than are tried one by one."""
    numbers = np.arange(1, 70_000, dtype=np.uint64)
    undo = np.uint64(pow(int(ctw._SPREAD), -1, 1 << 64))
    keys = numbers << np.uint64(16) if spread else numbers * undo
    lookup = ctw.Lookup(keys, numbers * 0.5)
    order = np.random.default_rng(3).permutation(len(keys))
    asked = np.concatenate([order, order[:100]])
    assert (lookup(keys[asked]) == numbers[asked] * 0.5).all()
    assert not len(ctw.Lookup(keys[:0], numbers[:0] * 0.5)(keys[:0]))
