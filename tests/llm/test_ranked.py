from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tablesync.llm import ranked
from tablesync.llm.ranked import DocumentTree, ItemTree, rank_documents, surviving


def terms(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", folded)


def brute(documents, items, k):
    bags = [(i, Counter(terms(t))) for i, t in documents]
    bags = [(i, bag) for i, bag in bags if bag]
    total = sum(sum(bag.values()) for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    out = []
    for item, text in items:
        scored = []
        for i, bag in bags:
            m = 50 + 50 * sum(bag.values()) * len(bags) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1)))
                * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
                for t in set(terms(text)) if bag[t]
            )
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=str)


def found(documents, items, k):
    return sorted((tuple(r) for r in rank_documents(documents, items, k).collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    """Leaves, nodes and hierarchies of a few members, and a sample that thresholds begin with."""
    for name, value in {"ITEMS": 2, "LEAF": 3, "FAN": 2, "GROUP": 40, "TREE": 30, "FIRST": 30}.items():
        monkeypatch.setattr(ranked, name, value)


def corpus(seed, documents=160, items=24):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(40)] + ["été", "中文", "x_y", "a-b"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(i, text(rng.randint(0, 40))) for i in range(documents)]
    docs += [(7, docs[7][1]), (None, docs[3][1]), (None, docs[3][1]), (900, None), (901, " .. ")]
    asked = [(i, text(rng.randint(1, 12))) for i in range(items)]
    return docs, asked + [(5, asked[5][1]), (None, "w1 w2"), (800, None), (801, "--"), (802, "unseen")]


@pytest.mark.parametrize("seed, block", [(1, 1 << 20), (2, 40)])
def test_against_all_pairs(rows, small, monkeypatch, seed, block):
    """Blocks of items, many small hierarchies, repeated rows, ties: exact all the same."""
    monkeypatch.setattr(ranked, "BLOCK", block)
    docs, asked = corpus(seed)
    frame = rows("doc_id long, text string", *docs).repartition(3)
    items = rows("item_id int, text string", *asked)
    assert found(frame, items, 5) == brute(docs, asked, 5)


def test_production_sizes(documents, spark):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    assert found(documents, items, 50) == brute(docs, asked, 50)


def test_awkward_rows(odd, clashing, rows):
    items = rows("item_id int, text string", (1, "two FOUR"), (2, None), (3, "é中"), (4, "one"))
    plain = [(r.doc_id, r.text) for r in odd.collect()]
    wanted = brute(plain, [tuple(r) for r in items.collect()], 50)
    assert found(odd, items, 50) == wanted == found(clashing, items, 50)
    for docs, asked in ((odd.limit(0), items), (odd, items.limit(0)), (odd, items.where("item_id = 2"))):
        empty = rank_documents(docs, asked)
        assert empty.count() == 0
        assert empty.dtypes == [
            ("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint"),
        ]


def test_an_item_of_very_many_terms_is_exact(rows):
    """Sums beyond the exact range of doubles are made in integers."""
    tree = ItemTree([(0, np.arange(400_000))], np.full(400_000, 30_000))
    assert tree.kind is np.int64
    assert ItemTree([(0, np.arange(400))], np.full(400, 30_000)).kind is np.float64


def test_bounds_hold(small):
    """No pair that reaches its item's threshold is pruned, and some others are."""
    rng = np.random.default_rng(4)
    weight = rng.integers(1, 9, 60) * np.where(np.arange(60) % 20 == 0, 100, 1)
    items = ItemTree([(i, np.unique(rng.integers(0, 60, 4))) for i in range(30)], weight)
    dense = np.where(rng.random((90, 60)) < 0.05, rng.integers(1, 100, (90, 60)), 0)
    row, column = np.nonzero(dense)
    impact = dense[row, column].astype(np.int64)
    column = np.searchsorted(items.terms, column)[np.isin(column, items.terms)]
    held = np.isin(np.nonzero(dense)[1], items.terms)
    docs = DocumentTree(
        row[held], column, impact[held], weight[items.terms], 90, len(items.terms), items.kind
    )
    scores = items.holds @ np.concatenate([docs.leaf(i) for i in range(30)]).T
    least = np.sort(scores, axis=1)[:, -3]
    q, d = surviving(items, docs, least)
    open_ = {(int(a), int(b)) for a, b in zip(q, d)}
    leaf_of = np.repeat(np.arange(len(items.spans[-1]) - 1), np.diff(items.spans[-1]))
    for i, j in zip(*np.nonzero((scores >= least[:, None]) & (scores > 0))):
        assert (leaf_of[i], j // 3) in open_
    assert len(open_) < (len(items.spans[-1]) - 1) * 30
