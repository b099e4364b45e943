from __future__ import annotations

import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tablesync.llm import bagminhash as bag
from tablesync.llm import graph
from tablesync.llm.graph import components
from tablesync.llm.text import mix


def shingle_bag(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found]
    if not found:
        return Counter()
    return Counter(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def similarity(a, b):
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def expected_groups(rows, least=0.8):
    bags = {i: shingle_bag(t) for i, t in rows}
    holders = defaultdict(set)
    for i, own in bags.items():
        for one in own:
            holders[one].add(i)
    group = {i: i for i in bags}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    for a, b in sorted(pairs):
        if similarity(bags[a], bags[b]) >= least:
            x, y = root(a), root(b)
            group[max(x, y)] = min(x, y)
    return {i: root(i) for i in bags}


@pytest.mark.parametrize("most", [1, 3, 40])
def test_registers_agree_as_often_as_bags_overlap(most):
    rng = np.random.default_rng(most)
    a = {i: int(rng.integers(1, most + 1)) for i in range(60)}
    b = {i: int(rng.integers(1, most + 1)) for i in range(20, 80)}

    def registers(weights):
        keys = np.array(sorted(weights), np.uint64)
        counts = np.array([weights[int(k)] for k in keys])
        return bag.signatures(np.zeros(len(keys), int), mix(keys), counts, 1, 6000)[0]

    every = set(a) | set(b)
    truth = sum(min(a.get(i, 0), b.get(i, 0)) for i in every)
    truth /= sum(max(a.get(i, 0), b.get(i, 0)) for i in every)
    assert abs((registers(a) == registers(b)).mean() - truth) < 0.03


def test_shingles_are_bags_of_five_words():
    texts = ["a b c d e f", "A b", None, "", "x x x x x x x", "a b c d e f a b c d e f"]
    doc, key, count = bag.shingles(pa.array(texts))
    for i, text in enumerate(texts):
        assert sorted(count[doc == i]) == sorted(shingle_bag(text).values())
    assert set(key[doc == 0]) < set(key[doc == 5])


def test_groups_of_the_given_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in bag.group_near_copies(documents).collect()}
    expected = expected_groups(rows)
    assert {i: r.group_id for i, r in found.items()} == expected
    assert all(r.kept == (r.group_id == i) for i, r in found.items())


def test_a_large_group_of_near_copies_is_one(rows):
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base)]
    for i in range(150):  # each replaces one word of its own, so pairs stay above 0.8
        own = list(base)
        own[i % 120] = f"x{i}"
        texts.append(" ".join(own))
    texts += ["nothing like it " + str(i) for i in range(5)]
    frame = rows("doc_id long, text string", *enumerate(texts))
    found = bag.group_near_copies(frame, pairwise=4).collect()
    groups = Counter(r.group_id for r in found)
    assert groups[0] == 151 and len(groups) == 6
    assert sum(r.kept for r in found) == 6


def with_two_replaced(base, rng, number):
    own = list(base)
    for place in rng.choice(len(base) // 2 - 4, 2, replace=False):
        own[2 + 2 * place] = f"x{number}y{place}"
    return own


def counted_links(rows, least=0.8):
    bags = {i: shingle_bag(t) for i, t in rows}
    return {i: sum(similarity(own, bags[j]) >= least for j in bags if j != i) for i, own in bags.items()}


@pytest.mark.parametrize("chunk", [bag.CHUNK, 4000])
def test_a_hub_joins_what_is_not_alike(rows, monkeypatch, chunk):
    """Variants are like the base only, which is no leader of most bands."""
    monkeypatch.setattr(bag, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(with_two_replaced(base, rng, i)) for i in range(150)]
    texts.insert(70, " ".join(base))
    texts += [" ".join(base[:n]) for n in (40, 85, 100, 110)]  # lengths of other classes
    data = list(enumerate(texts))
    found = bag.group_near_copies(rows("doc_id long, text string", *data)).collect()
    assert {r.doc_id: r.group_id for r in found} == expected_groups(data)
    assert {r.doc_id: r.n_links for r in found} == counted_links(data)
    kept = bag.drop_near_copies(rows("doc_id long, text string", *data)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in found if r.kept)


def test_a_pair_among_thousands_that_are_half_alike(rows):
    """All share much of a form; one pair is alike."""
    rng = np.random.default_rng(6)
    form = [f"w{i}" for i in range(120)]

    def filled(number):  # 13 shingles or more go with each block of words
        own = list(form)
        for place in rng.choice(8, 2, replace=False):
            own[place * 15 + 3 : place * 15 + 12] = [f"x{number}y{place}z{i}" for i in range(9)]
        return own

    texts = [filled(i) for i in range(2500)]
    pair = list(texts[1234])
    pair[0] = "other"
    texts.append(pair)
    data = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = bag.group_near_copies(rows("doc_id long, text string", *data)).collect()
    linked = {r.doc_id: r.group_id for r in found if r.n_links}
    assert linked == {1234: 1234, 2500: 1234}


@pytest.mark.parametrize("split", [0, 7])
def test_pairs_of_a_block_are_those_of_the_bags(split):
    rng = np.random.default_rng(split)
    texts = [" ".join(f"v{x}" for x in rng.integers(0, 2, rng.integers(1, 8))) for _ in range(90)]
    doc, key, count = bag.shingles(pa.array(texts))
    packed = [
        key[doc == i].tobytes() + count[doc == i].astype(np.uint32).tobytes() for i in range(90)
    ]
    left, right = (packed[:split], packed[split:]) if split else (packed, None)
    i, j = bag.similar(left, right, 0.4)
    every = {(x, y) for x in range(90) for y in range(x + 1, 90) if not split or x < split <= y}
    wanted = {(x, y) for x, y in every if bag.overlap(packed[x], packed[y]) >= 0.4}
    assert set(zip(i.tolist(), (j + split).tolist())) == wanted and len(i) == len(wanted) > 10


def test_multiplicity_counts(rows):
    one = "a b c d e f g h"
    frame = rows("doc_id long, text string", (1, one), (2, " ".join([one] * 6)), (3, one.upper()))
    found = {r.doc_id: r.group_id for r in bag.group_near_copies(frame).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


def test_awkward_rows(odd, clashing):
    found = bag.group_near_copies(odd).collect()
    assert len(found) == odd.count()
    group = {r.doc_id: r.group_id for r in found}
    assert group == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, None: None, 6: 6, 7: 7}
    kept = bag.drop_near_copies(clashing)
    assert kept.schema == clashing.schema
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7]
    assert bag.group_near_copies(odd.limit(0)).count() == 0
    assert bag.drop_near_copies(odd.limit(0)).count() == 0


def test_one_id_with_two_texts(rows):
    frame = rows("doc_id long, text string", (1, "a b c"), (2, "x y z"), (2, "a b c"))
    kept = sorted((r.doc_id, r.text) for r in bag.drop_near_copies(frame).collect())
    assert kept == [(1, "a b c"), (2, "x y z")]


def test_components_end_with_the_first_stars(monkeypatch, rows):
    """Groups whose texts are all linked are stars after one round, and no other is made."""
    written, stash = [], graph.stash
    monkeypatch.setattr(graph, "stash", lambda frame, label: written.append(label) or stash(frame, label))
    links = [(base + i, base + j) for base in (0, 10, 20) for i in range(4) for j in range(i)]
    found = {r.node: r.component for r in components(rows("a long, b long", *links)).collect()}
    assert found == {base + i: base for base in (0, 10, 20) for i in range(4)}
    assert len(written) == 3  # the links, and both halves of a round


def test_components_of_chains_stars_and_rings(rows):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)]
    links += [(200, 201), (201, 202), (202, 200), (5, 5), (201, 200)]
    frame = rows("a long, b long", *links)
    found = {r.node: r.component for r in components(frame).collect()}
    assert found == {
        **{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 120)},
        **{i: 200 for i in range(200, 203)},
    }
    assert components(frame.limit(0)).count() == 0


def test_shingles_are_held_for_a_small_part_of_a_batch():
    """Arrays for a batch of 8 MB of text stay below 120 MB, and its results are those of its rows."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 5000, 400)) for _ in range(4000)]
    batch = pa.RecordBatch.from_pydict({"key": [str(i) for i in range(4000)], "text": texts})
    for work in (lambda b: bag._signed(b, bag.BANDS, bag.ROWS), bag._packed):
        tracemalloc.start()
        for part in work(batch):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 120e6
        some = [row for part in work(batch) for row in part.to_pylist()]
        for i in (0, 1777, 3999):
            assert [some[i]] == [r for p in work(batch.slice(i, 1)) for r in p.to_pylist()]
