from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tablesync.llm import induced, suffixes
from tablesync.llm.suffixes import cut_repeats, gram_hashes, pieces_of


def brute(rows, length):
    """Every string of every text, in the order in which it begins."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        data = (rows[i][1] or "").encode()
        covered = [False] * len(data)
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                covered[k : k + length] = [True] * length
            seen.add(window)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(c and not (j and covered[j - 1]) for j, c in enumerate(covered))
        digest = hashlib.sha256(kept).hexdigest()
        out.append((rows[i][0], len(data), sum(covered), spans, digest))
    return sorted(out, key=str)


def found(frame, **kwargs):
    return sorted((tuple(row) for row in cut_repeats(frame, **kwargs).collect()), key=str)


@pytest.mark.parametrize("crowd, alphabet", [(2048, "abcé "), (3, "abcé "), (1, "ab")])
def test_against_every_string(rows, monkeypatch, crowd, alphabet):
    """Crowded anchors are dealt anew; the result is that of comparing all strings."""
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rng = random.Random(crowd)
    parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 60))) for _ in range(8)]
    texts = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for i in range(50)]
    texts += [
        (61, None), (62, ""), (None, parts[0] * 2), (None, parts[0] * 2), (3, parts[1] + parts[2]),
        (64, "a" * 300), (65, "ab" * 200), (66, parts[0] * 2), (66, parts[0] * 2),
    ]
    frame = rows("doc_id long, text string", *texts).coalesce(1)
    assert found(frame, length=12, gram=4) == brute(texts, 12)


def test_production_length(rows):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(60))
    texts = [(i, " ".join(word() for _ in range(40)) + (passage if i % 3 else "")) for i in range(20)]
    texts.append((99, texts[1][1] * 40))  # a long text that repeats itself
    got = found(rows("doc_id long, text string", *texts))
    assert got == brute(texts, 100)
    assert {row[0]: row[3] for row in got}[2] == 1


def test_awkward_rows(odd, clashing):
    wanted = brute([(r.doc_id, r.text) for r in odd.coalesce(1).collect()], 100)
    assert found(odd.coalesce(1)) == wanted
    assert found(clashing.coalesce(1)) == wanted
    empty = cut_repeats(odd.limit(0))
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_a_hot_passage_in_a_third_of_the_rows(rows, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", 20)
    line = "the very same line of words that a third of all rows hold, " * 3
    texts = [(i, f"{i} before {i * 7} " + (line if i % 3 == 0 else "") + f"{i * 11} after") for i in range(240)]
    assert found(rows("doc_id long, text string", *texts)) == brute(texts, 100)


def test_equal_windows_have_equal_anchors():
    data = np.frombuffer(random.Random(2).randbytes(600) * 2, np.uint8)
    start, windows, anchor, key = pieces_of(data, np.array([0, 600, 1200]), 50, 8)
    own = {}
    for s, w, a, k in zip(start.tolist(), windows.tolist(), anchor.tolist(), key.tolist()):
        for at in range(s, s + w):
            assert at + 50 <= (600 if at < 600 else 1200) and at <= a <= at + 42
            own.setdefault(at % 600, set()).add((a % 600, k))
    assert len(own) == 551 and all(len(found) == 1 for found in own.values())
    assert gram_hashes(data[:5], 8).size == 0


def plain_order(symbols, most):
    text = symbols.tolist()
    order = sorted(range(len(text)), key=lambda i: text[i:])
    shared = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n] and n < most:
            n += 1
        shared.append(n)
    return order, shared


@pytest.mark.parametrize("batch, room, memory", [(1 << 18, 1 << 22, 1 << 30), (7, 5, 0), (4, 100, 600)])
def test_induced_sorting(tmp_path, monkeypatch, batch, room, memory):
    """Places and common prefixes, with queues and arrays in memory and in files."""
    monkeypatch.setattr(induced, "BATCH", batch)
    monkeypatch.setattr(induced.Queue.__init__, "__defaults__", (room,))
    rng = np.random.default_rng(batch)
    for trial in range(40):
        n, kinds = int(rng.integers(1, 140)), int(rng.integers(1, 6))
        part = rng.integers(1, kinds + 1, n if trial % 2 else max(1, n // 6))
        symbols = np.append(part if trial % 2 else np.tile(part, 6), 0).astype(np.uint16)
        folder = tmp_path / f"{trial}"
        folder.mkdir()
        files = induced.Files(str(folder), memory)
        text = np.append(symbols, np.zeros(24, np.uint16))
        got = list(induced.sorted_suffixes(text, 20, files))
        place, value = (np.concatenate([pair[i] for pair in got]).tolist() for i in (0, 1))
        assert (place, value) == plain_order(symbols, 20)
        assert not list(folder.iterdir()) or memory


def test_files_go(tmp_path):
    files = induced.Files(str(tmp_path), 100)
    inside, outside = files.array(50, np.uint8), files.array(100, np.uint8)
    assert len(list(tmp_path.iterdir())) == 1
    outside[:] = 7
    files.drop(inside, outside)
    assert not list(tmp_path.iterdir()) and not files.held
    grown = induced.Growing(files, np.int64, 50)
    for i in range(10):
        grown.add(np.arange(i))
    assert grown.finish().tolist() == [k for i in range(10) for k in range(i)]
