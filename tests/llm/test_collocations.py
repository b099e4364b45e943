from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablesync.llm import collocations
from tablesync.llm.bitmap import bit_map, contains, keys_of
from tablesync.llm.collocations import Trie, mine_collocations


def brute(rows, least, top, longest=4):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            own = re.findall(r"[^ \t]+", piece)
            words[lang] += len(own)
            for n in range(1, longest + 1):
                for i in range(len(own) - n + 1):
                    counts[lang][tuple(own[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        phrases = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in phrases.items():
            inside = [
                b for q, b in phrases.items() if len(q) > len(p)
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * b >= 80 * a for b in inside):
                continue
            cuts = [(2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows_.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], score))
        for rank, (_, _, phrase, a, l, r, score) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, l, r, words[lang], score))
    return sorted(out)


def found(frame, least, top):
    return sorted(tuple(row) for row in mine_collocations(frame, least, top=top).collect())


def corpus(seed, size=260):
    rng = random.Random(seed)
    vocabulary = ["Aa", "bé", "cc", "D9", "e-f", "中", "\x00g"]
    texts = []
    for i in range(size):
        words = [rng.choice(vocabulary[: 2 + i % 6]) for _ in range(rng.randint(0, 18))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ",x "]) for w in words)
        texts.append((rng.choice(["en", "fr", None, "und"]), text))
    return texts + [("en", None), (None, None), ("en", ""), ("de", "a b " * 500), ("en", "q r s t " * 40)]


@pytest.mark.parametrize("seed, block, top", [(1, 1 << 20, 50), (2, 40, 7), (3, 200, 2000)])
def test_against_a_plain_count(rows, monkeypatch, seed, block, top):
    """One trie or many; ties at the end of a language's rows are by the phrase's bytes."""
    monkeypatch.setattr(collocations, "BLOCK", block)
    texts = corpus(seed)
    frame = rows("lang string, text string", *texts).repartition(3)
    assert found(frame, 6, top) == brute(texts, 6, top)


def test_awkward_rows(odd, clashing, rows):
    plain = [(r.lang, r.text) for r in odd.collect()]
    assert found(odd, 2, 100) == brute(plain, 2, 100) == found(clashing, 2, 100)
    empty = mine_collocations(odd.limit(0))
    assert empty.count() == 0
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found(rows("lang string, text string", ("en", "one two")), 30, 10) == []


def encoded_texts(spark, texts):
    """Texts of single letters as three rows each, like those of as many tasks."""
    rows = []
    for text in texts:
        symbols = np.unique([ord(word) for word in text.split()]).astype(np.uint64)
        stream = np.append(0, np.searchsorted(symbols, [ord(w) for w in text.split()]) + 1)
        rows += [(symbols.tobytes(), stream.astype(np.int32).tobytes())] * 3
    return spark.createDataFrame(rows, "symbols binary, stream binary").repartition(4)


@pytest.mark.parametrize("share", [1 << 20, 2])
def test_candidates_are_handed_on_as_arrays(spark, monkeypatch, share):
    """The JVM has a row for a part of the runs, not one for each run of each task."""
    monkeypatch.setattr(collocations, "SHARE", share)
    texts = ["a b c a b d", "b a b c", "d d d d d", "a", ""]
    runs = Counter(run for text in texts for run in zip(text.split(), text.split()[1:]))
    found = collocations.candidates(encoded_texts(spark, texts), 2, None, 7, 3)
    assert sorted((chr(r.s0), chr(r.s1)) for r in found.collect()) == sorted(
        run for run, n in runs.items() if 3 * n >= 7
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "runs" in plan


def test_runs_that_share_a_hash_are_told_apart(monkeypatch):
    whole = collocations.keys_of
    monkeypatch.setattr(collocations, "keys_of", lambda columns: whole(columns) & np.uint64(1))
    rng = np.random.default_rng(5)
    runs = rng.integers(1, 6, (4000, 3), dtype=np.uint64)
    count = rng.integers(1, 4, 4000).astype(np.int32)
    batches = [b for at in (0, 1500) for b in collocations._dealt(
        runs[at : at + 1500 + at], count[at : at + 1500 + at], 2)]
    table = collocations.pa.Table.from_batches(batches)
    assert sorted(set(table["part"].to_pylist())) == [0, 1]
    found = [
        run for part in (0, 1) for run in collocations._often(
            table.filter(collocations.pc.field("part") == part), 3, 60).tolist()
    ]
    wanted = Counter()
    for run, n in zip(runs.tolist(), count.tolist()):
        wanted[tuple(run)] += n
    kept = sorted(run for run, n in wanted.items() if n >= 60)
    assert sorted(map(tuple, found)) == kept and 0 < len(kept) < len(wanted)


def test_blocks_hold_each_phrase_once_and_few(spark, monkeypatch):
    """Also where one first word has more phrases than a block."""
    monkeypatch.setattr(collocations, "BLOCK", 60)
    symbols = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 90, dtype=np.int64)
    pairs = [(int(symbols[0]), i) for i in range(100)] + [(int(s), 1) for s in symbols[1:]]
    frame = spark.createDataFrame(pairs, "s0 long, s1 long")
    own = [frame.where(block).collect() for block in collocations._blocks(frame, 2)]
    assert sorted(tuple(row) for rows_ in own for row in rows_) == sorted(pairs)
    assert max(map(len, own)) <= 25 and len(own) < 40


def test_shared_symbols_are_noticed(rows, monkeypatch):
    """Were two words to share a symbol, the next seed would be tried."""
    whole = collocations.symbols_of

    def clumsy(words, lang, seed):
        found = whole(words, lang, seed)
        return found & np.uint64(1) if seed == 0 else found

    monkeypatch.setattr(collocations, "symbols_of", clumsy)
    texts = [("en", "a b c ")] * 9
    assert found(rows("lang string, text string", *texts), 3, 10) == brute(texts, 3, 10)


def test_a_trie_accepts_its_phrases_only():
    rng = np.random.default_rng(3)
    symbols = rng.integers(1, 1 << 60, 400, dtype=np.uint64)
    phrases = np.unique(symbols[rng.integers(0, 400, (3000, 3))], axis=0)
    phrases = np.concatenate([phrases, np.stack([np.full(300, symbols[0]), symbols[:300], symbols[:300]], 1)])
    phrases = np.unique(phrases, axis=0)
    trie = Trie(phrases)
    stream = symbols[rng.integers(0, 400, 20000)]
    stream[100:103] = phrases[5]
    stream[50] = 7  # no symbol of the trie
    known = {tuple(p): i for i, p in enumerate(phrases.tolist())}
    runs = zip(stream.tolist(), stream[1:].tolist(), stream[2:].tolist())
    wanted = Counter(known[run] for run in runs if run in known)
    count = np.bincount(trie.reached(trie.codes(stream), 3), minlength=len(trie.base))[trie.accept]
    assert {i: n for i, n in enumerate(count.tolist()) if n} == wanted and wanted[5]


def test_a_bit_map_loses_nothing(rows):
    frame = rows("a long, b long", *[(i * 7, -i) for i in range(500)])
    bits = bit_map(frame, ["a", "b"], 16)
    table = frame.toArrow()
    key = keys_of([table[c].to_numpy().view(np.uint64) for c in ("a", "b")])
    assert contains(bits, key).all()
    other = keys_of([table["b"].to_numpy().view(np.uint64), table["a"].to_numpy().view(np.uint64)])
    assert contains(bits, other).mean() < 0.05
