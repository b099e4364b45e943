from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablesync.llm import mixing
from tablesync.llm.mixing import _round_cells, mix_sources, repeat_mixed, source_targets
from tablesync.llm.packing import pack_documents, tail_bounds
from tablesync.llm.totals import running_total


def expected_targets(sizes: dict) -> dict:
    """Water-filling by hand: weights 5, 2, 1; 150 % of all words; at most twice a source."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if weight[n] * unit >= 2 * sizes[n]}
        if not full:
            target |= {n: weight[n] * unit for n in open_}
            break
        target |= {n: 2.0 * sizes[n] for n in full}
        left -= sum(2.0 * sizes[n] for n in full)
        open_ -= full
    return target


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_taken_words(documents):
    found = mix_sources(documents).toPandas()
    texts = documents.select("doc_id", "text", "source").toPandas()
    texts["words"] = texts["text"].map(count)
    sizes = texts.groupby("source")["words"].sum().to_dict()
    target = expected_targets(sizes)
    found = found.merge(texts[["doc_id", "words", "source"]], on="doc_id")
    assert len(found) == len(texts) and (found["size"] == found["words"]).all()
    assert np.allclose(found["target"], found["source"].map(target))
    assert (found["source_size"] == found["source"].map(sizes)).all()
    assert (found["taken"] <= 2 * found["size"]).all() and (found["taken"] >= 0).all()
    assert ((found["rate"] >= 0) & (found["rate"] <= 2)).all()
    taken = found.groupby("source")["taken"].sum()
    least = texts.groupby("source")["words"].median()
    for name in sizes:
        assert abs(taken[name] - target[name]) <= max(2, least[name])
        # the rates themselves meet the constraint
        mine = found[found["source"] == name]
        assert (mine["rate"] * mine["size"]).sum() == pytest.approx(target[name], rel=1e-6)


def test_rates_are_an_exponential_tilt(documents):
    found = mix_sources(documents).toPandas()
    inner = found[(found["rate"] > 1e-6) & (found["rate"] < 2 - 1e-6) & (found["size"] > 0)]
    slope = np.log(inner["rate"] / (2 - inner["rate"])) / inner["size"]
    spread = slope.groupby(inner["target"] / inner["source_size"]).agg(lambda x: x.max() - x.min())
    assert (spread < 1e-6).all()


def test_reruns_agree(documents):
    order = ["doc_id", "taken"]
    one = mix_sources(documents).select(*order).toPandas().sort_values(order, ignore_index=True)
    two = mix_sources(documents.repartition(5)).select(*order).toPandas()
    pd.testing.assert_frame_equal(one, two.sort_values(order, ignore_index=True))


def test_mixing_awkward_rows(odd, clashing):
    found = mix_sources(odd)
    assert found.count() == odd.count()
    rows = {(r.doc_id, r.size): r for r in found.collect()}
    assert rows[(1, 0)].taken == 0 and rows[(3, 0)].taken == 0
    assert mix_sources(odd.limit(0)).count() == 0
    repeated = repeat_mixed(clashing)
    assert repeated.columns == clashing.columns
    copies = Counter((r.doc_id, r.text) for r in repeated.collect())
    wanted = Counter()
    for r in found.join(odd.select("doc_id", "text").distinct(), "doc_id").collect():
        wanted[(r.doc_id, r.text)] += r.copies
    assert {k: v for k, v in copies.items() if k[0] is not None} == {k: v for k, v in wanted.items() if v}


def test_targets_of_many_sources(rows):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 3, "é": 70, None: 400, "B": 0}
    cells = rows("source string, size long, n long", *[(k, v, 1) for k, v in sizes.items()])
    got = {r.source: r.target for r in source_targets(cells).collect()}
    assert got == pytest.approx(expected_targets(sizes))


def test_rounding_carries_what_is_owed():
    cells = pd.DataFrame(
        {"source": "a", "size": [100, 7, 1], "n": [3, 10, 50], "rate": [0.5, 1.3, 0.7], "most": 2}
    )
    out = _round_cells(cells)
    copies = out["base"] * [3, 10, 50] + out["extra"]
    wanted = 3 * 0.5 * 100 + 10 * 1.3 * 7 + 50 * 0.7
    assert abs((copies * out["size"]).sum() - wanted) <= 1


def test_multipliers_meet_the_target():
    size, n = np.array([0.0, 1, 7, 100, 4000]), np.array([5.0, 50, 10, 3, 1])
    for share in (0.01, 0.5, 1.0, 1.5, 1.99):
        target = share * float(n @ size)
        mean, at = mixing.balance(size, n, target, 2)
        rate = mixing._rates(at, size, mean, 2)
        assert float(n @ (size * rate)) == pytest.approx(target, rel=1e-8) and rate[0] == 1
    assert mixing.balance(size, n, 0.0, 2)[1] == -np.inf
    assert mixing.balance(size, n, 2 * float(n @ size), 2)[1] == np.inf
    assert mixing.balance(np.zeros(1), np.ones(1), 0.0, 2)[1] == -np.inf
    assert mixing._rates(np.inf, size, 1.0, 2).tolist()[1:] == [2, 2, 2, 2]


def test_newton_steps_take_no_tables(monkeypatch, documents):
    """However many steps a source takes, the driver sees the same few jobs."""
    written, stash = [], mixing.stash
    monkeypatch.setattr(mixing, "stash", lambda frame, label: written.append(label) or stash(frame, label))
    assert mix_sources(documents).count() == documents.count()
    assert written == ["sizes", "cells", "weights", "plan"]


def test_running_totals_of_a_hot_group(rows):
    frame = rows("g string, i long, v long", *[("x" if i % 4 else None, i, i % 7) for i in range(500)])
    got = running_total(frame, ["g"], F.xxhash64("i"), ["i"], "v", "t")
    hashes = {r.i: r.h for r in frame.select("i", F.xxhash64("i").alias("h")).collect()}
    total: dict = {}
    expected = {}
    for r in sorted(frame.collect(), key=lambda r: (hashes[r.i], r.i)):
        expected[r.i] = total.get(r.g, 0)
        total[r.g] = expected[r.i] + r.v
    assert {r.i: r.t for r in got.collect()} == expected


@pytest.fixture(scope="module")
def encode():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    return lambda text: library.encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(pieces, ids):
    """Each id lies in one piece, sequences are gapless and full."""
    assert pieces["length"].sum() == sum(map(len, ids.values()))
    for doc_id, own in pieces.sort_values("start").groupby("doc_id"):
        at = 0
        for piece in own.itertuples():
            assert piece.start == at and piece.doc_tokens == len(ids[doc_id])
            part = np.array(ids[doc_id][at : at + piece.length], "<u4").tobytes()
            assert zlib.crc32(part) == piece.ids_crc32
            at += piece.length
        assert at == len(ids[doc_id])
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert (own["offset"] == own["length"].cumsum() - own["length"]).all()
        size = own["length"].sum()
        assert size == 2048 or size & (size - 1) == 0
    assert set(pieces["sequence_id"]) == set(range(pieces["sequence_id"].nunique()))


def test_pieces_round_trip(documents, encode):
    ids = {r.doc_id: encode(r.text) for r in documents.select("doc_id", "text").collect()}
    check_pieces(pack_documents(documents).toPandas(), ids)


def test_windows_hold_the_target_shares(documents):
    window = 8
    pieces = pack_documents(documents, window_sequences=window).toPandas()
    share = pieces.groupby("source")["length"].sum() / pieces["length"].sum()
    largest = pieces.groupby("source")["doc_tokens"].max()
    at = pieces["sequence_id"] * 2048 + pieces["offset"] + pieces["length"]
    for end in range(window, int(pieces["sequence_id"].max()), window):
        sent = pieces[at <= end * 2048].groupby("source")["length"].sum().reindex(share.index).fillna(0)
        # Deficit round-robin: never off by more than a quantum and a document.
        slack = share * window * 2048 + largest + 2048
        assert ((sent - share * end * 2048).abs() <= slack + largest.sum() * share).all()


def test_given_shares_come_first(odd, encode):
    pieces = pack_documents(odd, shares={"b": 1.0}).toPandas()
    first = pieces.sort_values(["sequence_id", "offset"])
    order = list(first["source"].where(first["source"].notna(), None))
    assert "b" in order and "b" not in order[order.count("b") :]


def test_packing_awkward_rows(odd, clashing, encode):
    for frame in (odd, clashing):
        pieces = pack_documents(frame).toPandas()
        total = sum(len(encode(r.text)) for r in odd.collect())
        assert pieces["length"].sum() == total
        assert (pieces[pieces["doc_id"].isin([1, 2])]["doc_tokens"] == 1).all()
    assert pack_documents(odd.limit(0)).count() == 0


def test_tail_is_cut_into_powers_of_two():
    assert tail_bounds(2048 * 3 + 1030).tolist() == [6144, 7168, 7172, 7174]
    assert tail_bounds(4096).tolist() == [4096]
    assert tail_bounds(0).tolist() == [0]
