from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm.multi_index import search, visit
from tablesync.llm.projection import group_vectors, passes_needed

ODD = [
    (0, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, None, 1),
    (3, [float("nan"), 1.0], 1), (4, [1.0, None], 2), (5, [0.0, 2.0], 2), (5, [0.0, 2.0], 2),
    (None, [1.0, 1.0], 1), (6, [1.0, 2.0, 3.0], 1), (7, [1.0, 0.01], 1), (8, [1.0, 0.0], None),
    (9, [1e30, 1e30], 3), (10, [1e30, 1.01e30], 3), (11, [float("inf"), 1.0], 3),
]


@pytest.fixture
def odd_vectors(rows):
    frame = rows("vec_id long, embedding array<float>, label int", *ODD)
    names = ("cell", "shard", "node", "vector", "rank", "copies", "component", "pass")
    return frame.select("*", *[F.lit(1).alias(n) for n in names])


@pytest.fixture
def vectors(spark):
    return spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")


def test_pairs_come_in_the_order_of_their_sums():
    rng = np.random.default_rng(3)
    first, second = rng.random(9), rng.random(7)
    counts = rng.integers(0, 4, 63)
    seen = visit(first, second, counts, 1e9)
    sums = (first[:, None] + second).ravel()
    assert (np.diff(sums[seen]) >= 0).all()
    assert sorted(seen) == np.flatnonzero(counts).tolist()
    assert len(visit(first, second, counts, 3)) < len(seen)


def test_recall_and_exact_scores(vectors):
    found = search(vectors, F.col("vec_id") % 20 == 0).toPandas()
    table = vectors.toPandas()
    points, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    recall = []
    for query, own in found.groupby("query_id"):
        at = int(np.flatnonzero(ids == query)[0])
        gap = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        gap[at] = np.inf
        best = ids[np.lexsort((ids, gap))[:10]]
        own = own.sort_values("rank")
        assert list(own["rank"]) == list(range(1, 11))
        scores = [gap[np.flatnonzero(ids == v)[0]] for v in own["vec_id"]]
        assert np.allclose(own["score"], scores) and (np.diff(own["score"]) >= 0).all()
        recall.append(len(set(best) & set(own["vec_id"])) / 10)
    assert len(recall) == (ids % 20 == 0).sum()
    assert np.mean(recall) >= 0.9


def test_a_hot_cell_is_split_and_ties_go_to_small_ids(rows, monkeypatch):
    monkeypatch.setattr("tablesync.llm.multi_index.SHARD_VECTORS", 16)
    same = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(100)]
    rest = [(i, [float(i % 7), 1.0, float(i % 5), 1.0]) for i in range(100, 160)]
    found = search(rows("vec_id long, embedding array<double>", *same, *rest), F.col("vec_id") == 50)
    assert [(r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [(i, 0.0) for i in range(10)]


def test_search_over_awkward_rows(odd_vectors):
    found = search(odd_vectors, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    part = {0: [1.0, 0.0], 100: [1.0, 0.0], 5: [0.0, 2.0], 7: [1.0, 0.01], 8: [1.0, 0.0],
            9: [1e30, 1e30], 10: [1e30, 1.01e30]}
    for query in (0, 100):
        own = [r.vec_id for r in found if r.query_id == query]
        gap = {i: np.hypot(*(np.array(v) - part[query])) for i, v in part.items() if i != query}
        assert own == sorted(gap, key=lambda i: (gap[i], i))
    assert search(odd_vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def expected(table, least=0.93):
    ok = []
    size = 2 if len(table["embedding"].iloc[0]) == 2 else len(table["embedding"].iloc[0])
    for i, r in enumerate(table.itertuples()):
        v = None if r.embedding is None else np.array(r.embedding, float)
        fine = v is not None and len(v) == size and np.isfinite(v).all() and v.any()
        if fine and r.label == r.label and r.label is not None and r.vec_id == r.vec_id:
            ok.append((i, v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()), r.label))
    links = [0] * len(table)
    group = {i: i for i, _, _ in ok}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for k, (i, v, a) in enumerate(ok):
        for j, w, b in ok[:k]:
            if a == b and v @ w >= least:
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                group[max(x, y)] = min(x, y)
    ids = table["vec_id"].tolist()
    members: dict = {}
    for i in group:
        members.setdefault(root(i), []).append(ids[i])
    component = [min(members[root(i)]) if i in group else ids[i] for i in range(len(ids))]
    return sorted(
        (str(i), n, str(c)) for i, n, c in zip(ids, links, component)
    )


def got(frame):
    rows = frame.toPandas()
    return sorted(
        (str(i), n, str(c)) for i, n, c in zip(rows["vec_id"].tolist(), rows["n_links"], rows["component_id"].tolist())
    )


def test_links_and_components_of_awkward_rows(odd_vectors):
    assert got(group_vectors(odd_vectors)) == expected(odd_vectors.toPandas())
    assert group_vectors(odd_vectors.limit(0)).count() == 0


def test_groups_larger_than_window_run_and_chunk(rows, monkeypatch):
    monkeypatch.setattr("tablesync.llm.projection.RUN", 32)
    monkeypatch.setattr("tablesync.llm.projection.CHUNK", 16)
    rng = np.random.default_rng(2)
    data = []
    for label, size in ((1, 120), (2, 60), (2, 5)):
        centre = rng.standard_normal(16)
        for _ in range(size):
            data.append((len(data), (centre + rng.standard_normal(16) * 0.12).tolist(), label))
    data += [(len(data) + i, rng.standard_normal(16).tolist(), 1) for i in range(40)]
    data += [(1000 + i, data[0][1], 1) for i in range(30)]
    frame = rows("vec_id long, embedding array<double>, label int", *data)
    assert got(group_vectors(frame, window=8)) == expected(frame.toPandas())


def test_passes_grow_with_the_label():
    assert passes_needed(64, 0.93, 64) == 1
    some = [passes_needed(n, 0.93, 64) for n in (10_000, 100_000, 1_500_000)]
    assert some == sorted(some) and 16 < some[0] < some[2] < 64


def test_lone_pairs_of_a_label_are_all_found(rows):
    """Two passes with so small a window see only some of them."""
    rng = np.random.default_rng(4)
    points = rng.standard_normal((1500, 32))
    close = points[:40] + 0.36 * rng.standard_normal((40, 32))
    data = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([points, close]))]
    frame = rows("vec_id long, embedding array<double>, label int", *data)
    assert got(group_vectors(frame, passes=6, window=8)) == expected(frame.toPandas())
