"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves, each quantised by its own centroids; a pair of centroids is
a cell. A query takes cells by the sum of its distances to their two centroids, smallest
first, with a heap over pairs, until they hold enough vectors, and ranks what they hold by
the exact distance.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stash
from .vectors import dimension_of, matrix, usable

#: Vectors that the centroids are fitted on: those with the smallest hashes of their ids.
TRAINING_VECTORS = 8192
#: Vectors per cell that the number of centroids aims at, and the most centroids of a half.
PER_CELL, MOST_CENTROIDS = 4, 1024
#: Share of all vectors that a query's cells hold. Vectors without any cluster structure need
#: about half for a recall of 0.9; a corpus with structure needs far less.
PROBE = 0.5
#: A cell counts for at most this share of what a query wants, so a hot one is never all.
CELL_SHARE = 1 / 64

SHARD_VECTORS = 4096
BLOCK_QUERIES = 16384


@dataclass
class Index:
    """Centroids of both halves, vectors per cell, and the shards that cells are dealt to."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray
    shard: np.ndarray
    splits: np.ndarray

    @property
    def shards(self) -> int:
        return int((self.shard + self.splits).max()) if len(self.shard) else 1


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of points to centroids."""
    square = (points**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1)
    return np.maximum(square - 2 * points @ centroids.T, 0)


def cluster(points: np.ndarray, count: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """Centroids by Lloyd's iterations from distinct points."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    chosen = rng.permutation(len(distinct))[:count]
    centroids = distinct[np.sort(chosen)]
    for _ in range(rounds):
        nearest = distances(points, centroids).argmin(axis=1)
        size = np.bincount(nearest, minlength=len(centroids))
        order = np.argsort(nearest, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(nearest[order]) > 0))
        sums = np.add.reduceat(points[order], starts, axis=0)
        centroids[size > 0] = sums / size[size > 0][:, None]
    return centroids


def visit(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: float) -> np.ndarray:
    """Cells in the order of their summed distances until they hold ``wanted`` vectors.

    Both halves' centroids are sorted once; the heap holds the next pair of each started row.
    """
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    one, two = first[rows].tolist(), second[columns].tolist()
    width, most = len(two), max(1.0, wanted * CELL_SHARE)
    heap = [(one[0] + two[0], 0, 0)]
    taken, held = [], 0.0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = rows[i] * width + columns[j]
        if counts[cell]:
            taken.append(cell)
            held += min(counts[cell], most)
        if j == 0 and i + 1 < len(one):
            heapq.heappush(heap, (one[i + 1] + two[0], i + 1, 0))
        if j + 1 < width:
            heapq.heappush(heap, (one[i] + two[j + 1], i, j + 1))
    return np.array(taken, np.int64)


def _cells(vectors: DataFrame, dimension: int, first: np.ndarray, second: np.ndarray) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast((first, second))  # MOST_CENTROIDS each
    half = dimension // 2

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = shared.value
        for batch in batches:
            points = matrix(batch.column("vector"), dimension)
            cell = distances(points[:, :half], one).argmin(axis=1) * len(two)
            cell = cell + distances(points[:, half:], two).argmin(axis=1)
            yield batch.append_column("cell", pa.array(cell.astype(np.int64)))

    return vectors.mapInArrow(task, vectors.withColumn("cell", F.lit(0).cast("long")).schema)


def search(
    vectors: DataFrame,
    is_query: Column,
    neighbours: int = 10,
    probe: float = PROBE,
    per_cell: int = PER_CELL,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest vectors found for each query vector.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``.
    ``score`` is the Euclidean distance in double precision; ties go to the smaller id.
    Vectors that are null, zero, not finite, of another than the most common dimension, or
    without an id take no part. Rows that repeat an id count once (with the smallest vector).
    """
    spark = vectors.sparkSession
    dimension = dimension_of(vectors, "embedding")
    part = vectors.where(F.col("vec_id").isNotNull() & usable("embedding", dimension))
    part = part.groupBy("vec_id").agg(F.min("embedding").alias("vector"))
    part = stash(part, "vectors")
    total = part.count()
    order = F.xxhash64("vec_id", F.lit("fit"))
    sample = part.orderBy(order, "vec_id").limit(TRAINING_VECTORS).select("vector").toArrow()
    half = max(1, dimension // 2)
    wanted = math.ceil(math.sqrt(total / per_cell)) if total else 1
    count = max(1, min(MOST_CENTROIDS, wanted))
    points = matrix(sample["vector"], max(1, dimension))
    first = cluster(points[:, :half], count) if total else np.zeros((1, half))
    second = cluster(points[:, half:], count) if total else np.zeros((1, half))
    indexed = stash(_cells(part, max(1, dimension), first, second), "cells")
    counts = np.zeros(len(first) * len(second), np.int64)
    for row in indexed.groupBy("cell").count().collect():  # at most MOST_CENTROIDS ** 2
        counts[row["cell"]] = row["count"]
    splits = np.maximum(1, -(-counts // SHARD_VECTORS))
    # Cells share a shard until it is full; a larger cell has shards of its own.
    small = np.where(splits > 1, 0, counts)
    shard = np.cumsum(small) // SHARD_VECTORS
    own = int(shard.max()) + 1 + np.cumsum(np.where(splits > 1, splits, 0))
    shard = np.where(splits > 1, own - splits, shard)
    index = spark.sparkContext.broadcast(Index(first, second, counts, shard, splits))
    queries = indexed.where(is_query)
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    place = F.xxhash64("vec_id", F.lit("shard"))
    kind = dict(vectors.dtypes)["vec_id"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = index.value
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            spread = batch.column("place").to_numpy() % held.splits[cell]
            number = (held.shard[cell] + spread).astype(np.int64)
            yield batch.drop_columns(["place"]).append_column("shard", pa.array(number))

    dealt = indexed.withColumn("place", F.shiftrightunsigned(place, 1))
    dealt = dealt.mapInArrow(deal, indexed.withColumn("shard", F.lit(0).cast("long")).schema)
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = index.value
        for batch in batches:
            points = matrix(batch.column("vector"), dimension)
            to_first = distances(points[:, :half], held.first)
            to_second = distances(points[:, half:], held.second)
            row, number, cells = [], [], []
            for i in range(len(points)):
                seen = visit(to_first[i], to_second[i], held.counts, probe * total + neighbours + 1)
                many = held.splits[seen]
                cell = np.repeat(seen, many)
                ends = np.cumsum(many)
                at = held.shard[cell] + np.arange(len(cell)) - np.repeat(ends - many, many)
                order = np.argsort(at, kind="stable")
                bounds = np.flatnonzero(np.append(True, np.diff(at[order]) > 0))
                for own in np.split(order, bounds[1:]):
                    row.append(i)
                    number.append(at[own[0]])
                    cells.append(cell[own])
            taken = batch.take(pa.array(row, pa.int64())).drop_columns(["cell"])
            yield taken.append_column("shard", pa.array(number, pa.int64())).append_column(
                "cells", pa.array(cells, pa.list_(pa.int64()))
            )

    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    routed = queries.withColumn("block", block).mapInArrow(
        route,
        f"vec_id {kind}, vector {dict(part.dtypes)['vector']}, block int, shard long, "
        "cells array<long>",
    )

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        points = matrix(right["vector"], dimension)
        ids, cell = right["vec_id"].to_numpy(), right["cell"].to_numpy()
        found = []
        for query, vector, cells in zip(
            left["vec_id"].to_pylist(), matrix(left["vector"], dimension), left["cells"]
        ):
            mine = np.flatnonzero(np.isin(cell, cells.values.to_numpy()) & (ids != query))
            gap = points[mine] - vector
            score = np.sqrt((gap * gap).sum(axis=1))
            if len(mine) > neighbours:
                edge = np.partition(score, neighbours - 1)[neighbours - 1]
                near = np.flatnonzero(score <= edge)
                mine, score = mine[near], score[near]
            best = np.lexsort((ids[mine], score))[:neighbours]
            found.append((np.full(len(best), query, ids.dtype), ids[mine[best]], score[best]))
        found.append((ids[:0], ids[:0], np.zeros(0)))
        query, vec, score = (np.concatenate(x) for x in zip(*found))
        return pa.table({"query_id": query, "vec_id": vec, "score": score})

    near = routed.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInArrow(
        rank, f"query_id {kind}, vec_id {kind}, score double"
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= neighbours)
    return ranked.select("query_id", "rank", "vec_id", "score")
