"""Near-duplicate vectors by sorted projection passes.

In each pass a vector's code is 64 random hashes, the signs of its projections, written one
after the other. Vectors of a label are ordered by their codes, which brings similar ones
close, and each is compared with a bounded window of successors. Pairs whose exact cosine is
high enough are united over all passes. Passes come in rounds: as many as the largest label
needs for a stated chance to miss a pair, and on until a round joins nothing more. A group that is larger than a window is found as a
chain of windows; the links inside each group are then counted exactly, block against block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components, forest
from .storage import stash
from .vectors import dimension_of, matrix, usable

COSINE = 0.93
PASSES = 16
WINDOW = 64

#: The chance to miss a pair of just that cosine among vectors of its label spread evenly.
MISS = 1e-4

#: Vectors of a sorted run that are compared together, and of a group that are counted together.
RUN = 4096
CHUNK = 1024


def _normal(points: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so very large or small components do not overflow."""
    points = points / np.abs(points).max(axis=1, keepdims=True)
    return points / np.sqrt((points * points).sum(axis=1, keepdims=True))


def _coded(nodes: DataFrame, dimension: int, passes: int, seed: int) -> DataFrame:
    """Every vector once for each pass, with its code."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        planes = rng.standard_normal((passes, dimension, 64))
        bit = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                points = matrix(part.column("vector"), dimension)
                for number in range(passes):
                    code = ((points @ planes[number]) > 0) @ bit
                    # Flipping the top bit makes signed order the order of the code.
                    order = (code ^ np.uint64(1 << 63)).view(np.int64)
                    yield part.append_column(
                        "pass", pa.array(np.full(len(part), number, np.int32))
                    ).append_column("code", pa.array(order))

    schema = nodes.withColumns({"pass": F.lit(0), "code": F.lit(0).cast("long")}).schema
    return nodes.mapInArrow(task, schema)


def _runs(coded: DataFrame, window: int, run: int) -> DataFrame:
    """Add ``run`` and ``behind``: sorted rows in runs, each with the window before it.

    Rows are range-partitioned by pass, label and code, so a run is a slice of a partition.
    The last rows of a run are handed to the next as well, across partitions too.
    """
    keys = ["pass", "label", "code", "node"]
    parts = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lined = coded.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    lined = stash(lined.withColumn("at", F.monotonically_increasing_id()), "sorted")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    lined = lined.withColumns({"part": part, "place": place})
    sizes = lined.groupBy("part").agg(F.count("*").alias("size"))  # a row per partition
    after = F.lead("part").over(Window.orderBy("part"))
    sizes = sizes.withColumn("next", after).withColumnRenamed("part", "_part")
    lined = lined.join(F.broadcast(sizes), F.col("part") == F.col("_part"))
    number = F.floor(F.col("place") / run)
    own = F.struct(F.col("part").alias("part"), number.alias("number"), F.lit(False).alias("behind"))
    tail = F.col("place") % run >= run - window
    later = (F.col("place") < F.col("size")) & ((number + 1) * run < F.col("size"))
    onward = F.when(
        tail & later,
        F.struct(F.col("part").alias("part"), (number + 1).alias("number"), F.lit(True).alias("behind")),
    )
    last = F.when(
        (F.col("place") >= F.col("size") - window) & F.col("next").isNotNull(),
        F.struct(F.col("next").alias("part"), F.lit(0).cast("long").alias("number"),
                 F.lit(True).alias("behind")),
    )
    copies = F.filter(F.array(own, onward, last), lambda x: x.isNotNull())
    return lined.withColumn("run", F.explode(copies)).select(
        "node", "label", "vector", "pass", "code", "at",
        F.col("run.part").alias("part"), F.col("run.number").alias("number"),
        F.col("run.behind").alias("behind"),
    )


def window_links(
    nodes: DataFrame, dimension: int, cosine: float, passes: int, window: int, seed: int = 7
) -> DataFrame:
    """``a, b``: verified pairs that connect what the windows of all passes found.

    A pair that only confirms a connection made in the same run is left out.
    """
    kind = dict(nodes.dtypes)["node"]

    def task(key: tuple, table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table["at"].to_numpy(), kind="stable")))
        points = _normal(matrix(table["vector"], dimension))
        label = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
        same = label.astype(np.int64) * passes + table["pass"].to_numpy()
        behind = table["behind"].to_numpy()
        node = table["node"].to_numpy()
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for gap in range(1, min(window, len(node) - 1) + 1):
            close = (points[:-gap] * points[gap:]).sum(axis=1) >= cosine
            close &= (same[:-gap] == same[gap:]) & ~behind[gap:]
            hits = np.flatnonzero(close)
            left.append(hits)
            right.append(hits + gap)
        kept = forest(len(node), np.concatenate(left), np.concatenate(right))
        ends = np.array(kept, np.int64).reshape(-1, 2)
        return pa.table({"a": node[ends[:, 0]], "b": node[ends[:, 1]]})

    runs = _runs(_coded(nodes, dimension, passes, seed), window, RUN)
    return runs.groupBy("part", "number").applyInArrow(task, f"a {kind}, b {kind}")


def passes_needed(rows: int, cosine: float, window: int, miss: float = MISS) -> int:
    """Passes after which a pair of that cosine was in no window with a chance of ``miss``.

    A pair meets in a pass when it agrees in the bits that narrow a label down to a window.
    """
    bits = math.log2(max(1.0, rows / window))
    agree = 1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    meet = agree**bits
    return 1 if meet >= 1 else math.ceil(math.log(miss) / math.log1p(-max(meet, 1e-12)))


def linked_groups(
    nodes: DataFrame, dimension: int, cosine: float, passes: int, window: int
) -> DataFrame:
    """``node, component`` of the linked nodes, from rounds of ``passes`` passes each.

    Rounds go on until there were as many passes as the largest label needs and the last round
    joined nothing that was apart, which dense clusters take more passes for.
    """
    largest = nodes.groupBy("label").count().agg(F.max("count").alias("n")).first()["n"] or 0
    needed = passes_needed(largest, cosine, window)
    links = stash(window_links(nodes, dimension, cosine, passes, window), "near")
    group, done = stash(components(links), "groups"), passes
    while largest > 1:
        found = window_links(nodes, dimension, cosine, passes, window, seed=7 + done)
        found = stash(found, "near")
        done += passes
        known = [
            group.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
            for end in ("a", "b")
        ]
        apart = found.join(known[0], "a", "left").join(known[1], "b", "left").where(
            F.coalesce("_a", "a") != F.coalesce("_b", "b")
        )
        fresh = stash(apart.select("a", "b"), "new-links")
        none = fresh.isEmpty()
        if not none:
            # The groups so far stand for their links.
            tree = group.select(F.col("node").alias("a"), F.col("component").alias("b"))
            group = stash(components(tree.union(fresh)), "groups")
        elif done >= needed:
            break
    return group


def count_links(grouped: DataFrame, dimension: int, cosine: float, chunk: int = CHUNK) -> DataFrame:
    """``node, others``: rows at the linked nodes of each node's component, counted exactly.

    ``grouped`` has ``node, component, copies, vector``. A large component is cut into chunks
    that are compared chunk by chunk; small ones share a task.
    """
    kind = dict(grouped.dtypes)["node"]
    sizes = grouped.groupBy("component").agg(F.count("*").alias("size"))
    sizes = sizes.withColumnRenamed("component", "_component")
    sized = grouped.join(sizes, F.col("component") == F.col("_component")).drop("_component")
    sized = sized.withColumn("chunks", F.ceil(F.col("size") / chunk).cast("int"))
    mine = F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks")).cast("int")
    sized = stash(sized.withColumn("mine", mine), "chunks")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    parts = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    shared = F.pmod(F.xxhash64("component"), F.lit(parts))
    large = F.col("chunks") > 1

    def keyed(frame: DataFrame, row: str, column: str) -> DataFrame:
        return frame.select(
            "node", "component", "copies", "vector",
            F.when(large, F.col("component")).otherwise(shared.cast(kind)).alias("group"),
            F.when(large, F.col(row)).otherwise(-1).alias("row"),
            F.when(large, F.col(column)).otherwise(-1).alias("column"),
        )

    spread = sized.withColumn("theirs", other)
    left, right = keyed(spread, "mine", "theirs"), keyed(spread, "theirs", "mine")

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        group, to = left["component"].to_numpy(), right["component"].to_numpy()
        node, with_node = left["node"].to_numpy(), right["node"].to_numpy()
        copies = right["copies"].to_numpy().astype(np.float64)
        others = np.zeros(len(node))
        if len(node) and len(with_node):
            x, y = _normal(matrix(left["vector"], dimension)), _normal(matrix(right["vector"], dimension))
            order, against = np.argsort(group, kind="stable"), np.argsort(to, kind="stable")
            names = np.unique(group)
            begin, end = (np.searchsorted(group[order], names, s) for s in ("left", "right"))
            start, stop = (np.searchsorted(to[against], names, s) for s in ("left", "right"))
            for i, j, k, n in zip(begin, end, start, stop):
                own, theirs = order[i:j], against[k:n]
                linked = x[own] @ y[theirs].T >= cosine
                linked &= node[own][:, None] != with_node[theirs]
                others[own] = linked @ copies[theirs]
        return pa.table({"node": left["node"], "others": others.astype(np.int64)})

    keys = ["group", "row", "column"]
    counted = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        task, f"node {kind}, others long"
    )
    return counted.groupBy("node").agg(F.sum("others").alias("others"))


def group_vectors(
    vectors: DataFrame, cosine: float = COSINE, passes: int = PASSES, window: int = WINDOW
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding, label``.

    Two rows are linked when their labels are equal and their cosine, in double precision, is
    at least ``cosine``. ``n_links`` is the number of other rows linked, ``component_id`` the
    smallest id reachable by links, the row's own included, and ``kept`` marks that row. Vectors
    that are null, zero, not finite or of another than the most common dimension link with
    nothing, and neither do rows without a label or id. Rows that repeat an id are rows of
    their own. Equal vectors of a label are compared as one.
    """
    dimension = dimension_of(vectors, "embedding")
    part = usable("embedding", dimension) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", "label", "embedding")
    nodes = rows.where(part).groupBy("label", F.col("embedding").alias("vector")).agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies")
    )
    nodes = stash(nodes.select("node", "label", "copies", "vector"), "nodes")
    # One id may stand for several vectors when rows repeat it, so nodes get a name of their own.
    name = F.xxhash64("node", "label", "vector")
    named = nodes.select(name.alias("node"), "label", "vector")
    group = linked_groups(named, max(1, dimension), cosine, passes, window)
    inside = nodes.withColumn("_name", name).join(group.withColumnRenamed("node", "_node"),
                                                  F.col("_name") == F.col("_node"))
    counted = count_links(
        inside.select(F.col("_name").alias("node"), "component", "copies", "vector"),
        max(1, dimension), cosine,
    )
    least = inside.groupBy("component").agg(F.min("node").alias("least"))
    found = inside.select("_name", "component").join(least, "component")
    found = found.join(counted.withColumnRenamed("node", "_counted"),
                       F.col("_name") == F.col("_counted"))
    found = found.select(F.col("_name").alias("_found"), "least", "others")
    all_nodes = nodes.withColumn("_name", name).join(found, F.col("_name") == F.col("_found"), "left")
    all_nodes = all_nodes.select(
        F.col("label").alias("_label"), F.col("vector").alias("_vector"),
        F.coalesce("least", "node").alias("component_id"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    same = (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_vector"))
    joined = rows.where(part).join(all_nodes, same).select("vec_id", "n_links", "component_id")
    rest = rows.where(~F.coalesce(part, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.unionByName(rest).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
