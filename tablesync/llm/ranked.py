"""Ranked lexical search by a dual tree over items and documents.

Documents score an item by the weights of the terms they share and a saturated, length-aware
term frequency, all in integers. Both sides are put into hierarchies whose nodes hold the
maximum of every coordinate: a node of items has the weight of each term that any of its items
holds, a node of documents the largest impact of each term below it. The product of two nodes
bounds every score below them. A pair of nodes whose bound is under the weakest k-th score of
its items is left out with all it holds, which loses nothing; the leaves that remain are
scored by one matrix product each.

Documents stay where they are read: a task keeps the best ``k`` of its documents for each
item, and these are ranked in Spark. Thresholds begin with the k-th scores of a sample, which
are lower bounds of the true ones, and rise while a task works.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import stash
from .text import slices
from .tokenize import byte_class, tokens

#: Bytes of a term, of digits, letters and characters beyond ASCII.
TERM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

K = 50

#: Distinct terms, summed over items, that are broadcast at once, and those of one hierarchy.
BLOCK, TREE = 1 << 20, 1 << 14

#: Items of a leaf; documents of a leaf, children of a node, documents of a hierarchy.
ITEMS, LEAF, FAN, GROUP = 8, 32, 8, 8192

#: Numbers in the widest level of a hierarchy over documents.
NODES = 1 << 22

#: Documents of the sample that thresholds begin with.
FIRST = 1 << 14

#: Every impact is below this, so sums of weights under 2**53 / IMPACT are exact in doubles.
IMPACT = 1_000_001


def item_terms(items: DataFrame) -> DataFrame:
    """``item``, a number of its own for each row, ``item_id`` and its distinct ``terms``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, _, _ = tokens(part.column("text"), TERM)
                width = len(found.offsets)
                pair = np.unique(found.doc * width + found.code)
                spans = np.searchsorted(pair // width, np.arange(found.rows + 1))
                terms = found.distinct.cast(pa.binary()).take(pa.array(pair % width))
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id"), pa.ListArray.from_arrays(
                        pa.array(spans, pa.int32()), terms)],
                    ["item_id", "terms"],
                )

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", "text").mapInArrow(
        task, f"item_id {kind}, terms array<binary>"
    )
    found = found.where(F.size("terms") > 0).withColumn("item", F.monotonically_increasing_id())
    return stash(found, "items")


def postings(documents: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """``doc_id``, its number of terms ``n``, and places in ``vocabulary`` with frequencies."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary.to_pylist())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            for part in slices(batch, "text"):
                found, _, _ = tokens(part.column("text"), TERM)
                place = pc.index_in(found.distinct, value_set=known)
                place = pc.fill_null(place, -1).to_numpy().astype(np.int64)
                place = place[found.code] if len(found.code) else np.zeros(0, np.int64)
                hit = place >= 0
                pair, count = np.unique(
                    found.doc[hit] * max(1, len(known)) + place[hit], return_counts=True
                )
                owner = pair // max(1, len(known))
                spans = pa.array(np.searchsorted(owner, np.arange(found.rows + 1)), pa.int32())
                term = pa.array((pair % max(1, len(known))).astype(np.int32))
                n = np.bincount(found.doc, minlength=found.rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(spans, term),
                     pa.ListArray.from_arrays(spans, pa.array(count.astype(np.int32)))],
                    ["doc_id", "n", "term", "tf"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        task, f"doc_id {kind}, n long, term array<int>, tf array<int>"
    )


def document_counts(found: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(batch.column("term").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], ["at", "df"])

    summed = found.select("term").mapInArrow(task, "at long, df long").groupBy("at")
    table = summed.agg(F.sum("df").alias("df")).toArrow()  # at most a row per term of a block
    count = np.zeros(size, np.int64)
    count[table["at"].to_numpy()] = table["df"].to_numpy()
    return count


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


class ItemTree:
    """A hierarchy over items: ``levels[i]`` is ``(holds, items)``, parents before children.

    ``holds`` has the weight of every term (columns, numbered in ``terms``) that an item of the
    node holds; ``child[i]`` names each node's parent in the level before.
    """

    def __init__(self, items: list[tuple[int, np.ndarray]], weight: np.ndarray):
        self.terms = np.unique(np.concatenate([own for _, own in items]))
        heavy = max(int(weight[own].sum()) for _, own in items)
        self.kind = np.float64 if heavy * IMPACT < 1 << 53 else np.int64
        holds = np.zeros((len(items), len(self.terms)), self.kind)
        for row, (_, own) in enumerate(items):
            holds[row, np.searchsorted(self.terms, own)] = weight[own]
        order, cuts = self._order(holds)
        self.item = np.array([items[i][0] for i in order], np.int64)
        self.holds = holds[order]
        # Levels from the leaves up; a node joins two neighbours.
        spans = [np.array(cuts, np.int64)]
        while len(spans[-1]) > 2:
            spans.append(np.unique(np.append(spans[-1][::2], len(items))))
        self.spans = spans[::-1]
        self.maxima = [np.maximum.reduceat(self.holds, s[:-1], axis=0) for s in self.spans]

    @staticmethod
    def _order(holds: np.ndarray) -> tuple[list[int], list[int]]:
        """Items so that those with heavy terms in common are together, and ends of leaves."""
        order: list[int] = []
        cuts = [0]
        stack = [np.arange(len(holds))]
        while stack:
            rows = stack.pop()
            if len(rows) <= ITEMS:
                order.extend(rows.tolist())
                cuts.append(len(order))
                continue
            own = holds[rows]
            share = (own > 0).mean(axis=0)
            best = int(np.argmax(own.max(axis=0) * share * (1 - share)))
            with_it = own[:, best] > 0
            if with_it.all() or not with_it.any():
                with_it = np.arange(len(rows)) < len(rows) // 2
            stack += [rows[~with_it], rows[with_it]]
        return order, cuts


class DocumentTree:
    """A hierarchy over a group of documents, given as sparse rows of impacts."""

    def __init__(self, row: np.ndarray, column: np.ndarray, impact: np.ndarray,
                 weight: np.ndarray, rows: int, columns: int, kind: type):
        self.kind, self.columns = kind, columns
        # Documents with the same heaviest terms are neighbours.
        value = impact * weight[column]
        by_value = np.lexsort((-value, row))
        first = np.searchsorted(row[by_value], np.arange(rows))
        count = np.bincount(row, minlength=rows)
        keys = []
        for depth in (1, 0):
            has = count > depth
            key = np.full(rows, columns)
            key[has] = column[by_value[first[has] + depth]]
            keys.append(key)
        self.order = np.lexsort(keys)
        place = np.empty(rows, np.int64)
        place[self.order] = np.arange(rows)
        self.row, self.column, self.impact = place[row], column, impact
        by_row = np.argsort(self.row, kind="stable")
        self.row, self.column = self.row[by_row], column[by_row]
        self.impact = impact[by_row]
        self.rows = rows
        # Levels from the leaves up.
        leaves = -(-rows // LEAF)
        level = np.zeros((leaves, columns), kind)
        np.maximum.at(level, (self.row // LEAF, self.column), self.impact.astype(kind))
        levels = [level]
        while len(level) > 1:
            level = np.maximum.reduceat(level, np.arange(0, len(level), FAN), axis=0)
            levels.append(level)
        self.levels = levels[::-1]

    def members(self, number: int) -> np.ndarray:
        """The documents of a leaf, in the order of its matrix."""
        return self.order[number * LEAF : (number + 1) * LEAF]

    def leaf(self, number: int) -> np.ndarray:
        """The impacts of a leaf's documents as a matrix."""
        low, high = number * LEAF, min(self.rows, (number + 1) * LEAF)
        begin, end = np.searchsorted(self.row, (low, high))
        full = np.zeros((high - low, self.columns), self.kind)
        full[self.row[begin:end] - low, self.column[begin:end]] = self.impact[begin:end]
        return full


def surviving(
    items: ItemTree, documents: DocumentTree, least: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that may hold a score of at least ``least`` of their items.

    ``least`` has each item's threshold. Both hierarchies are descended together, the wider
    side first; every pair of nodes is bounded by the product of their maxima.
    """
    q, d = np.zeros(1, np.int64), np.zeros(1, np.int64)
    at_q = at_d = 0
    while True:
        weakest = np.minimum.reduceat(least, items.spans[at_q][:-1])
        nodes_q, place_q = np.unique(q, return_inverse=True)
        nodes_d, place_d = np.unique(d, return_inverse=True)
        bound = items.maxima[at_q][nodes_q] @ documents.levels[at_d][nodes_d].T
        bound = bound[place_q, place_d]
        open_ = (bound >= weakest[q]) & (bound > 0)
        q, d = q[open_], d[open_]
        last_q, last_d = at_q == len(items.spans) - 1, at_d == len(documents.levels) - 1
        if not len(q) or (last_q and last_d):
            return q, d
        if not last_d:
            below = len(documents.levels[at_d + 1])
            child = d[:, None] * FAN + np.arange(FAN)
            fits = child < below
            q, d = np.repeat(q, fits.sum(axis=1)), child[fits]
            at_d += 1
        if not last_q:
            ends = np.searchsorted(items.spans[at_q + 1], items.spans[at_q])
            width = (ends[1:] - ends[:-1])[q]
            d = np.repeat(d, width)
            step = np.arange(len(d)) - np.repeat(np.cumsum(width) - width, width)
            q = np.repeat(ends[q], width) + step
            at_q += 1


class Best:
    """The best ``k`` documents of each item so far."""

    def __init__(self, items: int, k: int, least: np.ndarray):
        self.k, self.least = k, least
        self.item, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.doc, self.new = np.zeros((0,), object), []
        self.items = items

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        self.new.append((item, score, doc))

    def settle(self) -> None:
        """Keep ``k`` of each item and raise the thresholds to the k-th scores."""
        if not self.new:
            return
        item = np.concatenate([self.item, *[x[0] for x in self.new]])
        score = np.concatenate([self.score, *[x[1] for x in self.new]])
        doc = np.concatenate([self.doc, *[x[2] for x in self.new]])
        self.new = []
        named = np.array([x is not None for x in doc], bool)
        number = np.array([0 if x is None else x for x in doc])
        order = np.lexsort((number, named, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = rank < self.k
        kth = rank == self.k - 1
        np.maximum.at(self.least, item[kth], score[kth])
        self.item, self.score, self.doc = item[kept], score[kept], doc[kept]


def best_documents(
    found: DataFrame, trees: list[ItemTree], weight: np.ndarray, documents: int, total: int,
    items: int, k: int, least: np.ndarray,
) -> DataFrame:
    """``place, doc_id, score``: the best ``k`` of each task; ``place`` counts the items."""
    shared = found.sparkSession.sparkContext.broadcast((trees, weight, least))
    widest = max(len(tree.terms) for tree in trees)
    rows_at_once = min(GROUP, LEAF * max(1, NODES // widest))

    def group(ids, n, row, term, tf, best: Best) -> None:
        weight = shared.value[1]
        m = 100 - 50 + (50 * n * documents) // total
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[row])
        for tree in shared.value[0]:
            column = np.searchsorted(tree.terms, term)
            mine = tree.terms[np.minimum(column, len(tree.terms) - 1)] == term
            if not mine.any():
                continue
            docs = DocumentTree(
                row[mine], column[mine], impact[mine], weight[tree.terms], len(n),
                len(tree.terms), tree.kind,
            )
            q, d = surviving(tree, docs, best.least[tree.item])
            spans = tree.spans[-1]
            for leaf in np.unique(d):
                nodes = q[d == leaf]
                own = np.concatenate([np.arange(spans[x], spans[x + 1]) for x in nodes])
                score = tree.holds[own] @ docs.leaf(int(leaf)).T
                good = (score > 0) & (score >= best.least[tree.item[own]][:, None])
                i, j = np.nonzero(good)
                best.add(
                    tree.item[own][i], score[i, j].astype(np.int64),
                    ids[docs.members(int(leaf))[j]],
                )
            best.settle()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(items, k, shared.value[2].copy())
        for batch in batches:
            for begin in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(begin, rows_at_once)
                ids = np.array(part.column("doc_id").to_pylist(), object)
                n = part.column("n").to_numpy().astype(np.int64)
                terms = part.column("term")
                row = pc.list_parent_indices(terms).to_numpy().astype(np.int64)
                term = terms.flatten().to_numpy().astype(np.int64)
                tf = part.column("tf").flatten().to_numpy().astype(np.int64)
                if len(row):
                    group(ids, n, row, term, tf, best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.doc.tolist(), doc_type), pa.array(best.score)],
            ["place", "doc_id", "score"],
        )

    kind = found.schema["doc_id"].dataType.simpleString()
    doc_type = pa.int32() if kind == "int" else pa.int64()
    return found.where("n > 0").mapInArrow(task, f"place long, doc_id {kind}, score long")


def _top(frame: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank_documents(documents: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents, equal scores by id.

    ``documents`` has an integer ``doc_id`` and ``text``, ``items`` has ``item_id`` and
    ``text``. Terms are runs of ASCII digits and letters and of characters beyond ASCII, with
    A-Z in lower case. Null and empty texts have none: such documents count nowhere and such
    items have no rows. Every row is an item or a document of its own, also when it repeats
    an id; a null ``doc_id`` comes before others of the same score. Other columns are ignored.
    """
    spark = documents.sparkSession
    asked = item_terms(items)
    sizes = asked.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    blocks = -(-int(sizes) // BLOCK)
    counted = totals = None
    answers = []
    for block in range(blocks):
        # A hash deals items to blocks; a block is a bounded share of the items' terms.
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item")
        own = own.toArrow().combine_chunks()
        if not len(own):
            continue
        lists = own["terms"].combine_chunks()
        vocabulary = pc.unique(lists.flatten()).cast(pa.large_binary())
        number = pc.index_in(lists.flatten().cast(pa.large_binary()), value_set=vocabulary)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        number = np.split(number.to_numpy().astype(np.int64), ends[:-1])
        counted = stash(postings(documents, vocabulary), "postings")
        if totals is None:
            totals = counted.agg(
                F.count_if(F.col("n") > 0).alias("rows"), F.sum("n").alias("terms")
            ).first()
        rows, terms = totals["rows"], totals["terms"] or 0
        if not rows:
            break
        weight = weights(document_counts(counted, len(vocabulary)), rows)
        trees, group, held = [], [], 0
        for place, terms_of in enumerate(number):
            group.append((place, np.sort(terms_of)))
            held += len(terms_of)
            if held >= TREE or place == len(number) - 1:
                trees.append(ItemTree(group, weight))
                group, held = [], 0
        least = np.zeros(len(number), np.int64)
        if rows > FIRST:
            share = F.lit(FIRST / rows)
            some = counted.where(F.rand(7) < share).repartition(8)
            first = best_documents(some, trees, weight, rows, terms, len(number), k, least)
            kth = _top(first, k).where(F.col("rank") == k).select("place", "score").toArrow()
            least = least.copy()
            least[kth["place"].to_numpy()] = kth["score"].to_numpy()
        found = best_documents(counted, trees, weight, rows, terms, len(number), k, least)
        names = spark.createDataFrame(
            pa.table({"_place": pa.array(np.arange(len(number))), "item_id": own["item_id"]})
        )
        ranked = _top(found, k).join(names, F.col("place") == F.col("_place"))
        answers.append(ranked.select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    if not answers:
        doc, item = documents.schema["doc_id"].dataType, items.schema["item_id"].dataType
        schema = f"item_id {item.simpleString()}, rank int, doc_id {doc.simpleString()}, score long"
        return spark.createDataFrame([], schema)
    result = answers[0]
    for more in answers[1:]:
        result = result.unionByName(more)
    return result
