"""Near-duplicate texts by BagMinHash signatures of their shingle multisets.

A shingle is five successive words (all words of a shorter text); its weight is how often it
occurs. A signature register holds the smallest point of independent Poisson processes, one
for each unit of weight, so two registers agree with the chance of the weighted Jaccard
similarity. Units are grouped in dyadic ranges 1, 2, 3-4, 5-8, ...: a range is one process of
its total rate, whose points are dealt to its units by further hash bits, so a weight of
thousands costs a handful of processes. Points come in rising order, and a process stops when
it has passed the largest register of its text: few points suffice for long texts.

Bands propose pairs. A band that many texts share is joined loosely first; if that leaves its
texts in several groups, all its pairs are compared, block against block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components, forest
from .storage import stash
from .subword import release
from .text import mix, powers, slices, word_hashes, words

WORDS = 5
SIMILARITY = 0.8

#: 26 bands of 5 registers: a pair of similarity 0.8 is missed once in 30,000 times.
BANDS, ROWS = 26, 5

#: Up to so many texts of a band are paired at once; larger bands by stars and chains, and in
#: blocks where those leave several groups.
PAIRWISE = 12

#: Bytes of text whose shingles a task holds at once, about a hundred times as many in arrays.
SLICE = 1 << 20

#: Shingles of a chunk, a side of a block; a text counts as LEAST of them at least.
CHUNK, LEAST = 1 << 19, 256

#: A shingle of a block in so many texts is a column of a matrix product.
COMMON = 32

_U = np.uint64


def shingles(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each distinct shingle of each text, ordered by text and hash."""
    found = words(texts, True)
    hashes = mix(word_hashes(found))[found.code]
    count = np.bincount(found.doc, minlength=found.rows)
    first = np.cumsum(count) - count
    width = np.minimum(count, size)
    starts = np.maximum(count - size + 1, np.minimum(count, 1))
    ends = np.cumsum(starts)
    doc = np.repeat(np.arange(found.rows), starts)
    at = first[doc] + np.arange(len(doc)) - np.repeat(ends - starts, starts)
    total = width[doc].astype(_U)
    padded = np.append(hashes, np.zeros(size, _U))
    for i, power in enumerate(powers(0x9FB21C651E98DF25, size)):
        total += np.where(i < width[doc], padded[at + i] * power, _U(0))
    key = mix(total)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    start = np.flatnonzero(new)
    return doc[start], key[start], np.diff(np.append(start, len(doc)))


def _processes(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Element and range of each Poisson process: range r holds units 2**(r-1)+1 to 2**r."""
    top = np.zeros(len(count), np.int64)
    more = count > 1
    top[more] = np.ceil(np.log2(count[more])).astype(np.int64)
    element = np.repeat(np.arange(len(count)), top + 1)
    ends = np.cumsum(top + 1)
    return element, np.arange(len(element)) - np.repeat(ends - top - 1, top + 1)


def signatures(
    doc: np.ndarray, key: np.ndarray, count: np.ndarray, rows: int, registers: int
) -> np.ndarray:
    """Registers of each text; infinite where the text has no shingle."""
    table = np.full((rows, registers), np.inf)
    flat = table.reshape(-1)
    element, span = _processes(count)
    owner, weight = doc[element], count[element]
    seed = mix(key[element] + mix(span.astype(_U) + _U(11)))
    low = np.where(span == 0, 0, 1 << np.maximum(span - 1, 0))
    width = np.where(span == 0, 1, low)
    time = np.zeros(len(seed))
    step, drawn = 1, 0
    while len(seed):
        index = _U(drawn + 1) + np.arange(step, dtype=_U)
        draw = mix(seed[:, None] + index * _U(0xA0761D6478BD642F))
        gap = -np.log(((draw >> _U(11)).astype(float) + 0.5) / (1 << 53))
        points = time[:, None] + np.cumsum(gap, axis=1) / width[:, None]
        other = mix(draw + _U(0xE7037ED1A0B428DB))
        register = (other >> _U(32)) % _U(registers)
        unit = low[:, None] + (other & _U(0xFFFFFFFF)).astype(np.int64) * width[:, None] // (1 << 32)
        hit = unit < weight[:, None]
        cell = owner[:, None] * registers + register.astype(np.int64)
        np.minimum.at(flat, cell[hit], points[hit])
        drawn += step
        step = min(64, step * 2) if drawn > 1 else 1
        worst = table.max(axis=1)
        going = points[:, -1] < worst[owner]
        seed, time, owner = seed[going], points[going, -1], owner[going]
        weight, low, width = weight[going], low[going], width[going]
    return table


def band_hashes(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash of each band's registers."""
    bits = mix(table.view(_U)).reshape(len(table), bands, rows)
    total = (bits * powers(0x8EBC6AF09C88C6E3, rows)).sum(axis=2, dtype=_U)
    return mix(total + mix(np.arange(bands, dtype=_U) + _U(101)))


def _signed(batch: pa.RecordBatch, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, "text", SLICE):
        doc, key, count = shingles(part.column("text"))
        table = signatures(doc, key, count, len(part), bands * rows)
        any_word = np.bincount(doc, minlength=len(part)) > 0
        hashes = band_hashes(table[any_word], bands, rows).view(np.int64)
        lists = pa.ListArray.from_arrays(
            np.arange(0, hashes.size + 1, bands, dtype=np.int32), hashes.reshape(-1)
        )
        kept = part.column("key").filter(pa.array(any_word))
        yield pa.RecordBatch.from_arrays([kept, lists], ["key", "bands"])


def sign(texts: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, bands``: the band hashes of each text with a word; others get no row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _signed(batch, bands, rows)
            release()

    return texts.select("key", "text").mapInArrow(task, "key string, bands array<long>")


def band_members(signed: DataFrame) -> DataFrame:
    """``bucket, key, n, l0, l1, l2``: the texts of each band that several share."""
    entry = signed.select("key", F.posexplode("bands").alias("band", "hash"))
    entry = entry.select("key", F.xxhash64("band", "hash").alias("bucket"))
    # The order of texts differs from band to band, so bands with the same texts differ in pairs.
    sized = entry.groupBy("bucket").agg(
        F.count("*").alias("n"),
        *[
            F.min(F.struct(F.xxhash64("key", "bucket", F.lit(i)).alias("h"), F.col("key"))).alias(f"l{i}")
            for i in range(3)
        ],
    )
    sized = sized.where("n > 1").select("bucket", "n", *[f"l{i}.key" for i in range(3)]).toDF(
        "bucket", "n", "l0", "l1", "l2"
    )
    sized = sized.withColumnRenamed("bucket", "_bucket")
    member = entry.join(sized, F.col("bucket") == F.col("_bucket")).drop("_bucket")
    return stash(member, "members")


def candidates(member: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """``a, b`` (a < b): pairs of texts that bands propose, each once.

    All pairs of a band's texts when they are few. A larger band takes a pair of each of its
    texts with three leaders (the smallest by three hashes) and with its next text by a fourth,
    which joins most of a group of near copies with a number of pairs in its size.
    """
    few = member.where(F.col("n") <= pairwise).select("bucket", "key")
    lists = few.groupBy("bucket").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    close = lists.select(
        F.explode(
            F.expr(
                "flatten(transform(sequence(0, size(keys) - 1), i -> transform("
                "slice(keys, i + 2, size(keys)), y -> struct(keys[i] AS a, y AS b))))"
            )
        ).alias("p")
    ).select("p.a", "p.b")
    many = member.where(F.col("n") > pairwise)
    stars = many.select("key", F.explode(F.array("l0", "l1", "l2")).alias("leader"))
    # Chains run within pieces of a band, so no task sorts a whole hot band.
    piece = F.pmod(F.xxhash64("key", "bucket", F.lit("piece")), F.greatest(F.lit(1), F.col("n") / 1000))
    order = Window.partitionBy("bucket", piece.cast("long")).orderBy(
        F.xxhash64("key", "bucket", F.lit("chain")), "key"
    )
    chains = many.select("key", F.lead("key").over(order).alias("leader"))
    wide = stars.union(chains).where("leader IS NOT NULL AND key <> leader")
    wide = wide.select(
        F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b")
    )
    return close.union(wide).distinct()


def _packed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, "text", SLICE):
        doc, key, count = shingles(part.column("text"))
        bounds = np.searchsorted(doc, np.arange(len(part) + 1))
        bags = [
            key[i:j].tobytes() + count[i:j].astype(np.uint32).tobytes()
            for i, j in zip(bounds[:-1], bounds[1:])
        ]
        total = np.bincount(doc, count, len(part)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [part.column("key"), pa.array(bags, pa.binary()), pa.array(total)],
            ["key", "bag", "total"],
        )


def pack_shingles(texts: DataFrame) -> DataFrame:
    """``key, bag, total``: distinct shingle hashes in order and their counts, as binary, and
    the sum of the counts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _packed(batch)
            release()

    return texts.select("key", "text").mapInArrow(task, "key string, bag binary, total long")


def overlap(left: bytes, right: bytes) -> float:
    """Weighted Jaccard similarity of two packed multisets."""
    n, m = len(left) // 12, len(right) // 12
    a, b = np.frombuffer(left, _U, n), np.frombuffer(right, _U, m)
    x, y = np.frombuffer(left, np.uint32, n, 8 * n), np.frombuffer(right, np.uint32, m, 8 * m)
    place = np.minimum(np.searchsorted(b, a), max(m - 1, 0))
    same = b[place] == a if m else np.zeros(n, bool)
    shared = int(np.minimum(x[same], y[place[same]]).sum())
    total = int(x.sum()) + int(y.sum()) - shared
    return shared / total if total else 0.0


def verified(pairs: DataFrame, bags: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``a, b, similarity`` of the pairs whose multisets are similar enough."""
    left = bags.select(F.col("key").alias("a"), F.col("bag").alias("x"))
    right = bags.select(F.col("key").alias("b"), F.col("bag").alias("y"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.array(
                [
                    overlap(x.as_py(), y.as_py())
                    for x, y in zip(batch.column("x"), batch.column("y"))
                ],
                float,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(score)], ["a", "b", "similarity"]
            )

    both = pairs.join(right, "b").join(left, "a")
    scored = both.mapInArrow(task, "a string, b string, similarity double")
    return scored.where(F.col("similarity") >= similarity)


def _elements(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and element of each unit of weight, and the total weight of each text."""
    size = np.array([len(bag) // 12 for bag in bags], np.int64)
    key = np.concatenate([np.frombuffer(bag, _U, n) for bag, n in zip(bags, size)])
    count = np.concatenate([np.frombuffer(bag, np.uint32, n, 8 * n) for bag, n in zip(bags, size)])
    count = count.astype(np.int64)
    text = np.repeat(np.arange(len(bags)), size)
    total = np.bincount(text, count, len(bags)).astype(np.int64)
    unit = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    element = np.repeat(key, count)
    more = unit > 0
    element[more] = mix(element[more] + mix(unit[more].astype(_U)))
    return np.repeat(text, count), element, total


def similar(
    left: list[bytes], right: list[bytes] | None, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs that are similar enough; those of ``left`` (i < j) without ``right``."""
    text, element, total = _elements(left + (right or []))
    rows, texts = len(left), len(total)
    _, element = np.unique(element, return_inverse=True)
    order = np.lexsort((text, element))
    text, element = text[order], element[order]
    often = np.bincount(element)
    shared = np.zeros((texts, texts) if right is None else (rows, texts - rows), np.float32)
    base = 0 if right is None else rows
    rare = (often[element] < COMMON) & (often[element] > 1)
    one, of = text[rare], element[rare]
    for gap in range(1, COMMON - 1):
        same = of[:-gap] == of[gap:]
        i, j = one[:-gap][same], one[gap:][same]
        if right is not None:
            across = (i < rows) & (j >= rows)
            i, j = i[across], j[across]
        np.add.at(shared, (i, j - base), np.float32(1))
        if not same.any():
            break
    names = np.flatnonzero(often >= COMMON)
    for at in range(0, len(names), 4096):
        some = names[at : at + 4096]
        begin, end = np.searchsorted(element, [some[0], some[-1] + 1])
        held = often[element[begin:end]] >= COMMON
        dense = np.zeros((texts, len(some)), np.float32)
        dense[text[begin:end][held], np.searchsorted(some, element[begin:end][held])] = 1
        shared += dense[:rows] @ dense[base:].T
    i, j = np.nonzero(shared)
    if right is None:
        i, j = i[i < j], j[i < j]
    both = shared[i, j].astype(np.int64)
    close = both / (total[i] + total[j + base] - both) >= similarity
    return i[close], j[close]


def _blocks(member: DataFrame, similarity: float) -> DataFrame:
    """Add ``block`` and ``side`` to rows of ``name, key, total, bag``, repeating rows.

    Sides 0 and 1 are compared with each other, side 2 in itself.

    All texts of a name that may be similar enough meet in exactly one block. Names that fit
    in a chunk share blocks. The others are dealt by length, as texts of very different
    lengths are not similar, and by hash into chunks; a block is a chunk, or a pair of chunks
    of the same length class or of neighbouring ones.
    """
    cost = F.greatest("total", F.lit(LEAST)).cast("long")
    base = 1.0001 / min(max(similarity, 0.01), 0.99)
    member = member.withColumns({"_cost": cost, "_class": F.floor(F.log(base, "total"))})
    sizes = member.groupBy("name", "_class").agg(F.sum("_cost").alias("_c"))
    sizes = stash(sizes, "sizes")
    whole = sizes.groupBy("name").agg(
        F.sum("_c").alias("_whole"),
        F.map_from_entries(
            F.collect_list(F.struct("_class", F.ceil(F.col("_c") / CHUNK).cast("long")))
        ).alias("_chunks"),
    ).withColumnRenamed("name", "_name")
    fits = F.col("_whole") <= CHUNK
    bins = whole.where(fits).agg(F.ceil(F.sum("_whole") / CHUNK).alias("n")).first()["n"] or 1
    # Bins are dealt by hash, so they are made smaller than a chunk on average.
    shared = F.concat(F.lit("s"), F.pmod(F.xxhash64("name"), F.lit(2 * int(bins))).cast("string"))
    member = member.join(whole, F.col("name") == F.col("_name"))
    count = "_chunks[_class]"
    member = member.withColumn("_mine", F.expr(f"pmod(xxhash64(key, 'chunk'), {count})"))
    place = "concat_ws('/', name, {}, {}, {}, {})"
    mine, near = ("string(_class)", "string(_mine)"), ("string(_class {} 1)", "string(k)")
    up, down = (near[0].format("+"), near[1]), (near[0].format("-"), near[1])
    same = place.format(mine[0], "string(least(_mine, k))", mine[0], "string(greatest(_mine, k))")
    some = "transform(sequence(0L, coalesce(_chunks[{0}], 1L) - 1L), k -> named_struct('block', {1}, 'side', {2}))"
    next_, last = "_class + 1", "_class - 1"
    parts = [some.format("_class", same, "if(_mine = k, 2, if(_mine < k, 0, 1))")]
    for other, text, side in (
        (next_, place.format(*mine, *up), "0"), (last, place.format(*down, *mine), "1"),
    ):
        parts.append(f"if(_chunks[{other}] is null, array(), {some.format(other, text, side)})")
    large = F.expr(f"concat({', '.join(parts)})")
    alone = F.array(F.struct(shared.alias("block"), F.lit(2).alias("side")))
    member = member.withColumn("_b", F.explode(F.when(fits, alone).otherwise(large)))
    return member.drop("_cost", "_class", "_name", "_whole", "_chunks", "_mine").select(
        "*", "_b.block", "_b.side"
    ).drop("_b")


def _in_block(table: pa.Table, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the similar pairs of a block, for each of its names."""
    name = table["name"].combine_chunks().dictionary_encode().indices.to_numpy()
    side, bags = table["side"].to_numpy(), table["bag"].combine_chunks()
    order = np.lexsort((side, name))
    ends = np.append(np.flatnonzero(np.diff(name[order])) + 1, len(order))
    for begin, end in zip(np.append(0, ends[:-1]), ends):
        own = order[begin:end]
        cut = int((side[own] == 0).sum())  # 0 too when a chunk got no text
        of = [bags[int(i)].as_py() for i in own]
        if 0 < cut < len(own):
            i, j = similar(of[:cut], of[cut:], similarity)
            yield own[i], own[cut + j]
        elif side[own[0]] == 2:
            i, j = similar(of, None, similarity)
            yield own[i], own[j]


def wide_links(
    member: DataFrame, group: DataFrame, bags: DataFrame, similarity: float, pairwise: int
) -> DataFrame | None:
    """``a, b``: links between groups among all pairs of the larger bands; None if all are joined.

    ``group`` is what is linked already, ``node, component``. Bands with the same texts are
    compared once.
    """
    known = group.select(F.col("node").alias("_node"), "component")
    member = member.where(F.col("n") > pairwise).select("bucket", "key")
    member = member.join(known, F.col("key") == F.col("_node"), "left")
    member = member.select("bucket", "key", F.coalesce("component", "key").alias("component"))
    member = stash(member, "wide")
    mixed = member.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"),
        F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("y"),
    ).where("low < high")
    mixed = stash(mixed.groupBy("n", "x", "y").agg(F.min("bucket").alias("_bucket")), "mixed")
    if mixed.isEmpty():
        return None
    member = member.join(mixed.select("_bucket"), F.col("bucket") == F.col("_bucket"))
    member = member.select(F.col("bucket").cast("string").alias("name"), "key", "component")
    member = member.join(bags, "key")

    def task(table: pa.Table) -> pa.Table:
        key = table["key"].combine_chunks()
        group = table["component"].combine_chunks().dictionary_encode().indices.to_numpy()
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(table) and (group != group[0]).any():
            for i, j in _in_block(table, similarity):
                apart = group[i] != group[j]
                left.append(i[apart])
                right.append(j[apart])
        i, j = np.concatenate(left), np.concatenate(right)
        # Of the links between two groups one is enough, and none that close a ring of groups.
        first = {}
        for x, y, a, b in zip(group[i].tolist(), group[j].tolist(), i.tolist(), j.tolist()):
            first.setdefault((x, y), (a, b))
        ends = np.array(list(first), np.int64).reshape(-1, 2)
        kept = forest(len(group), ends[:, 0], ends[:, 1])
        ends = np.array([first[pair] for pair in kept], np.int64).reshape(-1, 2)
        return pa.table({"a": key.take(pa.array(ends[:, 0])), "b": key.take(pa.array(ends[:, 1]))})

    blocks = _blocks(member, similarity).select("block", "side", "name", "key", "component", "bag")
    return blocks.groupBy("block").applyInArrow(task, "a string, b string")


def count_links(group: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """``key, n_links``: how many texts of its group each text is linked with, counted exactly."""

    def task(table: pa.Table) -> pa.Table:
        count = np.zeros(len(table), np.int64)
        for i, j in _in_block(table, similarity):
            count += np.bincount(i, minlength=len(count)) + np.bincount(j, minlength=len(count))
        return pa.table({"key": table["key"], "links": count})

    member = group.select(F.col("component").alias("name"), F.col("node").alias("key"))
    blocks = _blocks(member.join(bags, "key"), similarity).select("block", "side", "name", "key", "bag")
    counted = blocks.groupBy("block").applyInArrow(task, "key string, links long")
    return counted.groupBy("key").agg(F.sum("links").alias("n_links"))


def _grouped(
    documents: DataFrame, similarity: float, pairwise: int, counted: bool = True
) -> DataFrame:
    """``doc_id, key, group_id, n_links``; ``key`` is null for what is like nothing.

    Without ``counted``, ``n_links`` is 0.
    """
    usable = F.col("text").rlike(r"[^\x20\x09-\x0D]") & F.col("doc_id").isNotNull()
    keyed = documents.select("doc_id", "text", F.when(usable, F.md5("text")).alias("key"))
    # Equal texts have one signature; it is made where the texts are, so no text moves.
    signed = sign(keyed.where("key IS NOT NULL")).groupBy("key").agg(
        F.first("bands").alias("bands")
    )
    member = band_members(stash(signed, "signed"))
    pairs = stash(candidates(member, pairwise), "pairs")
    owners = keyed.where("key IS NOT NULL").groupBy("key")
    owners = stash(owners.agg(F.min("doc_id").alias("owner")), "owners")
    # Of the texts in pairs one row each is fetched, by its id, which no other text shares.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("_key")).distinct()
    wanted = wanted.join(owners, F.col("_key") == F.col("key")).select("_key", "owner")
    same = (F.col("doc_id") == F.col("owner")) & (F.col("key") == F.col("_key"))
    texts = keyed.repartition("doc_id").join(wanted, same, "left_semi")
    texts = texts.dropDuplicates(["doc_id", "key"])
    bags = stash(pack_shingles(texts), "bags")
    links = stash(verified(pairs, bags.select("key", "bag"), similarity), "near").select("a", "b")
    group = stash(components(links), "groups")
    wide = wide_links(member, group, bags, similarity, pairwise)
    wide = None if wide is None else stash(wide, "wide-links")
    if wide is not None and not wide.isEmpty():
        # What is joined already goes in as stars, so these rounds only join groups.
        joined = group.where("node <> component").select("node", "component").toDF("a", "b")
        group = stash(components(joined.union(wide)), "groups")
    named = group.join(owners, F.col("node") == F.col("key")).select("node", "component", "owner")
    least = named.groupBy("component").agg(F.min("owner").alias("least"))
    least = named.join(least, "component").select("node", "least")
    owners = owners.join(least, F.col("key") == F.col("node"), "left")
    if counted:
        owners = owners.join(count_links(group, bags, similarity), "key", "left")
    else:
        owners = owners.withColumn("n_links", F.lit(0).cast("long"))
    owners = owners.select(
        F.col("key").alias("_key"), F.coalesce("least", "owner").alias("group_id"), "n_links"
    )
    found = keyed.select("doc_id", "key").join(owners, F.col("key") == F.col("_key"), "left")
    return found.select(
        "doc_id", "key", F.coalesce("group_id", "doc_id").alias("group_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def group_near_copies(
    documents: DataFrame, similarity: float = SIMILARITY, pairwise: int = PAIRWISE
) -> DataFrame:
    """``doc_id, group_id, kept, n_links`` of every document.

    ``group_id`` is the smallest id among the documents reached by links; links join texts
    whose shingle multisets have a weighted Jaccard similarity of at least ``similarity``, and
    equal texts. ``kept`` marks the document that stays. ``n_links`` counts the other texts
    linked directly, all those of its group. Texts without a word (null and empty ones too) are like
    nothing, each a group of its own, and so is a document without an id. Of rows that repeat
    an id, each is judged by its own text.
    """
    found = _grouped(documents, similarity, pairwise)
    kept = F.col("group_id").eqNullSafe(F.col("doc_id"))
    return found.select("doc_id", "group_id", kept.alias("kept"), "n_links")


def drop_near_copies(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents with one left of each group, with their own columns only.

    Rows that repeat both id and text are folded to one; documents without an id all stay.
    """
    found = _grouped(documents, similarity, PAIRWISE, counted=False)
    gone = found.where("key IS NOT NULL AND group_id <> doc_id").select(
        F.col("doc_id").alias("_gone"), F.col("key").alias("_key")
    ).distinct()
    keyed = documents.select(
        F.struct("*").alias("_all"), F.col("doc_id").alias("_id"), F.md5("text").alias("_text")
    )
    same = (F.col("_id") == F.col("_gone")) & (F.col("_text") == F.col("_key"))
    kept = keyed.repartition("_id").join(gone, same, "left_anti")
    unnamed = F.when(F.col("_id").isNull(), F.expr("uuid()"))
    kept = kept.withColumn("_unnamed", unnamed).dropDuplicates(["_id", "_text", "_unnamed"])
    return kept.select("_all.*")
