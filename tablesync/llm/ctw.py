"""Language-model scores by context-tree weighting over bytes.

A text is a stream of bytes: its words in lower case (A-Z), a space after each, and an end
mark. The next byte is decomposed into eight binary decisions. Each decision has a context
tree over the bytes before it, whose nodes hold Krichevsky-Trofimov estimators; a node's
weighted probability is the even mix of its own estimate and the product of its children's,

    P_w = (P_kt + prod P_w(child)) / 2,

and ``P_w = P_kt`` at full depth. Trained on counts, the tree gives the probability of a byte
after the bytes before it as a mix of the estimates of all depths, weighted by how well each
explained the training text. Only the counts of strings of ``depth + 1`` bytes are needed, and
each distinct string is scored once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .folds import remainder
from .storage import stash
from .subword import release
from .text import distinct, letters, raw, slices, vocabulary_hashes, word_hashes, words

#: Bytes of context; with the next byte they must fit a 64-bit key, so at most 7.
DEPTH = 5

#: Bytes that no UTF-8 text holds, for the end of a text and what precedes it.
END, BEFORE = 0xFF, 0xFE
END_WORD = bytes([END])

#: Characters of text in a block, the unit that texts and scores are joined by.
BLOCK_CHARS = 24 << 20

#: Distinct strings or words that a counting task holds before it hands them on; Spark's own
#: partial aggregation merges what comes more than once.
HELD = 1 << 18

#: Distinct strings or words of a block that are held together; a block of usual text has fewer.
BLOCK_HELD = 1 << 20

#: Places after the first that a lookup tries before it turns to binary search.
PROBES = 4

_U = np.uint64
_SPREAD = _U(0x9E3779B97F4A7C15)


def stream(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all strings of ``depth + 1`` bytes in the streams of texts, and the text of each.

    A key has the predicted byte in its lowest eight bits, the byte before it in the next,
    and so on; before a text come marks.
    """
    data, offsets = raw(texts)
    rows = len(offsets) - 1
    line = letters(data, True)
    inside = line != 0x20
    # A word's bytes stay, and the white space right after it, which becomes a space.
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    filled = offsets[:-1] < offsets[1:]
    firsts = offsets[:-1][filled]
    keep[firsts] = inside[firsts]
    size = np.full(rows, depth + 1, np.int64)
    if len(firsts):
        size[filled] += np.add.reduceat(keep, firsts, dtype=np.int64)
    closed = np.zeros(rows, bool)  # a text that ends in a word gets a space as well
    closed[filled] = inside[offsets[1:][filled] - 1]
    size += closed
    stops = np.cumsum(size)
    # Eight bytes are read at each place, so seven are put before the first.
    padded = np.full(7 + (int(stops[-1]) if rows else 0), 0x20, np.uint8)
    body = padded[7:]
    real = np.ones(len(body), bool)
    for k in range(depth):
        body[stops - size + k] = BEFORE
        real[stops - size + k] = False
    body[stops - 1] = END
    given = real.copy()
    given[stops - 1] = False
    given[stops[closed] - 2] = False
    body[given] = line[keep]
    windows = np.ndarray((len(body),), ">u8", padded.tobytes(), 0, (1,))
    keys = windows[real].astype(np.uint64) & _mask(8 * (depth + 1))
    return keys, np.repeat(np.arange(rows, dtype=np.int32), size - depth)


def _log_rising(n: np.ndarray) -> np.ndarray:
    """``log(1/2 * 3/2 * ... * (n - 1/2))``."""
    table = np.concatenate([[0.0], np.cumsum(np.log(np.arange(4096) + 0.5))])
    small = table[np.minimum(n, 4096)]
    x = np.maximum(n, 4096) + 0.5  # Stirling's series of log gamma(x), less that of 1/2
    far = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n <= 4096, small, far - 0.5 * np.log(np.pi))


def _log_factorial(n: np.ndarray) -> np.ndarray:
    table = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 4097)))])
    small = table[np.minimum(n, 4096)]
    x = np.maximum(n, 4096) + 1.0
    far = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n <= 4096, small, far)


@dataclass
class Level:
    """Binary nodes of one depth and bit: sorted keys, counts of 0 and 1, probabilities."""

    keys: np.ndarray
    zero: np.ndarray
    one: np.ndarray
    own: np.ndarray
    mixed: np.ndarray


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a sorted array and the sums of their values."""
    if not len(keys):
        return keys, values
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(values, starts)


def levels(keys: np.ndarray, counts: np.ndarray) -> list[Level]:
    """The eight levels of binary nodes for byte counts per context (sorted by key)."""
    result = []
    for bit in range(8):
        child, total = _grouped(keys >> _U(7 - bit), counts)
        parent, _ = _grouped(child >> _U(1), total)
        place = np.searchsorted(parent, child >> _U(1))
        is_one = (child & _U(1)).astype(bool)
        zero, one = np.zeros(len(parent), np.int64), np.zeros(len(parent), np.int64)
        zero[place[~is_one]] = total[~is_one]
        one[place[is_one]] = total[is_one]
        own = _log_rising(zero) + _log_rising(one) - _log_factorial(zero + one)
        result.append(Level(parent, zero, one, own, own))
    return result


def _mix(level: Level, children: np.ndarray) -> None:
    level.mixed = np.logaddexp(level.own, children) - np.log(2)


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


def forest(keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[list[Level]]:
    """Levels of all depths from ``top`` to ``depth`` for training counts of full keys."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    result: list[list[Level]] = [[] for _ in range(depth + 1)]
    for d in range(depth, top - 1, -1):
        if d < depth:
            keys = keys & _mask(8 * (d + 1))
            order = np.argsort(keys, kind="stable")
            keys, counts = _grouped(keys[order], counts[order])
        result[d] = levels(keys, counts)
        if d < depth:
            for bit, (level, below) in enumerate(zip(result[d], result[d + 1])):
                place = np.searchsorted(level.keys, below.keys & _mask(8 * d + bit))
                children = np.bincount(place, weights=below.mixed, minlength=len(level.keys))
                _mix(level, children)
    return result


def predict(keys: np.ndarray, trees: list[list[Level]]) -> np.ndarray:
    """Natural log probability of each key's byte after its context.

    Below a context that training never saw every node is empty and estimates one half.
    """
    total = np.zeros(len(keys))
    for bit in range(8):
        is_one = (keys >> _U(7 - bit) & _U(1)).astype(bool)
        chance = np.full(len(keys), 0.5)
        for d in range(len(trees) - 1, -1, -1):
            level = trees[d][bit]
            if not len(level.keys):
                continue
            node = (keys & _mask(8 * (d + 1))) >> _U(8 - bit)
            place = np.minimum(np.searchsorted(level.keys, node), len(level.keys) - 1)
            known = level.keys[place] == node
            place = place[known]
            mine = np.where(is_one[known], level.one[place], level.zero[place])
            own = (mine + 0.5) / (level.zero[place] + level.one[place] + 1.0)
            share = np.exp(np.minimum(level.own[place] - np.log(2) - level.mixed[place], 0.0))
            if d == len(trees) - 1:
                share = 1.0
            chance[known] = share * own + (1 - share) * chance[known]
            chance[~known] = 0.5
        total += np.log(chance)
    return total


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return _grouped(keys[order], counts[order])


def _batches(grams: pa.Array | None, names: pa.Array | None, values: dict) -> Iterator:
    """Record batches of strings or of words, with further columns."""
    size = len(grams if names is None else names)
    columns = [
        pa.nulls(size, pa.int64()) if grams is None else grams,
        pa.nulls(size, pa.binary()) if names is None else names.cast(pa.binary()),
        *(pa.array(value) for value in values.values()),
    ]
    table = pa.Table.from_arrays(columns, ["gram", "word", *values])
    yield from table.combine_chunks().to_batches(max_chunksize=1 << 16)


class Lookup:
    """Values by integers, for looking up only integers that are there.

    Multiplied by an odd number different integers stay different and their upper bits are
    spread, so most are found within a few places of where their upper bits begin.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(1, len(keys).bit_length())
        self.shift = _U(64 - bits)
        self.keys, self.values = _by_key(keys * _SPREAD, values)
        count = np.bincount((self.keys >> self.shift).view(np.int64), minlength=1 << bits)
        self.begins = (np.cumsum(count) - count).astype(np.int32)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        found = np.empty(len(keys))
        for first in range(0, len(keys), 1 << 16):
            own = keys[first : first + (1 << 16)] * _SPREAD
            at = self.begins.take((own >> self.shift).view(np.int64)).astype(np.int64)
            left = np.flatnonzero(self.keys.take(at) != own)
            for _ in range(PROBES):
                at[left] += 1
                # A key that is there lies at or after its place, so none runs past the end.
                left = left[self.keys.take(at.take(left)) != own.take(left)]
            at[left] = np.searchsorted(self.keys, own[left])
            found[first : first + len(own)] = self.values.take(at)
        return found


def _by_key(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], values[order]


def tally(documents: DataFrame, depth: int) -> DataFrame:
    """``gram, word, n``: each string and each word, and its count in ``learned`` texts.

    The end of a text counts as a word.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
        held: list[pa.Table] = []
        ends = texts = 0

        def strings_merged() -> None:
            merged = _summed(np.concatenate(grams), np.concatenate(counts))
            grams[:], counts[:] = [merged[0]], [merged[1]]

        def words_merged() -> None:
            table = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            held[:] = [table.rename_columns(["word", "n"]).combine_chunks()]

        def strings_out() -> Iterator[pa.RecordBatch]:
            yield from _batches(pa.array(grams[0].view(np.int64)), None, {"n": counts[0]})
            grams[:], counts[:] = [np.zeros(0, _U)], [np.zeros(0, np.int64)]

        def words_out() -> Iterator[pa.RecordBatch]:
            table = held.pop()
            values = {"n": table["n"].combine_chunks()}
            yield from _batches(None, table["word"].combine_chunks(), values)

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                learned = part.column("learned").to_numpy(zero_copy_only=False)
                ends, texts = ends + int(learned.sum()), texts + len(part)
                keys, doc = stream(part.column("text"), depth)
                use = learned[doc]
                # Sorting in place is the quickest way to count integers here.
                for own, weight in ((keys[use], 1), (keys[~use], 0)):
                    own, n = np.unique(own, return_counts=True)
                    grams.append(own)
                    counts.append(n.astype(np.int64) * weight)
                found = words(part.column("text"), True)
                count = np.bincount(
                    found.code, weights=learned[found.doc], minlength=len(found.offsets) - 1
                )
                held.append(pa.table({"word": found.distinct, "n": count.astype(np.int64)}))
                if sum(map(len, grams)) > 3 * HELD:
                    strings_merged()
                    if len(grams[0]) > HELD:
                        yield from strings_out()
                if sum(map(len, held)) > 2 * HELD:
                    words_merged()
                    if len(held[0]) > HELD // 2:
                        yield from words_out()
            release()
        if texts:
            held.append(pa.table({"word": pa.array([END_WORD], pa.large_binary()), "n": [ends]}))
            words_merged()
            yield from words_out()
            strings_merged()
            yield from strings_out()

    found = documents.select("learned", "text").mapInArrow(
        task, "gram long, word binary, n long"
    )
    return found.groupBy("gram", "word").agg(F.sum("n").alias("n"))


def asked_of(blocked: DataFrame, depth: int) -> DataFrame:
    """``block, gram, word``: the distinct strings and words that each block holds.

    A string may come more than once for a block.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[int, list[np.ndarray]] = {}
        names: dict[int, list[pa.Array]] = {}

        def hand_on(block: int, last: bool) -> Iterator[pa.RecordBatch]:
            own = distinct(np.concatenate(grams.pop(block)))
            if last or len(own) > BLOCK_HELD:
                numbers = np.full(len(own), block, np.int64)
                yield from _batches(pa.array(own.view(np.int64)), None, {"block": numbers})
            else:
                grams[block] = [own]
            word = pa.chunked_array(names.pop(block)).unique()
            if last or len(word) > BLOCK_HELD:
                yield from _batches(None, word, {"block": np.full(len(word), block, np.int64)})
            else:
                names[block] = [word]

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                numbers = part.column("block").to_numpy()
                for block in np.unique(numbers):
                    own = int(block)
                    texts = part.column("text").filter(pa.array(numbers == block))
                    found = words(texts, True)
                    grams.setdefault(own, [np.zeros(0, _U)]).append(
                        distinct(stream(texts, depth)[0])
                    )
                    names.setdefault(own, [pa.array([END_WORD], pa.large_binary())]).append(
                        found.distinct
                    )
                    if max(sum(map(len, grams[own])), sum(map(len, names[own]))) > BLOCK_HELD * 3 // 2:
                        yield from hand_on(own, False)
                        grams.setdefault(own, [np.zeros(0, _U)])
                        names.setdefault(own, [pa.array([END_WORD], pa.large_binary())])
            release()
        for block in list(grams):
            yield from hand_on(block, True)

    return blocked.mapInArrow(task, "gram long, word binary, block long")


def _keyed(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for batch in batches:
        keys.append(batch.column("gram").to_numpy().view(_U))
        counts.append(batch.column("n").to_numpy())
    return np.concatenate(keys), np.concatenate(counts)


def gram_scores(grams: DataFrame, depth: int) -> DataFrame:
    """``gram, value``: the log10 probability of each string's last byte.

    ``grams`` has every string once with its training count, which may be 0. Trees are
    built where their last two context bytes meet; at most 256 ** (depth - 1) strings share
    those. The two depths above have at most 256 * 256 counts and are built by the driver.
    """
    spark = grams.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts_of = F.expr("(gram >> 8) & 65535")

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = _keyed(batches)
        trained = counts > 0
        trees = forest(keys[trained], counts[trained], depth, 2)
        for bit in range(8):
            level = trees[2][bit]
            parent, sums = _summed(level.keys & _mask(8 + bit), level.mixed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(parent), bit, np.int32)),
                    pa.array(parent.astype(np.int64)),
                    pa.array(sums),
                ],
                ["bit", "node", "mixed"],
            )

    dealt = grams.repartition(parts, parts_of)
    above = dealt.mapInArrow(roots, "bit int, node long, mixed double")
    above = above.groupBy("bit", "node").agg(F.sum("mixed").alias("mixed")).toPandas()
    pairs = grams.where("n > 0").groupBy(F.expr("gram & 65535").alias("gram"))
    pairs = pairs.agg(F.sum("n").alias("n")).toPandas()
    keys, counts = _summed(pairs["gram"].to_numpy().astype(_U), pairs["n"].to_numpy(np.int64))
    first = levels(keys, counts)
    for bit, level in enumerate(first):
        own = above[above["bit"] == bit]
        place = np.searchsorted(level.keys, own["node"].to_numpy().astype(_U))
        _mix(level, np.bincount(place, weights=own["mixed"], minlength=len(level.keys)))
    low, low_counts = _summed(keys & _mask(8), counts)
    root = levels(low, low_counts)
    for bit, (level, below) in enumerate(zip(root, first)):
        place = np.searchsorted(level.keys, below.keys & _mask(bit))
        _mix(level, np.bincount(place, weights=below.mixed, minlength=len(level.keys)))
    shared = spark.sparkContext.broadcast((root, first))  # at most 65,536 counts

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = _keyed(batches)
        trained = counts > 0
        trees = forest(keys[trained], counts[trained], depth, 2)
        trees[0], trees[1] = shared.value
        value = predict(keys, trees) / np.log(10)
        for at in range(0, len(keys), 1 << 17):
            span = slice(at, at + (1 << 17))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[span].view(np.int64)), pa.array(value[span])], ["gram", "value"]
            )

    return dealt.mapInArrow(scores, "gram long, value double")


def score_texts(
    documents: DataFrame, learned: Column, depth: int = DEPTH, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The columns but ``text``, and ``n_tokens, n_known, train_tokens, base_score, score,
    n_bytes, bits_per_byte``.

    ``learned`` marks the texts to learn from. ``score`` is the model's log10 probability of
    the text; ``bits_per_byte`` its code length over the bytes of the stream. The base
    is a smoothed word model: each word and the end of a text, counted as a word, adds
    ``log10((c + 0.5) / (N + 0.5 * (V + 1)))`` with its count, the number of all and of
    distinct ones in training texts. A null text is empty and consists of its end. With
    nothing to learn from every decision has probability one half.

    Texts and scores meet in blocks of about ``block_chars`` characters: a block asks for the
    words it holds, so neither side is ever held whole.
    """
    marked = documents.withColumn("learned", F.coalesce(learned, F.lit(False)))
    counted = stash(tally(marked, depth), "counts")
    known_words = counted.where("word IS NOT NULL")
    totals = known_words.where("n > 0").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("kinds")
    ).first()
    tokens, floor = totals["tokens"], totals["tokens"] + 0.5 * (totals["kinds"] + 1)
    scores = gram_scores(counted.where("gram IS NOT NULL").select("gram", "n"), depth)
    scores = stash(scores, "scores")
    size = documents.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_chars))
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Texts are dealt to blocks once: both uses below read the same exchange.
    # Rows that repeat each other go to different ones.
    place = F.xxhash64("doc_id", F.length("text"), F.monotonically_increasing_id())
    place = F.pmod(place, F.lit(blocks))
    dealt = documents.withColumn("block", place).repartition(max(parts, blocks), "block")
    valued = scores.withColumn("word", F.lit(None).cast("binary")).unionByName(
        known_words.select(
            F.lit(None).cast("long").alias("gram"), "word", F.col("n").cast("double").alias("value")
        )
    )
    # Both kinds meet by one number; the word itself is compared after it.
    hashed = F.xxhash64("word").bitwiseOR(F.lit(-(1 << 63)))
    key = F.coalesce(F.col("gram"), hashed)
    valued = valued.withColumn("_key", key).withColumnRenamed("word", "_word").drop("gram")
    asked = asked_of(dealt, depth).select(key.alias("key"), "word", "block")
    no_word = F.col("_word").isNull()
    same_word = F.when(F.col("word").isNull(), no_word).otherwise(F.col("word") == F.col("_word"))
    both = asked.join(valued, (F.col("key") == F.col("_key")) & same_word)
    gram = F.when(no_word, F.col("key")).alias("gram")
    model = both.select("block", gram, "word", "value")
    added = pa.schema(
        [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
         ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()),
         ("bits_per_byte", pa.float64())]
    )
    names = [name for name in documents.columns if name != "text"]

    def answer(texts: pa.Table, model: pa.Table) -> pa.Table:
        of_gram = model["gram"].is_valid().to_numpy()
        values = model["value"].to_numpy()
        chance = Lookup(model["gram"].drop_null().to_numpy().view(_U), values[of_gram])
        # Within a block words are told apart by 64 bits of their hash.
        hashes = [vocabulary_hashes(chunk) for chunk in model["word"].drop_null().chunks]
        word, count = _by_key(np.concatenate([*hashes, np.zeros(0, _U)]), values[~of_gram])
        base = np.log10((count + 0.5) / floor)
        end = int(np.searchsorted(word, vocabulary_hashes(pa.array([END_WORD]))[0]))
        done = []
        for batch in texts.to_batches():
            for part in slices(batch, "text", 1 << 20):
                found = words(part.column("text"), True)
                keys, doc = stream(part.column("text"), depth)
                score = np.bincount(doc, weights=chance(keys), minlength=found.rows)
                letters = np.bincount(doc, minlength=found.rows)
                at = np.searchsorted(word, word_hashes(found))
                columns = [
                    np.bincount(found.doc, minlength=found.rows) + 1,
                    found.per_doc((count[at] > 0) * 1.0) + (count[end] > 0),
                    np.full(found.rows, tokens),
                    found.per_doc(base[at]) + base[end],
                    score,
                    letters,
                    -score * np.log2(10) / letters,
                ]
                typed = [pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, added)]
                kept = part.select(names)
                done.append(pa.RecordBatch.from_arrays(kept.columns + typed, names + added.names))
        release()
        return pa.Table.from_batches(done)

    out = documents.select(*names).withColumns(
        {
            "n_tokens": F.lit(0).cast("long"), "n_known": F.lit(0).cast("long"),
            "train_tokens": F.lit(0).cast("long"), "base_score": F.lit(0.0),
            "score": F.lit(0.0), "n_bytes": F.lit(0).cast("long"), "bits_per_byte": F.lit(0.0),
        }
    ).schema
    return dealt.groupBy("block").cogroup(model.groupBy("block")).applyInArrow(answer, out)


def score_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte`` of every document; rows whose id's remainder by 5 is 1 are held out."""
    part = remainder(F.col("doc_id"), 5)
    scored = score_texts(documents.select("doc_id", "text"), part != 1)
    return scored.select(
        "doc_id",
        F.coalesce(part == 1, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte",
    )
