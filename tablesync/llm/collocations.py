"""Phrase collocations counted with broadcast double-array tries.

Phrases are runs of words inside a piece of a text. Their counts are found level by level, from
two words up. Each level has two passes over the encoded texts:

1. Candidates. A run can only be frequent when all its shorter runs are (Apriori), so a position
   counts when the runs of one word less that begin at it and at the next word are in a bit map
   of the frequent ones. A bit map has no false negatives, so no frequent phrase is lost. Of the
   runs left, those stay whose occurrences, counted up to the threshold in each task, reach it.
   Runs are dealt by their hash to parts of a bounded size and handed on as arrays, a row for a
   part: neither the task that finds them nor the one that adds them up has a row for each run.
2. Counts. The candidates, in blocks of a fixed size, become double-array tries, which are
   broadcast one by one. A block has the phrases of a range of first words, so that its trie
   leaves most positions at once. numpy holds the trie state of every text position and advances
   all of them by a word at once; the phrases reached at the last level are counted and the
   counts of all tasks summed.

Words are 64-bit symbols that include the language, so languages never mix. That no two words
share a symbol is checked over all words of the corpus; if two do, other symbols are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bitmap import bit_map, contains, keys_of
from .storage import stash
from .text import mix, raw, slices, vocabulary_hashes, word_hashes
from .tokenize import byte_class, tokens

#: What separates words, and what separates pieces as well.
BLANK = byte_class((0x20, 0x20), (0x09, 0x09))
STOP = byte_class((0x0A, 0x0D))
STOP[list(b".,;:!?")] = True
WORD = ~(BLANK | STOP)

LEAST, LONGEST, TOP = 30, 4, 2000

#: Bits of a bit map of frequent phrases, as a power of two.
MAP_BITS = 25

#: Bits of a digit of a trie, and digits of all its phrases together. The arrays of a trie have
#: up to eight slots of eight bytes for a digit that no other phrase shares: a broadcast stays
#: below about 128 MB, and near half of that as the digits of first words are shared.
DIGIT, BLOCK = 7, 1 << 21
SIBLINGS = 1 << DIGIT

#: Leading bits of a first word's symbol that make a cell: blocks are whole cells, large cells
#: are divided.
CELL = 12

#: Phrases whose counts a task hands on as one row.
PART = 1 << 12

#: Words of the corpus for each part that candidates are dealt to, and so at most the runs of a
#: part that differ; runs of a part that a task hands on at once are in one row.
SHARE = 1 << 20

#: Text encoded as one row, and bytes of encoded texts that go to Python at once: a row or two.
PIECE = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_U = np.uint64


def symbols_of(words: np.ndarray, lang: np.ndarray, seed: int) -> np.ndarray:
    """A symbol for each pair of a word's hash and a language's hash; never zero."""
    return mix(words ^ mix(lang + _U(2 * seed + 1))) | _U(1)


def _languages(part: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    coded = pc.fill_null(part.column("lang").cast(pa.string()), "und").dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def count_words(documents: DataFrame, seed: int) -> DataFrame:
    """``symbol, lang, word, n`` of every word of every language."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                found, _, _ = tokens(part.column("text"), WORD)
                own, names = _languages(part)
                width = max(1, len(found.offsets) - 1)
                pair, count = np.unique(own[found.doc] * width + found.code, return_counts=True)
                lang, word = pair // width, pair % width
                hashes = vocabulary_hashes(pa.array(names, pa.string()))
                symbol = symbols_of(word_hashes(found)[word], hashes[lang], seed)
                text = found.distinct.take(pa.array(word)).cast(pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [_signed(symbol), pa.array(names, pa.string()).take(pa.array(lang)), text,
                     pa.array(count.astype(np.int64))],
                    ["symbol", "lang", "word", "n"],
                )

    counted = documents.select("lang", "text").mapInArrow(
        task, "symbol long, lang string, word string, n long"
    )
    return counted.groupBy("symbol", "lang", "word").agg(F.sum("n").alias("n"))


def encode(documents: DataFrame, frequent: np.ndarray, seed: int) -> DataFrame:
    """Texts as ``symbols`` and a ``stream`` of places in them, a row for megabytes of text.

    A zero in the stream is an end of a piece, or a word too rare to be part of a phrase.
    """
    shared = documents.sparkSession.sparkContext.broadcast(frequent.tobytes())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                found, at, data = tokens(part.column("text"), WORD)
                if not len(at):
                    continue
                own, names = _languages(part)
                width = max(1, len(found.offsets) - 1)
                pair = own[found.doc] * width + found.code
                used, place = np.unique(pair, return_inverse=True)
                hashes = vocabulary_hashes(pa.array(names, pa.string()))
                symbol = symbols_of(
                    word_hashes(found)[used % width], hashes[used // width], seed
                )
                good = contains(bits, keys_of([symbol]))
                number = np.where(good, np.cumsum(good), 0)
                code = number[place]
                ends = np.cumsum(STOP[data])[at]
                fresh = np.ones(len(at), bool)
                fresh[1:] = (ends[1:] != ends[:-1]) | (found.doc[1:] != found.doc[:-1])
                # A zero before each piece; zeros that follow zeros go.
                stream = np.zeros(len(at) + int(fresh.sum()), np.int32)
                stream[np.arange(len(at)) + np.cumsum(fresh)] = code
                kept = stream > 0
                kept[1:] |= stream[:-1] > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([symbol[good].tobytes()], pa.binary()),
                     pa.array([stream[kept].tobytes()], pa.binary())],
                    ["symbols", "stream"],
                )

    return documents.select("lang", "text").mapInArrow(task, "symbols binary, stream binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for symbols, stream in zip(batch.column("symbols"), batch.column("stream")):
            yield (
                np.frombuffer(symbols.as_buffer(), _U), np.frombuffer(stream.as_buffer(), np.int32)
            )


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """For encoded texts, a task's share of which else is one batch; Arrow's buffers for it are
    outside the heap and double as they fill."""
    before = spark.conf.get(_BATCH_BYTES)
    spark.conf.set(_BATCH_BYTES, str(PIECE))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, before)


def _names(length: int) -> list[str]:
    return [f"s{i}" for i in range(length)]


def _dealt(runs: np.ndarray, count: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Runs, one in each line of ``runs``, and their counts: a row for each part that has any."""
    for at in range(0, len(runs), SHARE):
        some = runs[at : at + SHARE]
        part = (keys_of(list(some.T)) % _U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        own, begin = np.unique(part[order], return_index=True)
        ends = np.append(begin, len(order))

        def cut(values: np.ndarray) -> pa.Array:
            spans = (ends * (values.nbytes // len(values))).astype(np.int32)
            return pa.Array.from_buffers(
                pa.binary(), len(own), [None, pa.py_buffer(spans), pa.py_buffer(values[order])]
            )

        yield pa.RecordBatch.from_arrays(
            [pa.array(own), cut(some), cut(count[at : at + SHARE])], ["part", "runs", "counts"]
        )


def _often(table: pa.Table, length: int, least: int) -> np.ndarray:
    """The runs of a part, one in each line, whose counts of all tasks reach ``least``."""
    runs = raw(table["runs"].combine_chunks())[0].view(_U).reshape(-1, length)
    count = raw(table["counts"].combine_chunks())[0].view(np.int32)
    key = keys_of(list(runs.T))
    order = np.argsort(key)
    fresh = np.ones(len(order), bool)
    fresh[1:] = (runs[order[1:]] != runs[order[:-1]]).any(axis=1)
    if (fresh[1:] & (key[order[1:]] == key[order[:-1]])).any():
        # Runs that differ share a hash, so equal ones need not be neighbours.
        order = np.lexsort(runs.T)
        fresh[1:] = (runs[order[1:]] != runs[order[:-1]]).any(axis=1)
    begin = np.flatnonzero(fresh)
    total = np.add.reduceat(count[order], begin, dtype=np.int64)
    return runs[order[begin[total >= least]]]


def candidates(
    encoded: DataFrame, length: int, shorter: np.ndarray | None, least: int, parts: int
) -> DataFrame:
    """``s0, s1, ...``: runs of ``length`` words that may occur ``least`` times.

    ``shorter`` is the bit map of the frequent runs of one word less; None if that is a word,
    as rare words are not in the encoded texts. The runs are added up in ``parts`` parts.
    """
    names = _names(length)
    share = shorter is not None and encoded.sparkSession.sparkContext.broadcast(shorter.tobytes())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(share.value, np.uint8) if share else None
        for symbols, stream in _rows(batches):
            last = len(stream) - length + 1
            if last <= 0:
                continue
            alive = np.ones(last, bool)
            for i in range(length):
                alive &= stream[i : last + i] > 0
            at = np.flatnonzero(alive)
            if bits is not None:
                for step in (0, 1):
                    pieces = [symbols[stream[at + step + i] - 1] for i in range(length - 1)]
                    at = at[contains(bits, keys_of(pieces))]
            columns = [stream[at + i] - 1 for i in range(length)]
            # Two columns at a time become one number, so runs are told apart exactly.
            group = columns[0].astype(np.int64)
            for column in columns[1:]:
                _, group = np.unique(group, return_inverse=True)
                group = group * (len(symbols) + 1) + column
            _, first, count = np.unique(group, return_index=True, return_counts=True)
            runs = np.stack([symbols[column[first]] for column in columns], axis=1)
            yield from _dealt(runs, np.minimum(count, least).astype(np.int32), parts)

    def merged(table: pa.Table) -> pa.Table:
        runs = _often(table, length, least)
        return pa.table({name: _signed(runs[:, i].copy()) for i, name in enumerate(names)})

    found = encoded.mapInArrow(task, "part long, runs binary, counts binary").groupBy("part")
    return found.applyInArrow(merged, ", ".join(f"{name} long" for name in names))


class Trie:
    """A double-array trie over phrases of symbols.

    A symbol's place in the alphabet of the trie is written in digits of ``DIGIT`` bits, so that
    a state has few children whatever the vocabulary. The state after a digit is the slot
    ``base[state] + digit``, which belongs to the state if ``check`` says so. ``accept`` lists
    the slots of whole phrases, in the phrases' order; no digit follows them, so their ``base``
    is the phrase's number.
    """

    def __init__(self, phrases: np.ndarray):
        self.alphabet, codes = np.unique(phrases, return_inverse=True)
        codes = codes.reshape(phrases.shape).astype(np.int64)
        self.digits = max(1, -(-(len(self.alphabet) - 1).bit_length() // DIGIT))
        nodes, parent, label, count = np.zeros(len(phrases), np.int64), [], [], 1
        for depth in range(phrases.shape[1] * self.digits):
            digit = self._digit(codes[:, depth // self.digits], depth % self.digits)
            edge, nodes = np.unique((nodes << DIGIT) + digit, return_inverse=True)
            parent.append(edge >> DIGIT)
            label.append(edge & (SIBLINGS - 1))
            nodes = nodes.ravel() + count
            count += len(edge)
        self.accept = self._place(np.concatenate(parent), np.concatenate(label), count)[nodes]
        self.base[self.accept] = np.arange(len(phrases))

    def _digit(self, code: np.ndarray, place: int) -> np.ndarray:
        return (code >> (DIGIT * (self.digits - 1 - place))) & (SIBLINGS - 1)

    def _place(self, parent: np.ndarray, label: np.ndarray, count: int) -> np.ndarray:
        """Choose the slots of all nodes and fill the arrays.

        States with many children have a run of slots each; the others try random bases in
        rounds, those with more children first, in a part that stays nearly empty.
        """
        rng = np.random.default_rng(1)
        children = np.bincount(parent, minlength=count)
        chosen = np.full(count, -1, np.int64)
        wide = np.flatnonzero(children >= SIBLINGS // 3)
        chosen[wide] = 1 + SIBLINGS * np.arange(len(wide))
        begin = 1 + SIBLINGS * len(wide)
        size = begin + SIBLINGS + 8 * len(parent)
        taken = np.zeros(size, bool)
        rank = np.empty(count, np.int32)
        rank[np.argsort(-children, kind="stable")] = np.arange(count)
        kind = np.frexp(children.astype(float))[1]
        for own in range(int(kind.max()), 0, -1):
            edge = np.flatnonzero((kind[parent] == own) & (chosen[parent] < 0))
            while len(edge):
                state = parent[edge]
                slot = rng.integers(begin, size - SIBLINGS, count)[state] + label[edge]
                bad = taken[slot]
                # Of states that want the same slot the one with most children has it.
                claim = np.full(size, count, np.int32)
                np.minimum.at(claim, slot, rank[state])
                bad |= claim[slot] != rank[state]
                refused = np.zeros(count, bool)
                refused[state[bad]] = True
                done = ~refused[state]
                chosen[state[done]] = slot[done] - label[edge[done]]
                taken[slot[done]] = True
                edge = edge[~done]
        slot = np.zeros(count, np.int64)
        slot[1:] = chosen[parent] + label
        self.base = np.full(size, size - SIBLINGS, np.int32)
        self.base[slot] = np.where(chosen >= 0, chosen, size - SIBLINGS)
        self.check = np.full(size, -1, np.int32)
        self.check[slot[1:]] = slot[parent]
        return slot

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        """The codes of symbols, -1 for those of no phrase."""
        place = np.searchsorted(self.alphabet, symbols)
        place[place == len(self.alphabet)] = 0
        return np.where(self.alphabet[place] == symbols, place, -1)

    def reached(self, code: np.ndarray, length: int) -> np.ndarray:
        """The states at the end of every run of ``length`` words that is a phrase.

        ``code`` has a position's code, or -1. All positions are advanced together.
        """
        at = np.flatnonzero(code >= 0)
        state = np.zeros(len(at), np.int64)
        for step in range(length):
            inside = at + step < len(code)
            at, state = at[inside], state[inside]
            own = code[at + step]
            at, state, own = at[own >= 0], state[own >= 0], own[own >= 0]
            for place in range(self.digits):
                slot = self.base[state] + self._digit(own, place)
                alive = self.check[slot] == state
                at, state, own = at[alive], slot[alive], own[alive]
        return state


def _summed(table: pa.Table) -> pa.Table:
    """The counts of all tasks for a part of a trie's phrases, which have any."""
    rows = [np.frombuffer(row.as_buffer(), np.int64) for row in table["counts"].combine_chunks()]
    total = np.sum(rows, axis=0)
    at = np.flatnonzero(total)
    return pa.table({"at": at + table["part"][0].as_py() * PART, "f": total[at]})


def _blocks(phrases: DataFrame, length: int) -> list[Column]:
    """Conditions that divide phrases into blocks of about ``BLOCK`` digits at most."""
    most = max(1, BLOCK // (3 * length))  # alphabets are below 2 ** 21, so 3 digits
    cell = F.shiftright("s0", 64 - CELL)
    sizes = phrases.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()
    runs: list[list[int]] = []
    for at, n in sorted((row["cell"], row["n"]) for row in sizes):
        if runs and runs[-1][2] + n <= most:
            runs[-1][1:] = [at, runs[-1][2] + n]
        else:
            runs.append([at, at, n])
    found = []
    for low, high, n in runs:
        parts = -(-n // most)
        part = F.pmod(F.xxhash64(*_names(length)), F.lit(parts))
        found += [cell.between(low, high) & (part == i) for i in range(parts)]
    return found


def counts(encoded: DataFrame, phrases: DataFrame, length: int) -> DataFrame:
    """``s0, s1, ..., f``: how often each phrase occurs, overlaps included."""
    spark = encoded.sparkSession
    names = _names(length)
    parts = []
    for block in _blocks(phrases, length):
        own = phrases.where(block).orderBy(*names).toArrow()
        if not len(own):
            continue
        phrase = np.stack([own[name].to_numpy().view(_U) for name in names], axis=1)
        shared = spark.sparkContext.broadcast(Trie(phrase))

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie = shared.value
            found = np.zeros(len(trie.accept), np.int64)
            for symbols, stream in _rows(batches):
                code = np.append(-1, trie.codes(symbols))[stream]
                reached = trie.base[trie.reached(code, length)]
                found += np.bincount(reached, minlength=len(found))
            parts = range(0, len(found), PART)
            yield pa.RecordBatch.from_arrays(
                [pa.array([at // PART for at in parts], pa.int64()),
                 pa.array([found[at : at + PART].tobytes() for at in parts], pa.binary())],
                ["part", "counts"],
            )

        sums = encoded.mapInArrow(task, "part long, counts binary").groupBy("part")
        summed = sums.applyInArrow(_summed, "at long, f long")
        table = pa.table({"at": np.arange(len(phrase))} | {n: own[n] for n in names})
        named = spark.createDataFrame(table.rename_columns(["_at", *names]))
        result = stash(summed.join(named, F.col("at") == F.col("_at")).select(*names, "f"), "counts")
        parts.append(result)
        shared.destroy()  # unpersist() would leave the driver's copy until its garbage is collected
    if not parts:
        schema = ", ".join(f"{name} long" for name in names)
        return spark.createDataFrame([], f"{schema}, f long")
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


def scored(known: DataFrame, longest: int) -> DataFrame:
    """``key, a, l, r, score`` of the phrases that stay; ``known`` has ``key`` and ``f`` of all.

    ``key`` is the array of a phrase's symbols, of one word too.
    """
    phrase = known.where(F.size("key") > 1).select("key", F.col("f").alias("a"))
    cut = F.explode(F.expr("sequence(1, size(key) - 1)")).alias("k")
    cuts = phrase.select("key", "a", cut)
    cuts = cuts.select(
        "key", "a", "k", F.expr("slice(key, 1, k)").alias("first"),
        F.expr("slice(key, k + 1, size(key) - k)").alias("rest"),
    )
    part = known.select(F.col("key").alias("part"), F.col("f"))
    both = cuts.join(part.withColumnRenamed("f", "l"), F.col("first") == F.col("part")).drop("part")
    both = both.join(part.withColumnRenamed("f", "r"), F.col("rest") == F.col("part")).drop("part")
    score = F.expr(
        "CAST(CAST(2000000 * CAST(a AS DECIMAL(31, 0)) AS DECIMAL(38, 0)) div (l + r) AS BIGINT)"
    )
    lowest = both.withColumn("score", score).groupBy("key").agg(
        F.min(F.struct("score", "k", "l", "r", "a")).alias("m")
    )
    lowest = lowest.select("key", "m.a", "m.l", "m.r", "m.score")
    spans = (
        "flatten(transform(sequence(2, size(key) - 1), n -> "
        "transform(sequence(1, size(key) - n + 1), i -> slice(key, i, n))))"
    )
    longer = phrase.where(F.size("key") > 2).select(F.explode(F.expr(spans)).alias("inner"), "a")
    longer = longer.groupBy("inner").agg(F.max("a").alias("most"))
    held = lowest.join(longer, F.col("key") == F.col("inner"), "left")
    wide = "CAST({} AS DECIMAL(31, 0))"
    covered = F.expr(f"100 * {wide.format('most')} >= 80 * {wide.format('a')}")
    return held.where(~F.coalesce(covered, F.lit(False))).drop("inner", "most")


def mine_collocations(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    ``documents`` has ``lang`` (null counts as ``und``) and ``text`` (null counts as empty);
    other columns are ignored, every row counts, also when it repeats another. Words are
    folded from A-Z to lower case; pieces end at ``. , ; : ! ?`` and line ends. ``n`` is the
    number of words of the language, ``a`` how often the phrase of 2 to ``longest`` words
    occurs (``least`` times or more), ``l`` and ``r`` how often the two parts of its
    lowest-scoring cut do, and ``score`` is ``2000000 a / (l + r)`` of that cut, rounded down.
    A phrase inside a longer one that occurs at least 80 % as often goes. Languages without
    a phrase have no rows.
    """
    for seed in range(8):
        words = stash(count_words(documents, seed), "words")
        shared = words.groupBy("symbol").agg(F.count("*").alias("c")).where("c > 1")
        if shared.isEmpty():
            break
    else:
        raise ValueError("no symbols found that tell all words apart")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n")).withColumnRenamed("lang", "_lang")
    totals = stash(totals, "totals")
    frequent = stash(words.where(F.col("n") >= least), "frequent")
    encoded = stash(encode(documents, bit_map(frequent, ["symbol"], MAP_BITS), seed), "encoded")
    known = frequent.select(F.array("symbol").alias("key"), F.col("n").alias("f"))
    parts = max(1, -(-(totals.agg(F.sum("n")).first()[0] or 0) // SHARE))
    shorter = None
    with small_batches(documents.sparkSession):
        for length in range(2, longest + 1):
            found = stash(candidates(encoded, length, shorter, least, parts), f"runs{length}")
            level = counts(encoded, found, length).where(F.col("f") >= least)
            known = known.union(level.select(F.array(*_names(length)).alias("key"), "f"))
            if length < longest:
                shorter = bit_map(level, _names(length), MAP_BITS)
    lexicon = frequent.select(F.col("symbol").alias("_symbol"), "lang", "word")
    best = stash(scored(stash(known, "known"), longest), "scored")
    first = best.withColumn("_first", F.col("key")[0])
    first = first.join(lexicon.select("_symbol", "lang"), F.col("_first") == F.col("_symbol"))
    # Phrases that may be among the first, ties at the end included: first in parts of a
    # language, so that no task sorts all of one, then in the language.
    order = [F.desc("score"), F.desc("a")]
    first = first.withColumn("_part", F.pmod(F.xxhash64("key"), F.lit(64)))
    for group in (["lang", "_part"], ["lang"]):
        place = F.rank().over(Window.partitionBy(*group).orderBy(*order))
        first = first.withColumn("_r", place).where(F.col("_r") <= top)
    first = stash(first.select("key", "lang", "a", "l", "r", "score"), "first")
    spelled = first.select("*", F.posexplode("key").alias("_i", "_s"))
    spelled = spelled.join(lexicon.select("_symbol", "word"), F.col("_s") == F.col("_symbol"))
    text: Column = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "word"))), lambda x: x["word"]), " "
    )
    spelled = spelled.groupBy("key", "lang", "a", "l", "r", "score").agg(text.alias("phrase"))
    ranked = spelled.join(totals, F.col("lang") == F.col("_lang"))
    by = Window.partitionBy("lang").orderBy(*order, F.asc("phrase"))
    ranked = ranked.withColumn("rank", F.row_number().over(by).cast("long"))
    return ranked.where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
