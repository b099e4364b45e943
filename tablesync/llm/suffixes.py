"""Repeated passages cut out by suffix arrays of shards.

Two equal strings of ``length`` bytes have the same least hash among the short strings in them.
So texts are cut into pieces, runs of windows with the same least short string (the anchor), and
pieces with equal anchors go to one shard: all equal windows meet in exactly one. Pieces whose
anchor occurs once are left out by a bit map of the repeated anchors, which has no false
negatives. Equal pieces of a task count once, and so do equal pieces of a shard. Anchors that
too many pieces share are dealt anew by longer strings around them, until a window is its own
anchor.

A shard sorts the suffixes of its pieces by external induced sorting (``induced``), in files,
and gets their common prefixes on the way: windows that share ``length`` bytes with their
neighbours are equal, and all but the first of them in the corpus are covered.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import bit_map, contains, keys_of
from .induced import BATCH, Files, Growing, sorted_suffixes
from .storage import stash
from .text import mix, raw, slices

LENGTH = 100

#: Bytes of an anchor, bits of the bit map of anchors as a power of two.
GRAM, MAP_BITS = 32, 27

#: Bytes of text cut at once, of pieces told apart at once in a task, of pieces of a shard.
SLICE, HELD, SHARD = 256 << 10, 48 << 20, 24 << 20

#: Pieces that may share an anchor.
CROWD = 2048

_U = np.uint64
PIECE = "row long, o long, start long, windows int, lead int, low int, high int, key long, piece binary"


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on, by doubling."""
    base = 0x9FB21C651E98DF25
    own, width = mix(data.astype(np.uint64) + _U(1)), 1
    total, done = None, 0
    while True:
        if gram & width:
            if total is None:
                total, done = own, width
            else:
                power = _U(pow(base, done, 1 << 64))
                size = max(0, min(len(total), len(own) - done))
                total = total[:size] + own[done : done + size] * power
                done += width
        if 2 * width > gram:
            return mix(total)
        size = max(0, len(own) - width)
        own = own[:size] + own[width : width + size] * _U(pow(base, width, 1 << 64))
        width *= 2


def pieces_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple:
    """Runs of windows with one anchor: first byte, windows, the anchor's byte and its hash.

    A window's anchor is the least of its short strings by hash, the first of equal ones, so it
    depends on the window's bytes alone.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, np.zeros(0, _U)
    hashes = gram_hashes(data, gram)
    low = _U((1 << 32) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=_U)
    span, width = length - gram + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    valid = np.zeros(len(data) + 1, np.int8)
    sizes = np.diff(offsets)
    some = sizes >= length
    np.add.at(valid, offsets[:-1][some], 1)
    np.add.at(valid, offsets[1:][some] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(valid[:-1]))
    anchor = (least[at] & low).astype(np.int64)
    fresh = np.ones(len(at), bool)
    fresh[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(fresh)
    windows = np.diff(np.append(first, len(at)))
    return at[first], windows, anchor[first], hashes[anchor[first]]


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The bytes of many places as an array."""
    ends = np.cumsum(size)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)
    return pa.Array.from_buffers(
        pa.large_binary(), len(start),
        [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(data[place])],
    )


def repeated_anchors(numbered: DataFrame, length: int, gram: int) -> np.ndarray:
    """A bit map of the anchors of two pieces or more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, offsets = raw(part.column("text"))
                key, count = np.unique(
                    pieces_of(data, offsets, length, gram)[3], return_counts=True
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.minimum(count, 2).astype(np.int32))],
                    ["key", "n"],
                )

    counted = numbered.select("text").mapInArrow(task, "key long, n int")
    often = counted.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    return bit_map(often, ["key"], MAP_BITS)


def cut_pieces(numbered: DataFrame, often: np.ndarray, length: int, gram: int) -> DataFrame:
    """Pieces with anchors in the map; ``piece`` is null for those that repeat one of the task."""
    shared = numbered.sparkSession.sparkContext.broadcast(often.tobytes())

    def told_apart(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(parts)
        order = np.lexsort([table[name].to_numpy() for name in ("start", "row", "o")])
        table = table.take(pa.array(order)).combine_chunks()
        code = table["piece"].combine_chunks().dictionary_encode().indices.to_numpy()
        first = np.zeros(len(code), bool)
        first[np.unique(code, return_index=True)[1]] = True
        piece = pc.if_else(pa.array(first), table["piece"], pa.scalar(None, pa.large_binary()))
        table = table.set_column(table.schema.get_field_index("piece"), "piece", piece)
        for batch in table.to_batches(max_chunksize=1 << 14):
            yield batch.set_column(
                batch.schema.get_field_index("piece"), "piece", batch["piece"].cast(pa.binary())
            )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, offsets = raw(part.column("text"))
                start, windows, anchor, key = pieces_of(data, offsets, length, gram)
                kept = contains(bits, keys_of([key]))
                start, windows, anchor, key = (x[kept] for x in (start, windows, anchor, key))
                if not len(start):
                    continue
                own = np.searchsorted(offsets, start, side="right") - 1
                n = len(start)
                held.append(pa.table({
                    "row": part.column("row").to_numpy()[own],
                    "o": part.column("o").to_numpy()[own],
                    "start": start - offsets[own], "windows": windows.astype(np.int32),
                    "lead": (anchor - start).astype(np.int32), "low": np.zeros(n, np.int32),
                    "high": np.full(n, length - gram + 1, np.int32), "key": key.view(np.int64),
                    "piece": gathered(data, start, windows + length - 1),
                }))
                size += int(windows.sum()) + n * length
                if size > HELD:
                    yield from told_apart(held)
                    held, size = [], 0
        if held:
            yield from told_apart(held)

    return numbered.select("row", "o", "text").mapInArrow(task, PIECE)


def halved(pieces: DataFrame, length: int) -> DataFrame:
    """Every piece cut in two by how far before the anchor its windows begin.

    All windows of a half share a string around the anchor that is longer than before; its hash
    is the new key.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                middle = (row["low"] + row["high"]) // 2
                split = min(row["windows"], max(0, row["lead"] - middle + 1))
                for begin, end, low, high in (
                    (0, split, middle, row["high"]), (split, row["windows"], row["low"], middle)
                ):
                    if begin == end:
                        continue
                    piece = row["piece"][begin : end + length - 1]
                    lead = row["lead"] - begin
                    core = piece[lead - low : lead - high + 1 + length]
                    key = xxhash.xxh3_64_intdigest(core, seed=low * length + high)
                    rows.append(row | {
                        "start": row["start"] + begin, "windows": end - begin, "lead": lead,
                        "low": low, "high": high, "piece": piece,
                        "key": key - (1 << 64) if key >> 63 else key,
                    })
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    return pieces.mapInArrow(task, PIECE)


def spread(pieces: DataFrame, length: int) -> DataFrame:
    """The pieces with keys that few of them share, or whose windows are all equal."""
    settled = []
    while True:
        crowds = pieces.where("high - low > 1").groupBy("key").agg(F.count("*").alias("n"))
        crowds = stash(crowds.where(F.col("n") > CROWD).select(F.col("key").alias("_key")), "crowds")
        if crowds.isEmpty():
            break
        same = F.col("key") == F.col("_key")
        settled.append(pieces.join(crowds, same, "left_anti"))
        pieces = stash(halved(pieces.join(crowds, same, "left_semi"), length), "halves")
    for more in settled:
        pieces = pieces.union(more)
    return pieces


class Shard:
    """The different pieces of a shard, but for those that are alone with their key."""

    def __init__(self, files: Files, length: int):
        self.files, self.length = files, length
        self.text, self.meta = Growing(files, np.uint16), Growing(files, np.int64)
        self.size = self.count = 0
        self.last = self.open = self.alone = None

    def add(self, batch: pa.RecordBatch) -> np.ndarray:
        """Take the pieces of a sorted batch; returns which of them repeat the one before."""
        piece = batch.column("piece")
        code = piece.dictionary_encode().indices.to_numpy()
        same = np.zeros(len(code), bool)
        same[1:] = code[1:] == code[:-1]
        same[0] = piece[0].as_py() == self.last
        self.last = piece[len(piece) - 1].as_py()
        rows = batch.filter(pa.array(~same))
        if self.alone is not None:
            rows = pa.concat_batches([self.alone, rows])
        if rows.num_rows:
            key = rows.column("key").to_numpy()
            run = np.cumsum(np.append(False, key[1:] != key[:-1]))
            met = np.bincount(run)[run] > 1
            if self.open is not None:
                met |= key == self.open
            self.alone = None if met[-1] else rows.slice(len(key) - 1)
            self.open = int(key[-1]) if met[-1] else None
            self._append(rows.filter(pa.array(met)))
        return same

    def _append(self, rows: pa.RecordBatch) -> None:
        data, offsets = raw(rows.column("piece"))
        sizes = np.diff(offsets)
        symbols = np.ones(len(data) + len(sizes), np.uint16)
        symbols[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data
        inside = np.ones(len(symbols), bool)
        inside[np.cumsum(sizes + 1) - 1] = False
        symbols[inside] += 2
        meta = np.empty((len(sizes), 5), np.int64)
        meta[:, 0] = self.size + offsets[:-1] + np.arange(len(sizes))
        for i, name in enumerate(("windows", "o", "row", "start")):
            meta[:, i + 1] = rows.column(name).to_numpy()
        self.text.add(symbols)
        self.meta.add(meta.ravel())
        self.size += len(symbols)
        self.count += len(sizes)

    def covered(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row, first byte and end of the runs of windows that occur earlier."""
        if not self.count:
            return
        self.text.add(np.zeros(1 + self.length + 4, np.uint16))
        text = self.text.finish()
        meta = self.meta.finish().reshape(-1, 5)
        begin, windows, o, row, start = (np.ascontiguousarray(meta[:, i]) for i in range(5))
        marks = self.files.array(self.size + 1, np.uint8)
        held = np.zeros(0, np.int64)

        def settle(place: np.ndarray, run: np.ndarray) -> None:
            """Mark all windows of each run but the first in the corpus."""
            own = np.searchsorted(begin, place, side="right") - 1
            inside = place - begin[own]
            valid = inside < windows[own]
            place, run, own, inside = (x[valid] for x in (place, run, own, inside))
            order = np.lexsort((start[own] + inside, row[own], o[own], run))
            run = run[order]
            later = np.zeros(len(run), bool)
            later[1:] = run[1:] == run[:-1]
            marks[place[order][later]] = 1

        for place, value in sorted_suffixes(text, self.length, self.files):
            alike = value >= self.length
            joined = np.flatnonzero(~alike)
            if not len(joined):
                held = np.concatenate([held, place])
                continue
            # The run that is open goes on until the first entry that differs.
            head = np.concatenate([held, place[: joined[0]]])
            if len(head) > 1:
                settle(head, np.zeros(len(head), np.int64))
            last = joined[-1]
            held = place[last:].copy()
            place, alike = place[joined[0] : last], alike[joined[0] : last]
            run = np.cumsum(~alike)
            many = alike.copy()
            many[:-1] |= alike[1:]
            if many.any():
                settle(place[many], run[many])
        if len(held) > 1:
            settle(held, np.zeros(len(held), np.int64))
        for low in range(0, len(marks), BATCH):
            place = low + np.flatnonzero(marks[low : low + BATCH])
            if not len(place):
                continue
            own = np.searchsorted(begin, place, side="right") - 1
            first = np.append(place[:1], place[:-1]) != place - 1
            first[0] = True  # a run that goes on here is given in two parts, which overlap
            head = np.flatnonzero(first)
            size = np.diff(np.append(head, len(place)))
            at = start[own[head]] + place[head] - begin[own[head]]
            yield row[own[head]], at, at + size + self.length - 1


SPAN = "row long, first long, end long"


def covered_spans(pieces: DataFrame, length: int) -> DataFrame:
    """``row, first, end``: bytes of windows that occur earlier, by shards of pieces."""
    total = pieces.agg(F.sum(F.length("piece"))).first()[0] or 0
    shards = max(int(-(-total // SHARD)), pieces.sparkSession.sparkContext.defaultParallelism)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Files of this task alone, gone when it ends.
        with tempfile.TemporaryDirectory() as folder:
            shard = Shard(Files(folder), length)
            names = ["row", "first", "end"]
            for batch in batches:
                if not batch.num_rows:
                    continue
                same = shard.add(batch)
                row, start, windows = (
                    batch.column(name).to_numpy()[same].astype(np.int64)
                    for name in ("row", "start", "windows")
                )
                spans = [row, start, start + windows + length - 1]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in spans], names)
            for spans in shard.covered():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in spans], names)

    dealt = pieces.select("key", "piece", "o", "row", "start", "windows").repartition(shards, "key")
    dealt = dealt.sortWithinPartitions("key", "piece", "o", "row", "start")
    return dealt.mapInArrow(task, SPAN)


def _without(texts: pa.Array, firsts: pa.Array, ends: pa.Array) -> list[tuple]:
    """Sizes, removed bytes, spans and the digest of what is left, for each text."""
    rows = []
    for text, first, end in zip(texts, firsts, ends):
        data = text.as_buffer() if text.is_valid else b""
        size = len(data)
        if not first.is_valid:
            rows.append((size, 0, 0, hashlib.sha256(data).hexdigest()))
            continue
        begin = np.asarray(first.values)
        order = np.argsort(begin, kind="stable")
        begin = begin[order]
        stop = np.maximum.accumulate(np.asarray(end.values)[order])
        fresh = np.flatnonzero(np.append(True, begin[1:] > stop[:-1]))
        begin, stop = begin[fresh], stop[np.append(fresh[1:], len(stop)) - 1]
        left = hashlib.sha256()
        at = 0
        view = memoryview(data)
        for low, high in zip(begin.tolist(), stop.tolist()):
            left.update(view[at:low])
            at = high
        left.update(view[at:])
        rows.append((size, int((stop - begin).sum()), len(begin), left.hexdigest()))
    return rows


def cut_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    Each byte that is covered by a string of ``length`` bytes that also begins earlier goes:
    in a document of a smaller ``doc_id``, or further on in the same one; the two may overlap,
    and strings are judged on what is given, not on what is left. ``n_spans`` counts the maximal
    removed runs, ``kept_sha256`` is the digest of the remaining bytes. Null and empty texts,
    and texts shorter than ``length``, keep all they have. Documents without an id come last;
    rows that repeat an id are documents of their own, in the order they are read. Other
    columns are ignored.
    """
    numbered = documents.select(
        "doc_id", "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("o"),
        F.monotonically_increasing_id().alias("row"),
    )
    numbered = stash(numbered, "numbered")
    often = repeated_anchors(numbered, length, gram)
    pieces = stash(cut_pieces(numbered, often, length, gram), "pieces")
    alike = pieces.where("piece IS NULL").select(
        "row", F.col("start").alias("first"), (F.col("start") + F.col("windows") + length - 1).alias("end")
    )
    found = covered_spans(spread(pieces.where("piece IS NOT NULL"), length), length)
    spans = stash(found.union(alike), "spans").groupBy("row").agg(
        F.collect_list(F.struct("first", "end")).alias("spans")
    )
    spans = spans.select(
        F.col("row").alias("_row"), F.col("spans.first").alias("first"), F.col("spans.end").alias("end")
    )
    both = numbered.join(spans, F.col("row") == F.col("_row"), "left")
    kind = documents.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _without(*(batch.column(name) for name in ("text", "first", "end")))
            columns = list(zip(*rows)) if rows else [()] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(list(c), t) for c, t in zip(columns, types)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return both.select("doc_id", "text", "first", "end").mapInArrow(
        task, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
