"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of whole documents in the order of a hash. In every window each
source's deficit grows by its quantum (its target share of the window's tokens) and the
source sends documents while they fit the deficit; what is left is carried to the next
window. As a queue never gains documents, the window that sends a document follows from the
tokens up to its end alone,

    window = ceil(tokens through the document / quantum),

so all windows are filled at once from running totals, and deficits carry over partitions
like over windows. Documents are laid out by window, source and place in the queue, and the
stream is cut into sequences. The tail is cut into powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import stash
from .text import slices
from .tokens import Encoder
from .totals import running_total

SEQUENCE = 2048
END_ID = 1
#: Sequences per window: source shares hold to within a document over that many.
WINDOW_SEQUENCES = 64

_CHUNK = 4096


def tokenise(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, source, tokens, ids``: ids as little-endian 32-bit binary, end id included.

    ``vocabulary`` is a tokenizer file that every executor has; by default the public
    byte-level BPE of 50,257 ids.
    """
    encoders: dict[str | None, Encoder] = {}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in encoders:
            path = vocabulary
            if path is None:
                import public_tokenizers

                path = public_tokenizers.path("byte_bpe_50k.json")
            encoders[vocabulary] = Encoder(path)
        encoder = encoders[vocabulary]
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = encoder.batch(part.column("text"))
                at = offsets + np.arange(len(offsets))
                ended = np.full(at[-1], END_ID, "<u4")
                own = np.ones(at[-1], bool)
                own[at[1:] - 1] = False
                ended[own] = ids
                data = pa.Array.from_buffers(
                    pa.binary(), len(part),
                    [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(ended)],
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"), pa.array(np.diff(at)), data],
                    ["doc_id", "source", "tokens", "ids"],
                )

    kinds = dict(documents.dtypes)
    return documents.select("doc_id", "source", "text").mapInArrow(
        task, f"doc_id {kinds['doc_id']}, source {kinds['source']}, tokens long, ids binary"
    )


def schedule(
    queued: DataFrame, shares: Mapping[str | None, float] | None, window_tokens: int
) -> DataFrame:
    """Add ``position``, the place of a document's first token in the stream.

    ``queued`` has ``_row``, ``doc_id``, ``source`` and ``tokens``. ``shares`` are relative
    target weights by source; by default each source's share of all tokens, which lets the
    queues run dry together. Sources without a share, or whose share is not positive, come
    after the others.
    """
    totals = queued.groupBy("source").agg(F.sum("tokens").alias("_share"))
    if shares is not None:
        spark = queued.sparkSession
        kind = queued.schema["source"].dataType.simpleString()
        given = spark.createDataFrame(
            [(name, float(value)) for name, value in shares.items() if value > 0],
            f"source {kind}, _share double",
        )
        totals = given
    whole = totals.agg(F.sum("_share").alias("all")).first()["all"] or 1
    weights = totals.select(
        F.col("source").alias("_source"),
        (F.col("_share") / F.lit(whole) * window_tokens).alias("_quantum"),
    )
    line = running_total(
        queued, ["source"], F.xxhash64("doc_id", F.lit("pack")), ["doc_id", "_row"],
        "tokens", "_before",
    )
    dealt = line.join(weights, F.col("source").eqNullSafe(F.col("_source")), "left")
    # Integers up to 2 ** 53 are exact here; a tie in rounding only moves a window's edge.
    window = F.ceil((F.col("_before") + F.col("tokens")) / F.col("_quantum") - 1e-9)
    dealt = dealt.withColumn("_window", F.coalesce(window, F.lit((1 << 62))).cast("long"))
    dealt = stash(dealt.select("_row", "source", "tokens", "_before", "_window"), "windows")
    groups = dealt.groupBy("_window", "source").agg(
        F.min("_before").alias("_first"), F.sum("tokens").alias("_size")
    )
    groups = stash(groups, "groups")
    before = lambda order: order.rowsBetween(Window.unboundedPreceding, -1)
    chunk = F.floor(F.col("_window") / _CHUNK)
    rounds = groups.groupBy("_window").agg(F.sum("_size").alias("_size"))
    rounds = rounds.withColumn("_chunk", chunk)
    chunks = rounds.groupBy("_chunk").agg(F.sum("_size").alias("_size"))
    chunks = chunks.select(
        F.col("_chunk").alias("_c"),
        F.sum("_size").over(before(Window.orderBy("_chunk"))).alias("_chunk_base"),
    )  # a row for each 4096 windows, so a row for each half a billion tokens
    rounds = rounds.join(chunks, F.col("_chunk") == F.col("_c")).select(
        F.col("_window").alias("_w"),
        (
            F.coalesce("_chunk_base", F.lit(0))
            + F.coalesce(
                F.sum("_size").over(before(Window.partitionBy("_chunk").orderBy("_window"))),
                F.lit(0),
            )
        ).alias("_base"),
    )
    inner = before(Window.partitionBy("_window").orderBy(F.col("source").asc_nulls_last()))
    starts = groups.withColumn("_inner", F.coalesce(F.sum("_size").over(inner), F.lit(0)))
    starts = starts.join(rounds, F.col("_window") == F.col("_w")).select(
        F.col("_window").alias("_g"), F.col("source").alias("_s"),
        (F.col("_base") + F.col("_inner") - F.col("_first")).alias("_shift"),
    )
    same = (F.col("_window") == F.col("_g")) & F.col("source").eqNullSafe(F.col("_s"))
    return dealt.join(starts, same).select(
        "_row", (F.col("_before") + F.col("_shift")).alias("position")
    )


def tail_bounds(total: int, sequence: int = SEQUENCE) -> np.ndarray:
    """Where the sequences of the tail begin, and the end: powers of two, longest first."""
    rest, at = total % sequence, total - total % sequence
    bounds = [at]
    for power in range(sequence.bit_length() - 1, -1, -1):
        if rest >> power & 1:
            at += 1 << power
            bounds.append(at)
    return np.array(bounds, np.int64)


def pack_documents(
    documents: DataFrame,
    shares: Mapping[str | None, float] | None = None,
    vocabulary: str | None = None,
    sequence: int = SEQUENCE,
    window_sequences: int = WINDOW_SEQUENCES,
) -> DataFrame:
    """One row per piece of a document in a sequence.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, capacity``:
    ids before the piece, its length, the CRC-32 of its ids as little-endian 32-bit numbers,
    the document's tokens (end id included), the sequence and place there, and the
    sequence's length. All sequences are full: ``sequence`` tokens, or a power of two in the
    tail. A null or empty text is its end id alone; repeated rows are packed each; an empty
    table gives no piece.
    """
    tokens = tokenise(documents, vocabulary).withColumn("_row", F.monotonically_increasing_id())
    tokens = stash(tokens, "tokens")
    queued = tokens.select("_row", "doc_id", "source", "tokens")
    placed = schedule(queued, shares, sequence * window_sequences)
    total = queued.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    bounds = tail_bounds(total, sequence)
    full = total // sequence

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("tokens").to_numpy()
            begin = batch.column("position").to_numpy()
            last = begin + sizes - 1

            def sequence_of(at: np.ndarray) -> np.ndarray:
                tail = full + np.searchsorted(bounds, at, side="right") - 1
                return np.where(at < bounds[0], at // sequence, tail)

            first = sequence_of(begin)
            count = sequence_of(last) - first + 1
            row = np.repeat(np.arange(len(batch)), count)
            ends = np.cumsum(count)
            number = first[row] + np.arange(len(row)) - np.repeat(ends - count, count)
            in_tail = np.clip(number - full, 0, len(bounds) - 1)
            opens = np.where(number < full, number * sequence, bounds[in_tail])
            closes = np.where(
                number < full, (number + 1) * sequence,
                bounds[np.minimum(in_tail + 1, len(bounds) - 1)],
            )
            start = np.maximum(opens, begin[row])
            stop = np.minimum(closes, begin[row] + sizes[row])
            ids = batch.column("ids")
            views = [memoryview(one.as_buffer()) for one in ids]
            low, high = (start - begin[row]) * 4, (stop - begin[row]) * 4
            sums = [
                zlib.crc32(views[r][a:b]) for r, a, b in zip(row.tolist(), low.tolist(), high.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(start - begin[row]),
                    pa.array(stop - start),
                    pa.array(sums, pa.int64()),
                    pa.array(sizes[row]),
                    pa.array(number),
                    pa.array(start - opens),
                    batch.column("source").take(pa.array(row)),
                    pa.array(closes - opens),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                 "offset", "source", "capacity"],
            )

    kinds = dict(documents.dtypes)
    joined = tokens.join(placed, "_row").drop("_row")
    return joined.mapInArrow(
        task,
        f"doc_id {kinds['doc_id']}, start long, length long, ids_crc32 long, doc_tokens long, "
        f"sequence_id long, offset long, source {kinds['source']}, capacity long",
    )
