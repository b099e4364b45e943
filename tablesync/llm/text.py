"""Words and hashed features of whole Arrow batches, in numpy.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. Everything works on flat arrays of a batch; each distinct word
of a batch is looked at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The bytes that separate words.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SEPARATORS)] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

#: Tables for ``bytes.translate``: every separator becomes a space, and A-Z lower case in one.
_SPACED = np.where(IS_SPACE, 0x20, np.arange(256)).astype(np.uint8).tobytes()
_FOLDED = np.where(IS_SPACE, 0x20, FOLD).astype(np.uint8).tobytes()

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def mix(value: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (splitmix64's finaliser)."""
    value = value.astype(np.uint64, copy=True)
    value ^= value >> _U(30)
    value *= _U(0xBF58476D1CE4E5B9)
    value ^= value >> _U(27)
    value *= _U(0x94D049BB133111EB)
    value ^= value >> _U(31)
    return value


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct integers in order; sorting them is much quicker here than hashing them."""
    values = np.sort(values)
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    return values[fresh]


def powers(base: int, count: int) -> np.ndarray:
    """``base ** 0 ... base ** (count - 1)`` modulo 2**64."""
    result = np.full(count, base, np.uint64)
    if count:
        result[0] = 1
    return np.multiply.accumulate(result)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and ``len(texts) + 1`` offsets into them; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def letters(data: np.ndarray, fold: bool) -> np.ndarray:
    """The bytes with each separator a space; ``fold`` lower-cases A-Z."""
    return np.frombuffer(data.tobytes().translate(_FOLDED if fold else _SPACED), np.uint8)


def slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` bytes of text: at least a row, no row cut."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


@dataclass
class Words:
    """The words of a batch: ``doc`` and ``code`` per word, bytes per distinct word."""

    doc: np.ndarray
    code: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    rows: int

    @property
    def distinct(self) -> pa.Array:
        return pa.Array.from_buffers(
            pa.large_binary(),
            len(self.offsets) - 1,
            [None, pa.py_buffer(self.offsets), pa.py_buffer(self.data)],
        )

    def per_doc(self, weight: np.ndarray) -> np.ndarray:
        """Sum of a weight per distinct word over the words of each text."""
        return np.bincount(self.doc, weights=weight[self.code], minlength=self.rows)


def words(texts: pa.Array, fold: bool) -> Words:
    """Split texts into words; ``fold`` lower-cases A-Z."""
    data, offsets = raw(texts)
    rows = len(offsets) - 1
    line = letters(data, fold)
    inside = line != 0x20
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]
    at = np.flatnonzero(begins)
    doc = np.repeat(np.arange(rows), np.diff(np.searchsorted(at, offsets)))
    kept = line[inside]
    # From one word's begin to the next there are no other letters than its own.
    lengths = np.add.reduceat(inside, at, dtype=np.int64) if len(at) else at
    spans = np.append(0, np.cumsum(lengths))
    array = pa.Array.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(spans), pa.py_buffer(kept)]
    )
    if not len(at):
        return Words(doc, np.zeros(0, np.int64), kept, np.zeros(1, np.int64), rows)
    coded = array.dictionary_encode()
    distinct, ends = raw(coded.dictionary)
    return Words(doc, coded.indices.to_numpy(), distinct, ends, rows)


def word_hashes(found: Words) -> np.ndarray:
    """A 64-bit hash of each distinct word, the same in every batch."""
    lengths = np.diff(found.offsets)
    if not len(lengths):
        return np.zeros(0, np.uint64)
    place = np.arange(len(found.data)) - np.repeat(found.offsets[:-1], lengths)
    terms = mix(found.data.astype(np.uint64) + _U(1)) * powers(
        0xD6E8FEB86659FD93, int(lengths.max())
    )[place]
    sums = np.add.reduceat(terms, found.offsets[:-1])
    return mix(sums + lengths.astype(np.uint64) * _ODD)


def vocabulary_hashes(vocabulary: pa.Array, step: int = 1 << 15) -> np.ndarray:
    """The same hash of words that are given one by one, ``step`` of them at a time."""
    none = np.zeros(0, np.int64)
    parts = [np.zeros(0, np.uint64)]
    for at in range(0, len(vocabulary), step):
        data, offsets = raw(vocabulary.slice(at, step))
        parts.append(word_hashes(Words(none, none, data, offsets, 0)))
    return np.concatenate(parts)


def gram_features(
    found: Words, lengths: tuple[int, ...], bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each distinct word: itself and its character n-grams.

    Words are framed by marks for their ends, so an n-gram at an end differs from the same
    letters inside. Returns, for each feature, its word and its bucket of ``2 ** bits``.
    """
    hashes = word_hashes(found)
    shift = _U(64 - bits)
    owners = [np.arange(len(hashes))]
    buckets = [(hashes >> shift).astype(np.int64)]
    is_char = (found.data & 0xC0) != 0x80
    chars = np.append(0, np.cumsum(is_char))[found.offsets]
    points = np.frombuffer(
        found.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32
    )
    if len(points) == chars[-1] and len(points):
        count = np.diff(chars)
        word = np.repeat(np.arange(len(hashes)), count + 2)
        framed = np.full(len(word), 1, np.uint64)
        ends = np.cumsum(count + 2)
        framed[ends - 1] = 2
        inner = np.ones(len(word), bool)
        inner[ends - 1] = False
        inner[ends - count - 2] = False
        framed[inner] = points.astype(np.uint64) + _U(3)
        framed = mix(framed)
        for n in lengths:
            if len(framed) < n:
                continue
            total = np.zeros(len(framed) - n + 1, np.uint64)
            for i, power in enumerate(powers(0xC2B2AE3D27D4EB4F, n)):
                total += framed[i : len(framed) - n + 1 + i] * power
            whole = word[: len(total)] == word[n - 1 :]
            owners.append(word[: len(total)][whole])
            buckets.append((mix(total[whole] + _U(n)) >> shift).astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets)
