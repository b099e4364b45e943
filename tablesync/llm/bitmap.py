"""Bit maps of keys with a size that does not grow: no false negatives, some false positives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import mix, powers

#: Hash functions of a map.
HASHES = 3

_U = np.uint64


def keys_of(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of several columns of 64-bit numbers."""
    total = np.zeros(len(columns[0]), _U)
    for column, power in zip(columns, powers(0x9FB21C651E98DF25, len(columns))):
        total += column * power
    return mix(total)


def _places(key: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    shift = _U(64 - (8 * size - 1).bit_length())
    for i in range(HASHES):
        place = key >> shift
        yield (place >> _U(3)).astype(np.int64), (_U(1) << (place & _U(7))).astype(np.uint8)
        key = mix(key + _U(i + 1))


def contains(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    found = np.ones(len(key), bool)
    for byte, bit in _places(key, len(bits)):
        found &= (bits[byte] & bit) != 0
    return found


def bit_map(frame: DataFrame, columns: list[str], power: int) -> np.ndarray:
    """The keys of all rows in a map of ``2 ** power`` bits, made where the rows are."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (power - 3), np.uint8)
        for batch in batches:
            key = keys_of([batch.column(c).to_numpy().view(_U) for c in columns])
            for byte, bit in _places(key, len(bits)):
                np.bitwise_or.at(bits, byte, bit)
        words = bits.view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], ["at", "bits"])

    parts = frame.select(*columns).mapInArrow(task, "at long, bits long")
    table = parts.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (power - 6), np.int64)
    words[table["at"].to_numpy()] = table["bits"].to_numpy()
    return words.view(np.uint8)
