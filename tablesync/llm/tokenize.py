"""Tokens of whole Arrow batches by classes of bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .text import FOLD, Words, raw


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes of the given ranges, ends included."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


def tokens(texts: pa.Array, inside: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of a class, A-Z in lower case; null is empty.

    Returns the tokens, where each begins, and the bytes of all texts that places count in.
    No token reaches over the end of its text.
    """
    data, offsets = raw(texts)
    rows = len(offsets) - 1
    part = inside[data]
    begins = part.copy()
    begins[1:] &= ~part[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = part[firsts]
    at = np.flatnonzero(begins)
    doc = np.searchsorted(offsets, at, side="right") - 1
    kept = FOLD[data[part]]
    if not len(at):
        empty = Words(doc, np.zeros(0, np.int64), kept, np.zeros(1, np.int64), rows)
        return empty, at, data
    spans = np.append((np.cumsum(part) - part)[at], len(kept)).astype(np.int64)
    coded = pa.Array.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(spans), pa.py_buffer(kept)]
    ).dictionary_encode()
    distinct, ends = raw(coded.dictionary)
    return Words(doc, coded.indices.to_numpy().astype(np.int64), distinct, ends, rows), at, data
