"""Averaged hashed subword embeddings with a linear softmax.

A text is the mean of learned vectors: one for each word, one for each character n-gram of
a word, one for each word that repeats the one before it, and one for the end of the text
(so an empty text has a vector too). Training is stochastic gradient descent in numpy with
a step size per vector; it sees a bounded sample of texts as bags of buckets.

Vectors are averaged and then multiplied by the softmax weights, so for scoring both are
folded into one number per bucket and class. Scoring looks at each distinct word of a batch
once.
"""

from __future__ import annotations

import gc
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import Words, gram_features, slices, words


@dataclass(frozen=True)
class Shape:
    """Sizes of a model. ``bits``: buckets as a power of two; ``grams``: n-gram lengths."""

    bits: int = 18
    grams: tuple[int, ...] = (2, 3, 4)
    dimensions: int = 12
    epochs: int = 4
    least_steps: int = 12000
    rate: float = 0.08
    fold_case: bool = False

    def passes(self, examples: int) -> int:
        """Passes over the examples: ``epochs``, or more until ``least_steps`` are made."""
        return max(self.epochs, -(-self.least_steps // max(1, examples)))

    @property
    def end(self) -> int:
        return 1 << self.bits

    @property
    def repeat(self) -> int:
        return self.end + 1

    @property
    def rows(self) -> int:
        return self.end + 2


@dataclass
class Model:
    """``table[bucket, class]``: what a bucket adds to a class's logit before averaging."""

    shape: Shape
    classes: list
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0


def repeats(found: Words) -> np.ndarray:
    """Words of each text that equal the word before them."""
    same = (found.code[1:] == found.code[:-1]) & (found.doc[1:] == found.doc[:-1])
    return np.bincount(found.doc[1:][same], minlength=found.rows)


def bags_of(part: pa.RecordBatch, shape: Shape) -> tuple[list[bytes], list[bytes]]:
    """Buckets and their counts of every text of a slice."""
    found = words(part.column("text"), shape.fold_case)
    owner, bucket = gram_features(found, shape.grams, shape.bits)
    by_owner = np.argsort(owner, kind="stable")
    bucket = bucket[by_owner].astype(np.int32)
    ends = np.cumsum(np.bincount(owner, minlength=len(found.offsets) - 1))
    bounds = np.searchsorted(found.doc, np.arange(found.rows + 1))
    again = repeats(found)
    keys, counts = [], []
    for row in range(found.rows):
        code, n = np.unique(found.code[bounds[row] : bounds[row + 1]], return_counts=True)
        own = [bucket[(ends[c - 1] if c else 0) : ends[c]] for c in code]
        flat = np.concatenate([*own, np.array([shape.end, shape.repeat], np.int32)])
        weight = np.append(np.repeat(n, [len(x) for x in own]), [1, again[row]])
        key, place = np.unique(flat, return_inverse=True)
        keys.append(key.astype(np.int32).tobytes())
        counts.append(np.bincount(place, weights=weight).astype(np.float32).tobytes())
    return keys, counts


def learned(texts: DataFrame, shape: Shape, learn: Callable[[list[tuple]], Any]) -> Any:
    """What ``learn`` makes of the examples ``(label, buckets, counts)`` of a bounded sample.

    ``texts`` has ``doc_id``, ``label`` and ``text``. Bags are made where the texts are; one
    task on an executor gets them, in the order of ``doc_id``, and learns, and the driver is
    handed the finished model alone. None when there is no example.
    """

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                keys, counts = bags_of(part, shape)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(keys, pa.binary()),
                     pa.array(counts, pa.binary())],
                    ["doc_id", "label", "keys", "counts"],
                )

    def model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            # The arrays are views of the batch, so nothing is held twice.
            keys, counts = _views(batch["keys"], np.int32), _views(batch["counts"], np.float32)
            examples += zip(batch["label"].to_pylist(), keys, counts)
        found = [pickle.dumps(learn(examples))] if examples else []
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["model"])

    kind = texts.schema["label"].dataType.simpleString()
    id_kind = texts.schema["doc_id"].dataType.simpleString()
    bagged = texts.mapInArrow(bag, f"doc_id {id_kind}, label {kind}, keys binary, counts binary")
    ordered = bagged.repartition(1).sortWithinPartitions("doc_id", "label", "keys")
    rows = ordered.mapInArrow(model, "model binary").collect()  # at most one
    return pickle.loads(rows[0]["model"]) if rows else None


def _views(column: pa.Array, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), kind) for value in column]


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def fit(examples: list[tuple], shape: Shape, seed: int = 1) -> Model:
    """Stochastic gradient descent over the examples; classes are the labels seen."""
    classes = sorted({label for label, _, _ in examples})
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (shape.rows, shape.dimensions)).astype(np.float32)
    vectors /= shape.dimensions
    weights = np.zeros((shape.dimensions, len(classes)), np.float32)
    bias = np.zeros(len(classes), np.float32)
    seen = np.full(shape.rows, 1e-12, np.float32)
    seen_weights = np.full(weights.shape, 1e-6, np.float32)
    seen_bias = np.full(len(classes), 1e-6, np.float32)
    target = {label: i for i, label in enumerate(classes)}
    passes = shape.passes(len(examples))
    done, steps = 0, max(1, len(examples) * passes)
    for _ in range(passes):
        for i in rng.permutation(len(examples)):
            label, keys, counts = examples[i]
            rate = shape.rate * (1 - done / steps)
            share = counts / counts.sum()
            own = vectors[keys]
            hidden = share @ own
            error = softmax(hidden @ weights + bias)
            error[target[label]] -= 1
            back = weights @ error
            step = np.outer(hidden, error)
            seen_weights += step * step
            seen_bias += error * error
            weights -= rate * step / np.sqrt(seen_weights)
            bias -= rate * error / np.sqrt(seen_bias)
            size = float(back @ back)
            if size > 0:
                total = seen[keys] + share * share * size
                seen[keys] = total
                vectors[keys] = own - np.outer(rate * share / np.sqrt(total), back)
            done += 1
    return Model(shape, classes, vectors @ weights, bias)


def release() -> None:
    """Hand the memory of arrays that are no longer used back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def logits_of(model: Model, examples: list[tuple]) -> np.ndarray:
    if not examples:
        return np.zeros((0, len(model.classes)))
    return np.stack(
        [counts @ model.table[keys] / counts.sum() + model.bias for _, keys, counts in examples]
    )


def probabilities(model: Model, texts: pa.Array) -> np.ndarray:
    """Class probabilities of a slice of texts."""
    shape = model.shape
    found = words(texts, shape.fold_case)
    owner, bucket = gram_features(found, shape.grams, shape.bits)
    distinct = len(found.offsets) - 1
    again = repeats(found)
    size = 1 + again + found.per_doc(np.bincount(owner, minlength=distinct).astype(float))
    logits = np.empty((found.rows, len(model.classes)))
    for c in range(len(model.classes)):
        column = model.table[:, c].astype(np.float64)
        own = np.bincount(owner, weights=column[bucket], minlength=distinct)
        total = found.per_doc(own) + column[shape.end] + again * column[shape.repeat]
        logits[:, c] = total / size + model.bias[c]
    return softmax(logits / model.temperature)
