"""Toxicity: cumulative-link ordinal regression on sparse text features.

Severity grades 0 < 1 < ... < K share one weight per feature; grade ``k`` or worse has the
probability ``sigmoid(x . w - threshold[k])`` with rising thresholds. A text's features are
the hashed words and character n-grams that occur in it, each once. Weights are learned with
follow-the-regularised-leader steps whose L1 term leaves most of them at zero, so a long
harmless text adds up few of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import held_out, training_sample
from .subword import Shape, learned
from .text import distinct, gram_features, slices, words

#: Texts of the training sample; its bytes are bounded in :mod:`.folds`.
TRAINING_ROWS = 6000

#: Grades that labelled toxic texts are divided into, by the weight of evidence in them.
GRADES = 3

SHAPE = Shape(bits=20, grams=(3, 4, 5), fold_case=True, epochs=3)


@dataclass
class Severity:
    """Weights per bucket (sparse: most are 0) and the thresholds of grades 1, 2, ..."""

    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, evidence: np.ndarray) -> np.ndarray:
        """``P(grade >= k)`` for k = 1, 2, ... of each text."""
        gap = np.clip(self.thresholds - evidence[:, None], -500, 500)
        return 1 / (1 + np.exp(gap))


def fit_severity(
    examples: list[tuple], shape: Shape = SHAPE, alpha: float = 0.3, l1: float = 3.0, seed: int = 1
) -> Severity:
    """Fit on ``(grade, buckets, counts)`` examples; grades are 0, 1, ..., K."""
    rng = np.random.default_rng(seed)
    levels = max([1, *(int(grade) for grade, _, _ in examples)])
    lean, spread = np.zeros(shape.rows), np.full(shape.rows, 1e-8)
    weights = np.zeros(shape.rows, np.float32)
    thresholds = np.arange(1.0, levels + 1)
    seen = np.full(levels, 1e-6)
    for _ in range(shape.epochs):
        for i in rng.permutation(len(examples)):
            grade, keys, _ = examples[i]
            grade, keys = int(grade), keys[:-2]  # without the marks of end and repetition
            evidence = float(weights[keys].sum())
            above = 1 / (1 + np.exp(np.clip(thresholds - evidence, -500, 500)))
            bounds = np.concatenate([[1.0], above, [0.0]])
            chance = max(bounds[grade] - bounds[grade + 1], 1e-9)
            slope = bounds[grade] + bounds[grade + 1] - 1  # of the loss, in the evidence
            if abs(slope) > 1e-4:
                before = np.sqrt(spread[keys])
                spread[keys] += slope * slope
                lean[keys] += slope - (np.sqrt(spread[keys]) - before) / alpha * weights[keys]
                held = lean[keys]
                weights[keys] = np.where(
                    np.abs(held) <= l1,
                    0.0,
                    -(held - np.sign(held) * l1) * alpha / (1 + np.sqrt(spread[keys])),
                )
            move = np.zeros(levels)
            if grade > 0:
                move[grade - 1] += bounds[grade] * (1 - bounds[grade]) / chance
            if grade < levels:
                move[grade] -= bounds[grade + 1] * (1 - bounds[grade + 1]) / chance
            seen += move * move
            thresholds = np.maximum.accumulate(thresholds - 0.2 * move / np.sqrt(seen))
    return Severity(weights, thresholds)


def evidence_of(texts: pa.Array, weights: np.ndarray, shape: Shape = SHAPE) -> np.ndarray:
    """Sum of the weights of the features that occur in each text of a slice."""
    found = words(texts, shape.fold_case)
    owner, bucket = gram_features(found, shape.grams, shape.bits)
    telling = weights[bucket] != 0
    owner, bucket = owner[telling], bucket[telling]
    order = np.argsort(owner, kind="stable")
    bucket = bucket[order]
    count = np.bincount(owner, minlength=len(found.offsets) - 1)
    begin = np.cumsum(count) - count
    pairs = distinct(found.doc.astype(np.int64) << 32 | found.code)
    doc, code = pairs >> 32, pairs & 0xFFFFFFFF
    size = count[code]
    ends = np.cumsum(size)
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    at = np.repeat(begin[code], size) + place
    occurs = distinct(np.repeat(doc, size) << 32 | bucket[at])
    values = weights[occurs & 0xFFFFFFFF].astype(np.float64)
    return np.bincount(occurs >> 32, weights=values, minlength=found.rows)


def train_toxicity(
    documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, shape: Shape = SHAPE
) -> Severity | None:
    """Learn grades 0 to ``GRADES`` from the labels' 0/1 flag ``toxic``.

    A first fit has one threshold. Its evidence ranks the toxic texts of the sample, and
    their quantiles are the grades of the second fit. None when no text carries a label.
    """
    sample = training_sample(documents, labels, "toxic", rows)

    def learn(examples: list[tuple]) -> tuple:
        model = fit_severity(examples, shape)
        evidence = np.array([model.weights[keys[:-2]].sum() for _, keys, _ in examples])
        toxic = np.array([label == 1 for label, _, _ in examples], bool)
        if toxic.any():
            cuts = np.quantile(evidence[toxic], np.arange(1, GRADES) / GRADES)
            grades = np.where(toxic, 1 + np.searchsorted(cuts, evidence), 0)
            graded = [(g, keys, counts) for g, (_, keys, counts) in zip(grades, examples)]
            model = fit_severity(graded, shape)
        # Most weights are zero, so the others are handed on with their places.
        kept = np.flatnonzero(model.weights)
        return kept, model.weights[kept], model.thresholds

    found = learned(sample.texts, shape, learn)
    if found is None:
        return None
    weights = np.zeros(shape.rows, np.float32)
    weights[found[0]] = found[1]
    return Severity(weights, found[2])


def grade_toxicity(documents: DataFrame, model: Severity | None) -> DataFrame:
    """All columns of ``documents``, ``toxicity`` (chance of grade 1 or worse) and ``severity``.

    ``severity`` is the expected grade. Null and empty texts hold no evidence. Without a model
    both are 0.
    """
    added = {"toxicity": F.lit(0.0), "severity": F.lit(0.0)}
    rest = documents.drop(*added)
    if model is None:
        return rest.withColumns(added)
    # Sparse weights are sent as their indices: at most 2 ** bits of them.
    kept = np.flatnonzero(model.weights)
    shared = documents.sparkSession.sparkContext.broadcast(
        (kept, model.weights[kept], model.thresholds)
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values, thresholds = shared.value
        weights = np.zeros(SHAPE.rows, np.float32)
        weights[places] = values
        own = Severity(weights, thresholds)
        for batch in batches:
            for part in slices(batch, "text"):
                chances = own.at_least(evidence_of(part.column("text"), weights))
                yield part.append_column("toxicity", pa.array(chances[:, 0])).append_column(
                    "severity", pa.array(chances.sum(axis=1))
                )

    return rest.mapInArrow(task, rest.withColumns(added).schema)


def rate_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, severity`` of every row of ``documents``.

    Null and empty texts hold no evidence. A null id is not held out. Rows that repeat an id
    are rated each by its own text; an id with both labels is not learned from. Without labels
    score and severity are 0.
    """
    graded = grade_toxicity(documents.select("doc_id", "text"), train_toxicity(documents, labels))
    return graded.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "severity",
    )
