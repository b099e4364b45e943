"""Language ID: averaged hashed subword embeddings with calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import held_out, training_sample
from .storage import fresh
from .subword import Model, Shape, fit, learned, logits_of, probabilities, softmax
from .text import slices

#: Texts of the training sample; its bytes are bounded in :mod:`.folds`.
TRAINING_ROWS = 6000

#: Share of rightly recognised calibration texts that rejection may cost, and the highest
#: threshold it may use: a language with an even chance is never rejected.
REJECT_SHARE = 0.002
HIGHEST_THRESHOLD = 0.5

UNKNOWN = "und"

SHAPE = Shape(grams=(2, 3, 4), fold_case=True, epochs=3)


def calibrate(model: Model, examples: list[tuple]) -> Model:
    """Set the temperature and the rejection threshold from texts kept out of training.

    The temperature minimises the log loss. The threshold is the score below which
    ``REJECT_SHARE`` of the rightly recognised texts fall, at most ``HIGHEST_THRESHOLD``.
    """
    logits = logits_of(model, examples)
    place = {label: i for i, label in enumerate(model.classes)}
    known = np.array([label in place for label, _, _ in examples], bool)
    if not known.any():
        return model
    truth = np.array([place[label] for label, _, _ in examples if label in place])
    logits = logits[known]
    at = np.arange(len(truth))
    grid = np.geomspace(0.25, 8, 41)
    losses = [-np.log(softmax(logits / t)[at, truth] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    scores = softmax(logits / temperature)
    right = scores[at, truth][scores.argmax(axis=1) == truth]
    threshold = float(np.quantile(right, REJECT_SHARE)) if len(right) else 0.0
    return replace(
        model, temperature=temperature, threshold=min(threshold, HIGHEST_THRESHOLD)
    )


def train_languages(
    documents: DataFrame, rows: int = TRAINING_ROWS, shape: Shape = SHAPE
) -> Model | None:
    """Fit on about ``rows`` texts with a language, equal shares; every sixth calibrates.

    None when no text carries a language.
    """
    sample = training_sample(documents, None, "lang", rows)

    def learn(examples: list[tuple]) -> Model:
        apart = [i % 6 == 5 for i in range(len(examples))]
        model = fit([e for e, out in zip(examples, apart) if not out], shape)
        return calibrate(model, [e for e, out in zip(examples, apart) if out])

    return learned(sample.texts, shape, learn)


ADDED = ("lang_pred", "lang_score", "lang_rejected")


def detect_languages(
    documents: DataFrame, model: Model | None, added: tuple[str, str, str] = ADDED
) -> DataFrame:
    """All columns of ``documents`` and those ``added`` (columns of such names are replaced).

    ``lang_pred`` is a learned language, or ``und`` (score 0, rejected) for a text that is
    null or has no letter, or when nothing was learned. ``lang_rejected`` also marks texts
    whose best language scores below the calibrated threshold.
    """
    rest = documents.drop(*added)
    kinds = dict(zip(added, (F.lit(UNKNOWN), F.lit(0.0), F.lit(True))))
    if model is None:
        return rest.withColumns(kinds)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # fixed size: see Shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array(own.classes, object)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                chances = probabilities(own, texts)
                best = chances.argmax(axis=1)
                score = chances[np.arange(len(best)), best]
                letters = pc.match_substring_regex(pc.fill_null(texts, ""), r"\p{L}")
                letters = letters.to_numpy(zero_copy_only=False)
                score = np.where(letters, score, 0.0)
                found = [
                    pa.array(np.where(letters, names[best], UNKNOWN), pa.string()),
                    pa.array(score),
                    pa.array(~letters | (score < own.threshold)),
                ]
                for name, values in zip(added, found):
                    part = part.append_column(name, values)
                yield part

    return rest.mapInArrow(task, rest.withColumns(kinds).schema)


def predict_languages(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row of ``documents``.

    A text that is null, empty or without a letter is ``und`` with score 0. A null id is not
    held out. Rows that repeat an id are predicted, and learned from, each by its own text and
    language; a text of an id that carries two languages is not learned from.
    """
    found = detect_languages(documents.select("doc_id", "text"), train_languages(documents))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def keep_recognised(documents: DataFrame) -> DataFrame:
    """The documents whose language is recognised, with their own columns only.

    Null and empty texts go. Each row is judged by its own text, whatever its id.
    """
    added = tuple(fresh(name, documents.columns) for name in ADDED)
    found = detect_languages(documents, train_languages(documents), added)
    return found.where(~F.col(added[2])).select(*documents.columns)
