"""Quality classifier: supervised subword embeddings (see :mod:`.subword`)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import held_out, training_sample
from .storage import fresh
from .subword import Model, Shape, fit, learned, probabilities
from .text import slices

#: Texts of the training sample; its bytes are bounded in :mod:`.folds`.
TRAINING_ROWS = 8000

SHAPE = Shape(grams=(2, 3))


def train_quality(
    documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, shape: Shape = SHAPE
) -> Model | None:
    """Fit on about ``rows`` labelled texts.

    Both labels get an equal share of the sample while there are enough; their shares among
    all labelled texts are put back as a prior. None when no text carries a label.
    """
    sample = training_sample(documents, labels, "quality", rows)
    counts = sample.counts
    total = sum(counts.values())

    def learn(examples: list[tuple]) -> Model:
        model = fit(examples, shape)
        drawn = Counter(label for label, _, _ in examples)
        for place, label in enumerate(model.classes):
            prior = counts[label] / total * len(examples) / drawn[label]
            model.bias[place] += np.float32(np.log(prior))
        return model

    return learned(sample.texts, shape, learn)


def score_quality(
    documents: DataFrame, model: Model | None, column: str = "quality_score"
) -> DataFrame:
    """All columns of ``documents`` and ``column``: the probability of label 1.

    A column of that name is replaced. Null texts count as empty, and empty texts get the
    score of a text without words. Without a model every score is 0.5; when only one label
    was seen it is that label.
    """
    if model is None:
        return documents.withColumn(column, F.lit(0.5))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # fixed size: see Shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        good = own.classes.index(1) if 1 in own.classes else None
        for batch in batches:
            for part in slices(batch, "text"):
                score = np.zeros(len(part))
                if good is not None:
                    score = probabilities(own, part.column("text"))[:, good]
                yield part.append_column(column, pa.array(score))

    rest = documents.drop(column)
    return rest.mapInArrow(task, rest.withColumn(column, F.lit(0.0)).schema)


def classify_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``documents``.

    Null and empty texts score as texts without words do. A null id is not held out. Rows that
    repeat an id are scored each by its own text, and learned from each with the id's label;
    an id with both labels is not learned from. Without labels every score is 0.5.
    """
    scored = score_quality(documents.select("doc_id", "text"), train_quality(documents, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns only.

    Each row is judged by its own text, whatever its id; see :func:`classify_quality`.
    """
    column = fresh("score", documents.columns)
    scored = score_quality(documents, train_quality(documents, labels), column)
    return scored.where(F.col(column) >= 0.5).select(*documents.columns)
