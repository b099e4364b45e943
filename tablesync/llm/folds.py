"""Which rows a model may learn from, and the columns results carry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, modulus: int) -> Column:
    """``crc32`` of the id's text modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % modulus


def held_out(doc_id: Column, modulus: int = 3) -> Column:
    """True for rows kept out of training (remainder 1); false for a null id."""
    return F.coalesce(remainder(doc_id, modulus) == 1, F.lit(False))


#: Bytes of text in a training sample.
TRAINING_BYTES = 32 << 20


@dataclass(frozen=True)
class Sample:
    """Texts to learn from, ``doc_id, label, text``, and how many there are of each label."""

    texts: DataFrame
    counts: dict


def training_sample(
    documents: DataFrame, labels: DataFrame | None, label: str, rows: int,
    size: int = TRAINING_BYTES,
) -> Sample:
    """About ``rows`` texts, as many of each label as there are up to an equal share, of about
    ``size`` bytes together.

    ``labels`` has ``doc_id`` and the label; without it documents carry their own. Rows of
    documents are sampled, not ids: every different text of an id is an example with its own
    label, equal rows are one. Texts that are labelled in two ways teach nothing, nor do null
    texts, labels and ids and held-out ids. Rows are picked by their hash, so reruns agree; a
    label's rows are thinned by a threshold on it, so a label, an id or a text of any size is
    fine, and long texts are as likely to be picked as short ones.
    """
    usable = documents.where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    ).withColumn("_h", F.xxhash64("doc_id", "text"))
    own = [F.col(label).alias("_label")] if labels is None else []
    examples = usable.select("doc_id", "_h", F.octet_length("text").alias("_size"), *own)
    agreed = [F.min("_label").alias("label"), F.max("_label").alias("_other")]
    if labels is None:
        examples = examples.where("_label IS NOT NULL").groupBy("doc_id", "_h", "_size").agg(*agreed)
    else:
        given = labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("_label"))
        given = given.where("_id IS NOT NULL AND _label IS NOT NULL").groupBy("_id").agg(*agreed)
        examples = examples.distinct().join(given, F.col("doc_id") == F.col("_id"))
    examples = examples.where("label = _other").select("doc_id", "_h", "_size", "label")
    sums = examples.groupBy("label").agg(F.count("*").alias("n"), F.sum("_size").alias("b"))
    found = sums.collect()  # a classifier has an output for each label
    place = F.shiftrightunsigned(F.xxhash64("_h", F.lit("sample")), 1) / float(1 << 63)
    picked = F.lit(False)
    for row in sorted(found, key=lambda row: str(row["label"])):
        share = min(rows / row["n"], size / max(1, row["b"])) / len(found)
        picked = picked | ((F.col("label") == F.lit(row["label"])) & (place < share))
    picked = examples.where(picked).select(F.col("doc_id").alias("_id"), F.col("_h").alias("_k"), "label")
    # The sample is bounded by ``rows``, so it may be broadcast.
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_h") == F.col("_k"))
    texts = usable.select("doc_id", "text", "_h").join(F.broadcast(picked), same)
    texts = texts.dropDuplicates(["doc_id", "_h"]).select("doc_id", "label", "text")
    return Sample(texts, {row["label"]: row["n"] for row in found})
