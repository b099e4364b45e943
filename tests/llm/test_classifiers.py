from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablesync.llm.folds import held_out, training_sample
from tablesync.llm.langid import (
    UNKNOWN, detect_languages, keep_recognised, predict_languages, train_languages,
)
from tablesync.llm.quality import classify_quality, keep_good, score_quality, train_quality
from tablesync.llm.subword import Shape, fit, softmax
from tablesync.llm.text import gram_features, words
from tablesync.llm.toxicity import SHAPE as TOXIC
from tablesync.llm.toxicity import (
    Severity, evidence_of, fit_severity, grade_toxicity, rate_toxicity, train_toxicity,
)


def test_folds(rows):
    found = rows("doc_id long", (1,), (2,), (5,), (None,)).select("doc_id", held_out(F.col("doc_id")))
    for doc_id, out in found.collect():
        assert out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1)


def test_the_sample_is_bounded_and_leaves_held_out_rows(rows):
    frame = rows("doc_id long, text string", *[(i, f"t{i}") for i in range(600)], (None, "n"), (601, None))
    labels = rows("doc_id long, quality int", *[(i, i % 2) for i in range(602)], (None, 1), (7, None))
    sample = training_sample(frame, labels, "quality", 100)
    got = sample.texts.collect()
    assert 40 <= len(got) <= 160
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in got)
    assert all(r.label == r.doc_id % 2 and r.text == f"t{r.doc_id}" for r in got)
    few = training_sample(frame, labels, "quality", 600, size=100).texts.count()
    assert 5 <= few <= 70  # texts have up to four bytes


def test_a_hot_id_teaches_each_text_its_own_language(rows):
    """Five hundred rows of one id in two languages: an example a row, none with another label."""
    hot = [(1, f"{lang} {i}", lang) for i in range(250) for lang in ("en", "fr")]
    assert zlib.crc32(b"1") % 3 != 1
    repeated = [(1, "en 0", "en")] * 50 + [(1, "both", "en"), (1, "both", "fr")]
    frame = rows("doc_id long, text string, lang string", *hot, *repeated)
    sample = training_sample(frame, None, "lang", 10_000)
    got = sample.texts.collect()
    assert sample.counts == {"en": 250, "fr": 250} and len(got) == 500
    assert all(r.text.startswith(r.label) for r in got)
    some = training_sample(frame, None, "lang", 100).texts.count()
    assert 60 <= some <= 140


def test_ids_with_both_labels_teach_nothing(rows):
    frame = rows("doc_id long, text string", (2, "a"), (2, "b"), (3, "c"), (5, "d"))
    labels = rows("doc_id long, quality int", (2, 1), (2, 1), (3, 0), (3, 1), (5, 0))
    sample = training_sample(frame, labels, "quality", 1000)
    got = sorted((r.doc_id, r.text, r.label) for r in sample.texts.collect())
    assert got == [(i, t, q) for i, t, q in ((2, "a", 1), (2, "b", 1), (5, "d", 0))
                   if zlib.crc32(str(i).encode()) % 3 != 1]


def test_long_texts_are_learned_from(rows):
    words = {"aa": "alpha beta ", "bb": "gamma delta "}
    rows_ = [(i, words[k] * 20_000, k) for i in range(12) for k in words]
    model = train_languages(rows("doc_id long, text string, lang string", *rows_))
    assert model.classes == ["aa", "bb"]


def _plain_features(text, shape, fold):
    """Buckets of a text, one word and one n-gram at a time."""
    found = Counter()
    data = (text or "").encode()
    if fold:
        data = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    parts = [w for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
    for word in parts:
        one = words(pa.array([word.decode()]), False)
        for bucket in gram_features(one, shape.grams, shape.bits)[1].tolist():
            found[bucket] += 1
    again = sum(a == b for a, b in zip(parts, parts[1:]))
    return found, again


def test_scores_equal_a_plain_forward_pass(odd, documents, labels):
    """Brute force for the three classifiers over the fitted tables."""
    some = documents.limit(12).select("doc_id", "text").union(odd.select("doc_id", "text"))
    texts = [r.text for r in some.collect()]
    quality, lang = train_quality(documents, labels), train_languages(documents)
    tox = train_toxicity(documents, labels)
    for text, q, l, t in zip(
        texts,
        [r.quality_score for r in score_quality(some, quality).collect()],
        [(r.lang_pred, r.lang_score) for r in detect_languages(some, lang).collect()],
        [(r.toxicity, r.severity) for r in grade_toxicity(some, tox).collect()],
    ):
        for model, got in ((quality, q), (lang, l)):
            found, again = _plain_features(text, model.shape, model.shape.fold_case)
            total = sum(n * model.table[b] for b, n in found.items())
            total = total + model.table[model.shape.end] + again * model.table[model.shape.repeat]
            chance = softmax((total / (sum(found.values()) + 1 + again) + model.bias) / model.temperature)
            if model is quality:
                assert got == pytest.approx(float(chance[1]), abs=1e-4)
            elif got[0] != UNKNOWN:
                assert model.classes[int(np.argmax(chance))] == got[0]
                assert got[1] == pytest.approx(float(chance.max()), abs=1e-4)
        found, _ = _plain_features(text, TOXIC, True)
        above = tox.at_least(np.array([sum(float(tox.weights[b]) for b in found)]))[0]
        assert t == (pytest.approx(above[0], abs=1e-4), pytest.approx(above.sum(), abs=1e-3))


def test_quality_on_held_out_rows(documents, labels):
    found = classify_quality(documents, labels).join(labels, "doc_id").where("held_out")
    total, right = found.agg(F.count("*"), F.sum((F.col("quality") == F.col("predicted")).cast("int"))).first()
    assert right / total > 0.9


def test_languages_on_held_out_rows(documents):
    found = predict_languages(documents).join(documents.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out")
    total, right = held.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert right / total > 0.9
    assert held.where("rejected").count() <= 0.05 * total


def test_toxicity_on_held_out_rows(documents, labels):
    found = rate_toxicity(documents, labels).join(labels, "doc_id").where("held_out")
    harmless, wrong = found.where("toxic = 0").agg(F.count("*"), F.sum("predicted")).first()
    assert wrong / harmless < 0.1
    mean = {r["toxic"]: r["s"] for r in found.groupBy("toxic").agg(F.avg("severity").alias("s")).collect()}
    assert mean.get(1, 9) > mean[0]


def test_awkward_rows(odd, labels, documents):
    quality = score_quality(odd, train_quality(documents, labels))
    assert quality.count() == odd.count()
    assert quality.where("quality_score IS NULL OR quality_score NOT BETWEEN 0 AND 1").isEmpty()
    same = quality.where("doc_id IN (1, 2, 3)").select("quality_score").distinct()
    assert same.count() == 1  # null and empty texts score alike
    found = detect_languages(odd, train_languages(documents)).collect()
    for row in found:
        if row.doc_id in (1, 2, 3, 6):
            assert (row.lang_pred, row.lang_score, row.lang_rejected) == (UNKNOWN, 0.0, True)
        else:
            assert row.lang_pred in ("en", "fr", "de", "es")
    graded = grade_toxicity(odd, train_toxicity(documents, labels))
    assert graded.where("severity IS NULL OR severity < 0").isEmpty() and graded.count() == odd.count()


def test_nothing_to_learn_from(odd, rows):
    none = rows("doc_id long, quality int, toxic int")
    assert train_quality(odd, none) is None and train_toxicity(odd, none) is None
    assert {r.score for r in classify_quality(odd, none).collect()} == {0.5}
    assert {r.severity for r in rate_toxicity(odd, none).collect()} == {0.0}
    unknown = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in predict_languages(unknown).collect()} == {UNKNOWN}


def test_one_label_only(odd, rows):
    good = rows("doc_id long, quality int", *[(i, 1) for i in range(1, 8)])
    assert {r.predicted for r in classify_quality(odd, good).collect()} == {1}


def test_empty_tables(odd, labels):
    empty = odd.limit(0)
    assert classify_quality(empty, labels).count() == 0
    assert predict_languages(empty).count() == 0
    assert rate_toxicity(empty, labels).count() == 0


def test_filters_keep_columns_and_content(clashing, documents, labels):
    kept = keep_recognised(clashing)
    assert kept.columns == clashing.columns
    assert {r.lang_pred for r in kept.collect()} <= {"lang_pred"}
    assert {r.doc_id for r in kept.collect()} <= {4, 5, 7, None}
    judged = keep_good(clashing, labels)
    assert judged.schema == clashing.schema
    assert all(r.score == "score" for r in judged.collect())


def test_labels_are_no_input(documents, labels):
    model = train_quality(documents, labels)
    text = documents.select("doc_id", "text")
    one = {r.doc_id: r.quality_score for r in score_quality(text, model).collect()}
    other = score_quality(text.select((F.col("doc_id") + 7000).alias("doc_id"), "text"), model)
    assert {r.doc_id - 7000: r.quality_score for r in other.collect()} == one


def test_descent_separates_two_bags():
    shape = Shape(bits=4, dimensions=4, least_steps=400)
    examples = [(i % 2, [i % 2, 16, 17], [1.0, 1.0, 0.0]) for i in range(20)]
    examples = [(y, np.array(k), np.array(c, np.float32)) for y, k, c in examples]
    model = fit(examples, shape)
    for label, keys, counts in examples[:2]:
        logits = counts @ model.table[keys] / counts.sum() + model.bias
        assert softmax(logits)[label] > 0.9


def test_severity_is_ordered():
    shape = Shape(bits=4, epochs=60)
    marks = [shape.end, shape.repeat]
    bags = {0: [1, 2], 1: [1, 3], 2: [3, 4], 3: [3, 4, 5]}
    examples = [(g, np.array(bags[g] + marks), None) for g in list(bags) * 20]
    model = fit_severity(examples, shape, l1=0.01)
    assert (np.diff(model.thresholds) >= 0).all()
    evidence = np.array([model.weights[bags[g]].sum() for g in range(4)])
    expected = model.at_least(evidence).sum(axis=1)
    assert (np.diff(expected) > 0).all()


def test_evidence_counts_a_feature_once():
    shape = Shape(bits=10, grams=(3,), fold_case=True)
    weights = np.ones(shape.rows, np.float32)
    once, twice, none = evidence_of(pa.array(["abc", "ABC abc", None]), weights, shape)
    assert once == twice > 0 and none == 0
    assert Severity(weights, np.array([0.0, 1.0])).at_least(np.array([0.5])).shape == (1, 2)


def test_evidence_is_found_by_sorting(documents, monkeypatch):
    """The sum over the set of each text's buckets; nothing is hashed, which takes three times as long."""
    weights = np.random.default_rng(3).normal(size=TOXIC.rows).astype(np.float32)
    weights[::3] = 0
    texts = [row.text for row in documents.select("text").limit(50).collect()] + [None, "", "a a"]
    plain = []
    for text in texts:
        found = words(pa.array([text]), True)
        _, bucket = gram_features(found, TOXIC.grams, TOXIC.bits)
        plain.append(sum(float(weights[b]) for b in sorted(set(bucket.tolist()))))

    def hashed(*_, **__):
        raise AssertionError("np.unique hashes integers")

    monkeypatch.setattr(np, "unique", hashed)
    assert np.allclose(evidence_of(pa.array(texts), weights), plain, atol=1e-9)
