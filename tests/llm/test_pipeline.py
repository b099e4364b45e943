from __future__ import annotations

import gc
import itertools
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_near_copies import shingle_bag, similarity

from tablesync.llm.langid import predict_languages
from tablesync.llm.mixing import mix_sources
from tablesync.llm.quality import classify_quality
from tablesync.llm.storage import COLLECT_EVERY, fresh, stash

SF = "/root/testdata/sf0.001"


def test_the_stages_in_turn(spark, documents):
    docs, counts = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, SF), "test")
        if name != "packing":
            assert docs.columns == documents.columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality", "near_dedup", "mixing", "packing",
    ]
    run = corpus_pipeline.run(spark, SF)
    assert run.count() == counts[-1]


def test_what_each_stage_keeps(spark, documents, labels):
    """The content of every stage, against the operators' own verdicts and plain pair checks."""
    stages = dict(corpus_pipeline.STAGES)
    kept = {"documents": documents}
    for before, name in zip(["documents", *stages], stages):
        kept[name] = stash(stages[name](spark, kept[before], SF), f"content-{name}")
    rows = lambda frame: Counter((r.doc_id, r.text) for r in frame.collect())
    good = {r.doc_id for r in predict_languages(documents).where("NOT rejected").collect()}
    assert rows(kept["language_id"]) == rows(documents.where(F.col("doc_id").isin(*good)))
    judged = classify_quality(kept["language_id"], labels).where("predicted = 1")
    fine = {r.doc_id for r in judged.collect()}
    assert rows(kept["quality"]) == rows(documents.where(F.col("doc_id").isin(*fine)))

    left = rows(kept["near_dedup"])
    assert max(left.values()) == 1 and left.keys() <= rows(kept["quality"]).keys()
    bags = {doc: shingle_bag(text) for doc, text in left}
    pairs = itertools.combinations(sorted(bags), 2)
    assert not [(a, b) for a, b in pairs if similarity(bags[a], bags[b]) >= 0.8]
    every = {doc: (text, shingle_bag(text)) for doc, text in rows(kept["quality"])}
    for doc in every.keys() - bags.keys():  # who goes is like somebody, or equal
        assert any(
            other != doc and (text == every[doc][0] or similarity(bag, every[doc][1]) >= 0.8)
            for other, (text, bag) in every.items()
        )

    taken = {r.doc_id: r.taken // r.size if r.size else 0 for r in mix_sources(kept["near_dedup"]).collect()}
    copies = Counter({doc: n for (doc, _), n in rows(kept["mixing"]).items()})
    assert copies == Counter({doc: n for doc, n in taken.items() if n}) and max(copies.values()) <= 2

    pieces = kept["packing"].collect()
    length, whole = Counter(), {}
    for piece in pieces:
        length[piece.doc_id] += piece.length
        whole[piece.doc_id] = piece.doc_tokens
    assert length == Counter({doc: whole[doc] * n for doc, n in copies.items()})
    for _, own in itertools.groupby(sorted(pieces, key=lambda p: (p.sequence_id, p.offset)), key=lambda p: p.sequence_id):
        end = 0
        for piece in own:
            assert piece.offset == end
            end += piece.length
        assert end <= 2048


@pytest.mark.parametrize("place", range(5))
def test_each_stage_takes_awkward_and_empty_tables(spark, odd, clashing, place):
    name, stage = corpus_pipeline.STAGES[place]
    for frame in (odd, clashing, odd.limit(0)):
        result = stage(spark, frame, SF)
        if name != "packing":
            assert result.columns == frame.columns
        assert result.count() >= 0


def test_names_that_are_taken():
    assert fresh("a", ["A", "_a"]) == "__a" and fresh("b", ["a"]) == "b"


def test_every_query_is_registered():
    import __spark_entry__ as entry

    names = [name for name in entry.queries() if name.startswith("op")]
    assert [name.split("_")[0] for name in names] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in entry.queries()


def test_a_row_of_stashes_frees_what_the_driver_held(spark, rows):
    """An object that nothing refers to is gone from the driver's JVM after some stashes."""
    jvm = spark.sparkContext._jvm
    held = jvm.java.lang.ref.WeakReference(jvm.java.lang.Object())
    gc.collect()  # the handle on this side
    frame = rows("a int", (1,))
    for _ in range(COLLECT_EVERY):
        stash(frame, "row")
    assert held.get() is None
