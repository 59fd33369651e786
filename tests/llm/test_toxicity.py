"""Toxicity on held-out documents, and the parts by themselves."""

import zlib

import numpy as np
import pytest

from gridloom.llm import toxicity


def area(scores, labels):
    """Chance that a toxic document scores above another one."""
    scores, labels = np.array(scores), np.array(labels)
    a, b = scores[labels == 1][:, None], scores[labels == 0][None, :]
    return float((a > b).mean() + (a == b).mean() / 2)


def test_held_out_documents(spark):
    found = {r.doc_id: r for r in toxicity.op10_toxicity(spark, "/root/testdata/sf0.1").collect()}
    assert len(found) == 10_000
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if found[r.doc_id].held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in labels)
    toxic = [r.toxic for r in labels]
    assert area([found[r.doc_id].score for r in labels], toxic) > 0.95
    predicted = np.array([found[r.doc_id].predicted for r in labels])
    assert predicted[np.array(toxic) == 1].mean() > 0.7 and predicted[np.array(toxic) == 0].mean() < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())


def test_windows_hold_every_word():
    text = ("Word " * 500 + "x" * 5000 + " é end\n").encode()
    assert b"".join(toxicity.windows(text)).replace(b" ", b"") == text.lower().replace(b" ", b"").replace(b"\n", b"")
    assert max(map(len, toxicity.windows(text))) <= toxicity.WINDOW + toxicity.LONGEST_WORD + 2
    assert toxicity.windows(b"") == [b" "]


def test_odd_rows(spark):
    rows = [(None, None, 1.0), (1, "", 2.0), (1, "", 2.0), (2, "word " * 40_000, None), (3, "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (99, 1, 1), (1, None, None), (3, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        got = toxicity.toxicity(docs, labels)
        assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 1, 1, 2, 3]
        assert {(r.score, r.predicted) for r in got.collect()} == {(0.0, 0)}
    assert toxicity.toxicity(docs.limit(0), odd).collect() == []


@pytest.mark.parametrize("n", [1, 40])
def test_little_text_trains(n):
    toxic, ordinary = train = toxicity.train_dictionaries([b"you utter numbskull"] * n, [b"a fine day out"] * n)
    assert toxic.endswith(ordinary)
    assert all(np.isfinite(toxicity.features(t, *train)).all() for t in (b"", b"numbskull " * 99, b"day"))


def test_a_repeated_document_is_learned_once(spark):
    docs = spark.range(2).crossJoin(spark.range(500).select()).selectExpr("id + 1 doc_id", "'some text' text")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    sample = toxicity.sampled(docs, labels, toxicity.Scratch(spark, "test"))
    assert docs.count() == 1000 and sample.count() == 2
