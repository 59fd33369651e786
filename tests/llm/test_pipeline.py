"""The pipeline's stages against brute force, and the whole on the smallest tables."""

import pytest
from test_decontaminate import plain as plain_contamination
from test_simhash import plain_components

import corpus_pipeline
from gridloom.llm import packing, quality

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, sf_dir).collect()
        docs = spark.createDataFrame(rows, seen[0][1].schema) if name != "best_fit_packing" else None
        seen.append((name, docs if docs is not None else rows))
    return dict(seen)


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_rejected_documents_go(stages, spark):
    kept = {r.doc_id for r in quality.quality(stages["documents"]).where("kept").collect()}
    assert rows(stages["quality_rules"]) == [r for r in rows(stages["documents"]) if r[0] in kept]
    assert len(kept) > 100


def test_one_of_each_group_stays(stages):
    before = texts(stages["quality_rules"])
    want = {d for d, _, least in plain_components(list(before.items())) if d == least}
    assert rows(stages["near_duplicates"]) == [r for r in rows(stages["quality_rules"]) if r[0] in want]


def test_repeats_go(stages):
    before = texts(stages["near_duplicates"])
    seen = {}
    for text in before.values():
        data = text.encode()
        for p in range(len(data) - 199):
            seen[data[p : p + 200]] = seen.get(data[p : p + 200], 0) + 1
    for doc_id, text in texts(stages["repeated_passages"]).items():
        data = before[doc_id].encode()
        gone = set()
        for p in range(len(data) - 199):
            if seen[data[p : p + 200]] > 1:
                gone |= set(range(p, p + 200))
        assert text == bytes(c for p, c in enumerate(data) if p not in gone).decode("utf-8", "ignore")
    assert all(r.n_chars == len(r.text) for r in stages["repeated_passages"].collect())
    assert set(texts(stages["repeated_passages"])) == set(before)


def test_contaminated_documents_go(stages, spark, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    before = texts(stages["repeated_passages"])
    bad = {r[0] for r in plain_contamination(list(before.items()), items) if r[5]}
    assert rows(stages["decontamination"]) == [r for r in rows(stages["repeated_passages"]) if r[0] not in bad]


def test_all_that_is_left_is_packed(stages, spark, sf_dir):
    packed = stages["best_fit_packing"]
    assert {r.doc_id for r in packed} == set(texts(stages["decontamination"]))
    want = {tuple(r) for r in packing.pieces(stages["decontamination"]).collect()}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed} == want
    whole = corpus_pipeline.run(spark, sf_dir)
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in whole.collect()} == {(r.doc_id, r.piece, r.ids_crc32) for r in packed}


def test_odd_rows_pass(spark, sf_dir):
    long = " ".join(f"word{i}" for i in range(20_000))
    odd = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, long, None, None, 5), (None, long[:3000], "fr", "b", 1)]
    for some in (odd, []):
        docs = spark.createDataFrame([(*r, "x", 1) for r in some], COLUMNS + ", _key string, kept int")
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
        assert {r.doc_id for r in docs.collect()} == ({2, None} if some else set())
