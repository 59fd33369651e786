"""Contamination against SQL and brute force."""

import hashlib
import random
import re

import compare
import pytest

from gridloom.llm import decontaminate


def test_equals_sql(spark, sf_dir):
    tables = compare.connect(sf_dir)
    got = decontaminate.op8_benchmark_decontamination(spark, sf_dir)
    assert compare.difference(got, tables, decontaminate.ORACLE_SQL) is None
    assert got.where("contaminated").count()


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    out = []
    for doc_id, text in docs:
        have, hit, ids = words(text), set(), set()
        for item_id, item in items:
            want = words(item)
            size = min(13, len(want))
            for i in range(len(want) - size + 1 if size else 0):
                for s in range(len(have) - size + 1):
                    if have[s : s + size] == want[i : i + size]:
                        hit |= set(range(s, s + size))
                        ids |= {str(item_id)} - {"None"}
        listed = ",".join(sorted(ids))
        out.append((doc_id, len(have), len(hit), len(ids), hashlib.sha256(listed.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(have)))
    return sorted(out, key=str)


def result(spark, docs, items):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, items string, _key int")
    i = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, doc_id int")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in decontaminate.contamination(d, i).select(columns).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    draw = random.Random(seed)
    vocabulary = ["the", "of", "Été", "x1", "B", "c"][: 3 + seed]
    line = lambda n: ["; ", " ", "--"][seed].join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, line(draw.choice([0, 1, 5, 12, 13, 14, 40]))) for i in range(12)] + [(None, line(13)), (3, line(20)), (50, None), (51, " .")]
    docs = [(i, line(draw.randrange(60)) + " " + (draw.choice(items)[1] or "") + " " + line(draw.randrange(60))) for i in range(25)]
    docs += [(None, items[8][1]), (3, items[9][1]), (70, None), (71, "")]
    assert result(spark, docs, items) == plain(docs, items)


def test_blocks_of_items_and_long_texts(spark, monkeypatch):
    draw = random.Random(5)
    line = lambda n: " ".join(f"w{draw.randrange(300)}" for _ in range(n))
    items = [(i, line(30)) for i in range(20)]
    docs = [(0, line(40_000) + " " + items[3][1] + " " + items[3][1]), (1, items[4][1][:90] + " " + items[7][1])]
    want = plain(docs, items)
    assert result(spark, docs, items) == want
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    assert result(spark, docs, items) == want


def test_empty_tables(spark):
    items = [(1, "a b c")]
    assert result(spark, [], items) == []
    assert result(spark, [(1, "a b c"), (2, None)], []) == plain([(1, "a b c"), (2, None)], [])


def test_matches_near(spark):
    item = "a b c d e f g h i j k l m n"
    docs = spark.createDataFrame([(1, "x " + item), (2, "a b c d e f X g h i j k l m"), (3, "n m l k")], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    exact = decontaminate.matches(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.lo, r.hi) for r in exact] == [(1, "1", 1, 15)]
    assert {r.doc_id for r in decontaminate.matches(docs, items, slop=1).collect()} == {1, 2}
    rows = [(1, "x " + item, "q"), (2, "clean text", "r"), (2, None, None)]
    stage = spark.createDataFrame(rows, "doc_id long, text string, _key string")
    assert sorted(map(tuple, decontaminate.clean_documents(stage, items).collect()), key=str) == sorted(rows[1:], key=str)
