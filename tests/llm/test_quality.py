"""Quality rules against SQL and brute force."""

import random

import compare
import pytest

from gridloom.llm import quality


def test_equals_sql(spark, sf_dir):
    tables = compare.connect(sf_dir)
    assert compare.difference(quality.op2_quality_rules(spark, sf_dir), tables, quality.ORACLE_SQL) is None


def plain_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            inside |= {i, i + 1, i + 2}
    return len(inside)


@pytest.mark.parametrize("seed", range(20))
def test_repeated_words(seed):
    draw = random.Random(seed)
    words = [draw.choice([b"a", b"b", b"c", b"d"][: 2 + seed % 3]) for _ in range(draw.randrange(40))]
    assert quality.repeated_words(words) == plain_repeats(words)


def test_measures():
    assert quality.measure(b"") == (0, 0, 0, 0, 0)
    text = "é x #|\nab\n\n \nab\nab\n".encode()
    assert quality.measure(text) == (5, 3 + 2 + 6, 2, 2, 0)
    long = " ".join(f"w{i % 500}" for i in range(50_000)).encode()
    assert quality.measure(long)[::4] == (50_000, 50_000)


def verdicts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, kept string, _key int, _host string")
    return sorted((tuple(r) for r in quality.quality(docs).select("doc_id", "base_failed", "kept").collect()), key=str)


def clean(n):
    return " ".join(f"word{n}{chr(97 + i % 26)}{i}" for i in range(80))


def test_hosts_decide(spark):
    odd = lambda n: clean(n).replace(" ", "# ")
    rows = [(i, "good", clean(i)) for i in range(60)] + [(100, "good", odd(100))]
    rows += [(200 + i, "odd", odd(i)) for i in range(40)] + [(250, "odd", clean(250))]
    rows += [(300 + i, "junk", "short") for i in range(200)] + [(600, "junk", clean(600))]
    rows += [(700, None, clean(7)), (700, None, clean(7)), (None, "", None), (701, "", " ")]
    got = {(d, k) for d, _, k in verdicts(spark, [(*r, None, 1, "h") for r in rows])}
    assert {(i, True) for i in [*range(60), 100, 250, 700]} <= got  # one odd document of a good host stays
    assert {(200 + i, False) for i in range(40)} <= got
    assert (600, False) in got  # its host is blocked
    assert {(None, False), (701, False)} <= got


def test_empty_and_pipeline_stage(spark):
    assert verdicts(spark, []) == []
    rows = [(1, "a", clean(1), "x", 5, "q"), (1, "a", clean(1), "x", 5, "q"), (2, "a", "no", "y", 6, "r"), (None, None, clean(3), "z", 7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, kept string, _key int, _host string")
    got = quality.kept_documents(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[1], rows[3]], key=str)
