"""SimHash against brute force over all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from gridloom.llm import simhash
from gridloom.llm.common import Scratch


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """(doc_id, text) rows to sorted (doc_id, fingerprint, component_id)."""
    prints = [plain_fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).extend([] if doc_id is None else [doc_id])
    return [
        (doc_id, f"{prints[i]:016x}", min(least[find(i)], default=None))
        for i, (doc_id, _) in enumerate(rows)
    ]


def ordered(rows):
    return sorted(rows, key=str)


def result(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    return ordered(tuple(r) for r in simhash.near_duplicates(docs).collect())


def near_copies(seed, n=60):
    draw = random.Random(seed)
    bases = [" ".join(draw.choice(["Alpha", "beta", "gamma", "delta", "épsilon", "zeta", "ETA"]) for _ in range(300)) for _ in range(4)]
    rows = []
    for i in range(n):
        words = draw.choice(bases).split()
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = "w%d" % draw.randrange(1000)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rows = near_copies(seed) + [(100, ""), (101, None), (102, " \n"), (103, "one"), (104, "one two"), (104, "one two")]
    assert result(spark, rows) == ordered(plain_components(rows))


def test_nulls_ties_and_empty(spark):
    rows = [(None, "a b c"), (None, "a b c"), (None, "x"), (7, "x"), (7, None)]
    assert result(spark, rows) == ordered(plain_components(rows))
    assert result(spark, []) == []


def test_long_text_counts_every_word():
    text = " ".join(f"word{i % 977}" for i in range(30_000))
    assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == plain_fingerprint(text)


def component_pairs(edges):
    group = {}

    def find(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in edges:
        group[find(a)] = find(b)
    least = {}
    for x in list(group):
        least[find(x)] = min(least.get(find(x), x), x)
    return {(x, least[find(x)]) for x in group if least[find(x)] != x}


@pytest.mark.parametrize("hot", [4, 1 << 14])
def test_index_finds_every_link(spark, hot):
    """Dense groups around a few values, in keys beyond and below the hot bound."""
    draw = random.Random(hot)
    values = {0, -1}
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(40):
            value = centre
            for bit in draw.sample(range(64), draw.randrange(7)):
                value ^= 1 << bit
            values.add(value - (1 << 64) if value >> 63 else value)
    values = sorted(values)
    want = component_pairs(
        (a, b) for i, a in enumerate(values) for b in values[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    )
    scratch = Scratch(spark, "test")
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = simhash.links(prints, scratch, hot)
    assert {tuple(r) for r in simhash.roots(edges, scratch).collect()} == want


def test_chains_become_one_component(spark):
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, 200)] + [(500, 3), (500, 400), (400, 301)], "v long, p long")
    got = {tuple(r) for r in simhash.roots(edges, Scratch(spark, "test")).collect()}
    assert got == {(i, 0) for i in range(1, 200)} | {(500, 0), (400, 0), (301, 0)}
