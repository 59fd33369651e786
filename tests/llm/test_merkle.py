"""The manifest against SQL and a plain version over Python lists."""

import hashlib
import random
import zlib

import compare
import pytest
from pyspark.sql import functions as F

from gridloom.llm import merkle

SCHEMA = "tree string, doc_id long, source string, lang string, n_chars long, text string, position long, key string, leaf int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def climb(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, place):
    out = []
    for level in tree[:-1]:
        first = place - place % 3
        out.append((level[first:place], level[place + 1 : first + 3]))
        place //= 3
    return out


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded root of every row."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    first = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    trees = {s: climb([leaf(r) for r in sorted(groups[s], key=first)]) for s in order}
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for number, source in enumerate(order):
        for place, row in enumerate(sorted(groups[source], key=first)):
            steps = way(trees[source], place) + way(top, number)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            changed = (*row[:4], row[4].replace("\n", "")) if tampered and row[4] is not None else row
            cur = leaf(changed)
            for left, right in steps:
                cur = digest("".join([*left, cur, *right]))
            proof = digest("".join(x for pair in steps for side in pair for x in side))
            out.append((row[0], leaf(row), trees[source][-1][0], top[-1][0], proof, cur, cur == top[-1][0]))
    return out


def result(spark, rows, width=merkle.WIDTH):
    docs = spark.createDataFrame([("t", *r, 5, "k", 6) for r in rows], SCHEMA)
    return sorted(map(tuple, merkle.digests(docs, width).collect()), key=str)


def test_equals_sql(spark, sf_dir):
    tables = compare.connect(sf_dir)
    assert compare.difference(merkle.op12_merkle_manifest(spark, sf_dir), tables, merkle.ORACLE_SQL) is None


@pytest.mark.parametrize("groups,largest", [(1, 1), (1, 3), (2, 4), (5, 40), (30, 12), (3, 700)])
def test_equals_plain(spark, groups, largest):
    draw = random.Random(largest)
    rows = []
    for group in range(groups):
        for _ in range(largest if group == 0 else draw.randrange(1, largest + 1)):
            text = draw.choice([None, "", "a\nb", "é\n", "same", f"t{len(rows)}\n\n"])
            rows.append((len(rows) * 7 % 5000, f"s{group}", "en", 3, text))
    # Few nodes a superblock, so that there are several steps.
    assert result(spark, rows, 9) == sorted(plain(rows), key=str)


def test_nulls_repeats_and_order_of_groups(spark):
    rows = [(1, None, None, None, None)] * 5 + [(None, None, "x", 0, ""), (None, None, "y", 0, "")]
    rows += [(2, "", "en", 1, "\n"), (3, "0", "en", 1, "b"), (4, "Z", "en", 1, "c"), (5, "z", "en", 1, "c"), (6, "é", "en", 1, "d")]
    rows += [(7, "\U0001f600", None, 1, "e\n" * 100_000), (2**62, "z", "en", 1, "f"), (2**62 + 1, "z", "en", 1, "f"), (None, "z", None, 1, "g")]
    assert result(spark, rows, 3) == sorted(plain(rows), key=str)


def test_empty(spark):
    assert result(spark, []) == []


def test_untampered_rows_verify_with_their_proofs(spark):
    rows = [(i, f"s{i % 3}", "en", 1, f"text {i}\n") for i in range(50)]
    docs = spark.createDataFrame([("t", *r, 5, "k", 6) for r in rows], SCHEMA)
    for row in merkle.manifest(docs).collect():
        assert row["folded_root"] == row["root"]
        assert all(len(x) % 64 == 0 for x in row["proof"])


def test_other_keys_and_fields(spark):
    docs = spark.range(20).select(F.concat(F.lit("k"), "id").alias("name"), (F.col("id") % 2).alias("shard"))
    rows = merkle.manifest(docs, "name", "shard", ["name"]).collect()
    assert {r["name"] for r in rows} == {f"k{i}" for i in range(20)}
    assert all(r["leaf"] == leaf((r["name"],)) and r["folded_root"] == r["root"] for r in rows)
