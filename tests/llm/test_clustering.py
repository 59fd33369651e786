"""Lloyd's rounds against SQL and a plain version in Python's integers."""

import hashlib
import math
import random

import compare
import pytest

from gridloom.llm import clustering

SCHEMA = "label string, vec_id long, embedding array<float>, cluster int, chunk string, _id int, _v int"


def plain(rows, clusters, rounds, components, seed=3, scale=1024):
    """vec_id, cluster and distance of every kept row, and the centroids."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(scale * x) for x in v]))
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]
    measure = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(measure(v)[1], []).append(v)
        centroids = [
            [sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)
        ]
    return [(i, measure(v)[1], min(measure(v)[0], (1 << 63) - 1)) for i, v in kept], centroids


def frame(spark, rows):
    return spark.createDataFrame([("x", i, v, 9, "y", 7, 8) for i, v in rows], SCHEMA)


def test_equals_sql(spark, sf_dir):
    tables = compare.connect(sf_dir)
    assert compare.difference(clustering.op11_centroid_clustering(spark, sf_dir), tables, clustering.ORACLE_SQL) is None


@pytest.mark.parametrize("columns", [1, 2, 3, 5, 8])
def test_any_cut_is_exact(spark, columns):
    draw = random.Random(columns)
    rows = [(i, [draw.randrange(-40, 40) / 16 for _ in range(5)]) for i in range(300)]
    rows += [(i + 300, rows[i % 3][1]) for i in range(150)]  # a third are copies
    found, centroids = clustering.cluster(frame(spark, rows), 4, 5, components=5, columns=columns)
    want, middle = plain(rows, 4, 5, 5)
    assert centroids == middle
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    same = [0.5, -0.25]
    rows = [(1, same), (1, same), (2, same), (None, [1.0, 1.0]), (None, [1.0, 1.0]), (3, None), (4, [1.0])]
    rows += [(5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, []), (9, [1.0, 2.0, 3.0])]
    rows += [(10, [-0.0001, 0.0])]
    found, centroids = clustering.cluster(frame(spark, rows), 8, 3, components=2, columns=1)
    want, middle = plain(rows, 8, 3, 2)
    assert centroids == middle and len(middle) == 6
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_huge_components(spark):
    rows = [(i, [3e38 * (-1) ** i, float(i)]) for i in range(6)] + [(i, [float(i), 1e9]) for i in range(6, 12)]
    found, centroids = clustering.cluster(frame(spark, rows), 3, 4, components=2, columns=1)
    rows = [(i, spark_floats(v)) for i, v in rows]
    want, middle = plain(rows, 3, 4, 2)
    assert centroids == middle
    assert sorted(map(tuple, found.collect())) == sorted(want)


def spark_floats(v):
    import numpy as np

    return [float(np.float32(x)) for x in v]


def test_empty(spark):
    found, centroids = clustering.cluster(frame(spark, []))
    assert found.collect() == [] and centroids == []
    assert clustering.cluster(frame(spark, [(1, None)]))[0].collect() == []
