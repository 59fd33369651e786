"""The keyed table against a dictionary, over many batches, repeats and crashes."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom import session
from gridloom.sinks.keyed import KEPT_MANIFESTS, KeyedTable

SCHEMA = StructType().add("k", "string").add("at", "integer").add("v", "double").add("day", "string")


def make(spark, path=None, **options):
    path = path or session.shared_folder(spark, "keyed")
    options = {"keys": ["k"], "order": ["at"], "buckets": 2, **options}
    return KeyedTable(spark, path, SCHEMA, **options)


def frame(spark, rows):
    return spark.createDataFrame([(*r, False) if len(r) == 4 else r for r in rows], "k string, at int, v double, day string, _gone boolean")


def rows_of(table, *args):
    return sorted(map(tuple, table.current(*args).collect()))


def files_below(spark, path):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    n = 0
    while found.hasNext():
        n += found.next().getPath().getName().endswith(".parquet")
    return n


def test_equals_a_dictionary_and_stays_flat(spark):
    table, truth, draw, most = make(spark, fan=3), {}, random.Random(3), 0
    for batch in range(25):
        rows = [(f"k{draw.randrange(30)}", draw.randrange(100), float(batch), "d", draw.random() < 0.1) for _ in range(6)]
        best = {}
        for r in rows:
            best[r[0]] = max(best.get(r[0], r), r, key=lambda x: x[1])
        # Rows of a batch that tie have no order of their own: send one.
        rows = list(best.values())
        for r in rows:
            if r[0] not in truth or r[1] >= truth[r[0]][1]:
                truth[r[0]] = r
        table.commit(frame(spark, rows), "run", batch)
        most = max(most, max(len(runs) for runs in table.units().values()))
        assert len(table._names("manifests")) <= KEPT_MANIFESTS
    assert most <= 3 * 3  # three levels
    assert rows_of(table) == sorted(r[:4] for r in truth.values() if not r[4])
    assert files_below(spark, table.path) <= 2 * (2 * 3 * 3)


def test_repeated_batch_changes_nothing(spark):
    table = make(spark)
    table.commit(frame(spark, [("a", 1, 1.0, "d")]), "run", 0)
    table.commit(frame(spark, [("a", 1, 9.0, "d")]), "run", 0)
    assert table.done("run", 0) and not table.done("run", 1) and not table.done("other", 0)
    assert rows_of(table) == [("a", 1, 1.0, "d")]
    table.commit(frame(spark, [("a", 0, 5.0, "d"), ("b", 0, 5.0, "d")]), "other", 0)
    assert rows_of(table) == [("a", 1, 1.0, "d"), ("b", 0, 5.0, "d")]


@pytest.mark.parametrize("at", ["commit", "compact"])
def test_crash_between_write_and_swap(spark, at):
    table = make(spark, fan=3)
    for batch in range(2):
        table.commit(frame(spark, [("a", batch, float(batch), "d")]), "run", batch)
    before = rows_of(table)
    broken = make(spark, table.path, fan=3)
    swap, calls = broken._swap, []

    def crash(manifest):
        calls.append(1)
        if len(calls) == (1 if at == "commit" else 2):
            raise RuntimeError("lost")
        swap(manifest)

    broken._swap = crash
    with pytest.raises(RuntimeError, match="lost"):
        broken.commit(frame(spark, [("a", 2, 2.0, "d")]), "run", 2)
    after = [("a", 2, 2.0, "d")]
    assert rows_of(table) == (before if at == "commit" else after)
    # The batch is sent again, to a writer that knows nothing of the crash.
    again = make(spark, table.path, fan=3)
    again.commit(frame(spark, [("a", 2, 2.0, "d")]), "run", 2)
    again.commit(frame(spark, [("b", 0, 0.0, "d")]), "run", 3)
    assert rows_of(again) == [*after, ("b", 0, 0.0, "d")]
    listed = {folder for runs in again.units().values() for folder, _ in runs}
    assert listed <= set(again._names("data")) and len(again._names("data")) <= len(listed) + 3


def test_days_are_read_and_expired_apart(spark):
    table = make(spark, keys=["k", "day"], partition="day")
    for batch, day in enumerate(["2024-01-01", "2024-01-02", "2024-01-03", None]):
        table.commit(frame(spark, [("a", 1, float(batch), day)]), "run", batch)
    assert table.partitions() == ["2024-01-01", "2024-01-02", "2024-01-03", "none"]
    assert rows_of(table, ["2024-01-02"]) == [("a", 1, 1.0, "2024-01-02")]
    plan = table.current(["2024-01-02"])
    assert all("2024-01-02" in f for f in plan.inputFiles())
    assert table.expire("2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert [r[3] for r in rows_of(table, ["2024-01-01", "2024-01-03"])] == ["2024-01-03"]
    assert rows_of(make(spark)) == []


def test_removed_keys_come_back_when_sent_again(spark):
    table = make(spark, fan=2, order=[])
    table.commit(frame(spark, [("a", 1, 1.0, "d"), ("b", 1, 1.0, "d")]), "run", 0)
    table.commit(frame(spark, [("a", 1, 1.0, "d", True)]), "run", 1)
    assert rows_of(table) == [("b", 1, 1.0, "d")]
    table.commit(frame(spark, [("a", 0, 2.0, "d")]), "run", 2)
    assert rows_of(table) == [("a", 0, 2.0, "d"), ("b", 1, 1.0, "d")]
    empty = frame(spark, []).where(F.lit(False))
    table.commit(empty, "run", 3)
    assert table.done("run", 3) and len(rows_of(table)) == 2
