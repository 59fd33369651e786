"""Folders that an owner removes."""

import pytest

from gridloom import session
from gridloom.operators import ordering
from gridloom.plans import catalog


def test_folders_of_a_block_go_at_its_end(spark, sf_dir, tmp_path):
    before = session.settle(spark.range(3), "before")
    out = str(tmp_path / "numbered")
    with session.owned_folders(spark) as outer:
        kept = session.settle(spark.range(2), "outer")
        with session.owned_folders(spark) as inner:
            rows = spark.range(1000).selectExpr("id % 3 k", "id t", "id")
            ordering.number_rows(rows, ["k"], "t", ["id"]).write.parquet(out)
            catalog.queries()["archive_batches"](spark, sf_dir).write.parquet(out + "-archive")
        assert inner and not any(session.exists(spark, path) for path in inner)
        assert kept.count() == 2 and len(outer) == 1
    assert not session.exists(spark, outer[0])
    assert before.count() == 3
    assert spark.read.parquet(out).count() == 1000
    session.discard(before)


def test_folders_go_if_the_block_fails(spark):
    with pytest.raises(ZeroDivisionError), session.owned_folders(spark) as paths:
        session.discard(session.settle(spark.range(1), "early"))
        session.settle(spark.range(1), "late")
        1 / 0
    assert len(paths) == 2 and not any(session.exists(spark, path) for path in paths)
    assert session.shared_folder(spark, "after") not in paths
