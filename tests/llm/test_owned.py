"""Nothing of a stored result stays below the shared folder if its maker owns it."""

import corpus_pipeline
from gridloom import session
from gridloom.llm import queries


def test_pipeline_leaves_nothing(spark, sf_dir, tmp_path):
    out = str(tmp_path / "packed")
    with session.owned_folders(spark) as paths:
        corpus_pipeline.run(spark, sf_dir).write.parquet(out)
    assert paths and not any(session.exists(spark, path) for path in paths)
    assert spark.read.parquet(out).count() > 0


def test_operator_leaves_nothing(spark, sf_dir, tmp_path):
    out = str(tmp_path / "removed")
    with session.owned_folders(spark) as paths:
        queries.queries()["op6_suffix_array_dedup"](spark, sf_dir).write.parquet(out)
    assert paths and not any(session.exists(spark, path) for path in paths)
    assert spark.read.parquet(out).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
