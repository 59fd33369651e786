"""What the operators of this subpackage share: written tables, keys, text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom import session

#: Rows per Arrow batch.  Documents are long, so Spark's 10,000 rows would make
#: batches of tens of megabytes, and of gigabytes where long documents meet.
BATCH_ROWS = 1000

#: Lower-cases A-Z only, as the text rules of these operators ask for.
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches; a smaller setting of the session's own stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written tables of one operator run, below the cluster's shared folder.

    ``settle`` cuts the lineage: a lost executor costs a re-read.  ``drop``
    removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = prepare(spark)
        self.purpose = purpose
        self.paths: dict[int, str] = {}

    def settle(self, df: DataFrame) -> DataFrame:
        path = session.shared_folder(self.spark, self.purpose)
        df.write.option("compression", "zstd").parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.paths.pop(id(table), None)
            if path:
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def keyed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``_key``, a number that names one row, and ``_row``, all columns of the row.

    The columns stay inside ``_row``, where no name of theirs can clash.  Whole,
    distinct doc_ids serve as keys as they are.  With null or repeated ones the
    rows are numbered and written once, which fixes the numbers for all readers.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("_n"))
    clash = ids.where(F.col("doc_id").isNull() | (F.col("_n") > 1)).limit(1)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    if not clash.take(1):
        return docs.select(F.col("doc_id").cast("long").alias("_key"), row)
    return scratch.settle(docs.select(F.monotonically_increasing_id().alias("_key"), row))


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Whole texts as UTF-8, null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def batches(rows: Iterator[pa.RecordBatch], max_bytes: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``max_bytes``, one row at least."""
    for batch in rows:
        if not batch.num_rows:
            continue
        step = max(1, batch.num_rows * max_bytes // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
