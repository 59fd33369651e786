"""Table, topic, archive and export sinks.

A sink is any callable taking a DataFrame and a batch id.  Writing the same
batch twice leaves one copy, so a micro-batch can be repeated after a failure.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gridloom import session
from gridloom.operators.archive import BATCH_THRESHOLD, OBJECT_PREFIX
from gridloom.operators.ordering import spread_write
from gridloom.schemas import ARCHIVE_PARTITIONS

Sink = Callable[[DataFrame, int], None]

# Units a table may be partitioned by.
PARTITION_UNITS = ("HOUR", "DAY", "MONTH", "YEAR")


# Lines per file of a bulk load; the job that follows a stream writes its threshold.
BULK_LINES = 100_000


def run_of(df: DataFrame) -> str:
    """What tells the batches of one streaming query from those of any other.

    Spark keeps a query's id in its checkpoint, so a restart goes on under the same
    id and a new checkpoint gets a new one.
    """
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def batch_sink(path: str, partition_by: Sequence[str] = ()) -> Sink:
    """Parquet below ``run=ID/batch_id=N``; a repeated batch replaces its own folder.

    Batches of another query, or of the same job with a new checkpoint, stay.  All exits of a batch go out in one write, partitioned by their columns, so
    either every exit of the batch is committed or none.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        if partition_by:
            df = spread_write(df, list(partition_by))
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(
            f"{path}/run={run_of(df)}/batch_id={batch_id}"
        )

    return write


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What a batch sink holds, in the columns asked for; the schema is never inferred."""
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.names)


def partition_value(field: str, unit: str) -> Column:
    unit = unit.upper()
    if unit not in PARTITION_UNITS:
        raise ValueError(f"unsupported partition unit {unit!r}: use one of {PARTITION_UNITS}")
    return F.date_trunc(unit, F.col(field))


def layout(df: DataFrame, field: str, unit: str = "DAY") -> DataFrame:
    """Add the partition value as text that sorts by time and is fit for a path."""
    return df.withColumn(
        "partition_time", F.date_format(partition_value(field, unit), "yyyy-MM-dd-HH")
    )


def write_layout(
    df: DataFrame, path: str, field: str, unit: str = "DAY", cluster: Sequence[str] = ()
) -> None:
    """A table partitioned by a time unit and clustered within files.

    Clustering sorts each file by the given columns, which keeps their row-group
    ranges narrow for filters; the sort stays inside a task.
    """
    df = spread_write(layout(df, field, unit), ["partition_time"])
    if cluster:
        df = df.sortWithinPartitions("partition_time", *cluster)
    df.write.mode("append").partitionBy("partition_time").parquet(path)


#: Boundaries per clustering field, and rows that are looked at to find them.
CLUSTER_BITS = 6
CLUSTER_SAMPLE = 20_000


def cluster_key(df: DataFrame, fields: Sequence[str]) -> Column:
    """One number that is close for rows that are close in every field.

    A field's rank among boundaries from a bounded sample has ``CLUSTER_BITS`` bits; the bits of
    all fields are interleaved.  The boundaries steer only where rows lie, not what is read.
    """
    n = (1 << CLUSTER_BITS) - 1
    total = df.count()
    share = min(1.0, 2 * CLUSTER_SAMPLE / total) if total else 1.0
    rows = df.select(*fields).sample(share, seed=1).limit(CLUSTER_SAMPLE).collect()
    key = F.lit(0).cast("long")
    for place, field in enumerate(fields):
        values = sorted(v for v in (r[place] for r in rows) if v is not None)
        cuts = sorted({values[len(values) * (i + 1) // (n + 1)] for i in range(n)}) if values else []
        rank = _rank(F.col(field), cuts)
        for bit in range(CLUSTER_BITS):
            own = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(own, bit * len(fields) + place))
    return key


def _rank(value: Column, cuts: list, first: int = 0) -> Column:
    """How many of the sorted cuts are not above the value, by halving; NULL ranks first."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    high = _rank(value, cuts[middle + 1 :], first + middle + 1)
    return F.when(value >= F.lit(cuts[middle]), high).otherwise(_rank(value, cuts[:middle], first))


def write_clustered(
    df: DataFrame, path: str, field: str, unit: str, cluster: Sequence[str], rows_per_file: int = 1_000_000
) -> None:
    """A partitioned table whose files do not overlap much in any clustering field.

    Rows are cut by range of (partition, interleaved key), so a filter on any of the fields
    leaves most files out by their minimum and maximum.  ``df`` should be a table: it is
    read to find the ranges.
    """
    placed = layout(df, field, unit).withColumn("_z", cluster_key(df, cluster))
    ranges = placed.repartitionByRange("partition_time", "_z").sortWithinPartitions("partition_time", "_z")
    ranges.drop("_z").write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy("partition_time").parquet(path)


def by_day(readings: DataFrame) -> DataFrame:
    return readings.withColumn("reading_day", F.to_date("original_mqtt_time"))


def write_readings(readings: DataFrame, path: str) -> None:
    """Append readings to the warehouse table, created on first use, by day of the message."""
    days = spread_write(by_day(readings), ["reading_day"])
    days.write.mode("append").partitionBy("reading_day").parquet(path)


def archive_path(root: str, prefix: str = OBJECT_PREFIX) -> str:
    return f"{root.rstrip('/')}/{prefix}"


def write_archive(
    records: DataFrame, path: str, threshold: int = BULK_LINES, batch: str | None = None
) -> None:
    """Gzipped JSON lines by day and location, at most ``threshold`` lines per file.

    A load of the same ``batch`` replaces its own files; without a name it is a load
    of its own.  A location with very many records is split over tasks before the
    write.
    """
    parts = ARCHIVE_PARTITIONS.names
    lines = spread_write(records.select("line", *parts), parts)
    (
        lines.withColumn("batch", F.lit(batch or f"load-{uuid.uuid4().hex}"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts, "batch")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", threshold)
        .text(path)
    )


def archive_sink(path: str, threshold: int = BATCH_THRESHOLD) -> Sink:
    """Archive lines of a micro-batch, in the same folders as a bulk load's."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_archive(df, path, threshold, f"{run_of(df)}-{batch_id}")

    return write


def to_kafka(records: DataFrame) -> DataFrame:
    """Topic records in the columns that Spark's Kafka sink wants."""
    headers = F.transform(
        F.map_entries("attributes"),
        lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")),
    )
    return records.select(
        F.col("message_id").alias("key"), F.col("payload").alias("value"), headers.alias("headers")
    )


def write_verification(summary: DataFrame, records: DataFrame, path: str) -> None:
    """The run as two tables of JSON lines: one summary row and all records."""
    summary.write.mode("overwrite").json(f"{path}/summary")
    records.write.mode("overwrite").json(f"{path}/records")


def write_csv(report: DataFrame, path: str, date_column: str) -> None:
    """CSV with a header for spreadsheets, one folder per report date."""
    days = spread_write(report, [date_column])
    days.write.mode("overwrite").option("header", True).partitionBy(date_column).csv(path)


def expire_archive(
    spark: SparkSession, path: str, candidates: DataFrame, act: bool = False
) -> list[str]:
    """Day folders that the age rule covers; deleted only with ``act``.

    The list is one short name per expired day.
    """
    days = candidates.select("year", "month", "day").distinct().orderBy("year", "month", "day")
    folders = [f"{path}/year={r.year}/month={r.month}/day={r.day}" for r in days.toLocalIterator()]
    if act:
        for folder in folders:
            if not session.remove(spark, folder):
                raise OSError(f"could not remove {folder}")
    return folders
