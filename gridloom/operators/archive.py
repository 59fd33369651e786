"""Archive: route raw topic records by day and location, batch them, expire them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.functions.strict_json import parse_whole
from gridloom.functions.text import empty_if_null, is_blank
from gridloom.functions.times import to_rfc3339
from gridloom.operators.ordering import number_rows
from gridloom.operators.parse import snippet
from gridloom.schemas import COMBINED

# Defaults of the archive layout.
DEADLETTER = "deadletter"
OBJECT_PREFIX = "raw-audit-logs/daily-aggregates"
BATCH_THRESHOLD = 100
UNPARSEABLE = "archive_unparseable"

BATCH_COLUMNS = ["batch_key", "publish_time", "message_id", "device_eui", "archived_at"]


def fan_in(enriched: DataFrame, unidentified: DataFrame) -> DataFrame:
    """Both outputs as one set of messages; absent fields are NULL."""
    return enriched.unionByName(unidentified, allowMissingColumns=True)


def archive_routes(records: DataFrame) -> DataFrame:
    """Topic records with their location and batch key; ``accepted`` is false for bad text."""
    body = F.col("_body")
    placed = ~is_blank(body["location_id"]) & is_blank(body["processing_error"])
    location = F.when(placed, body["location_id"]).otherwise(DEADLETTER)
    day = F.col("publish_time")
    return parse_whole(records, "payload", COMBINED, "_body").select(
        *records.columns,
        body.isNotNull().alias("accepted"),
        body["device_eui"].alias("device_eui"),
        F.when(body.isNotNull(), location).alias("location"),
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"),
        F.when(body.isNotNull(), F.concat_ws("/", F.date_format(day, "yyyy/MM/dd"), location)).alias(
            "batch_key"
        ),
    )


def archive_records(routes: DataFrame, archived_at: Column | None = None) -> DataFrame:
    """Accepted records as JSON lines; the original text is kept, not re-encoded."""
    archived_at = F.current_timestamp() if archived_at is None else archived_at
    one_line = F.regexp_replace("payload", r"[\r\n]+", " ")
    line = F.concat(
        F.lit('{"device_eui":'),
        _json_text(empty_if_null(F.col("device_eui"))),
        F.lit(',"original_pubsub_payload":'),
        one_line,
        F.lit(',"archived_at":"'),
        to_rfc3339(archived_at),
        F.lit('"}'),
    )
    return routes.where("accepted").select(
        *routes.columns, archived_at.alias("archived_at"), line.alias("line")
    )


def archive_rejects(routes: DataFrame) -> DataFrame:
    return routes.where(~F.col("accepted")).select(
        "message_id",
        F.lit(UNPARSEABLE).alias("reason"),
        "payload",
        snippet().alias("snippet"),
        "publish_time",
    )


def archive_batches(records: DataFrame, threshold: int = BATCH_THRESHOLD) -> DataFrame:
    """What each file of ``threshold`` messages holds, in arrival order per batch key."""
    if threshold < 1:
        raise ValueError("a batch holds at least one message")
    numbered = number_rows(
        records.select(*BATCH_COLUMNS),
        ["batch_key"],
        "publish_time",
        ["message_id"],
    )
    n = F.col("position")
    return (
        numbered.withColumn("batch_no", F.call_function("div", n - 1, F.lit(threshold)))
        .groupBy("batch_key", "batch_no")
        .agg(
            F.count("*").alias("message_count"),
            F.min_by("device_eui", n).alias("first_message_eui"),
            F.min_by("archived_at", n).alias("first_archived_at"),
            F.max_by("archived_at", n).alias("last_archived_at"),
        )
    )


def retention_folders(folders: DataFrame, as_of: Column, age_days: int) -> DataFrame:
    """The same from the archive's own files (``landed.archive_folders``): no message is read."""
    day = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
    age = F.date_diff(F.to_date(as_of), day)
    return (
        folders.groupBy("year", "month", "day", "location")
        .agg(F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"))
        .withColumn("age_days", age)
        .where(F.col("age_days") >= age_days)
    )


def retention_candidates(partitions: DataFrame, as_of: Column, age_days: int) -> DataFrame:
    """Days and locations old enough for the age rule at ``as_of``."""
    day = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
    age = F.date_diff(F.to_date(as_of), day)
    return (
        partitions.groupBy("year", "month", "day", "location")
        .agg(F.count("*").alias("message_count"))
        .withColumn("age_days", age)
        .where(F.col("age_days") >= age_days)
    )


def _json_text(value: Column) -> Column:
    """A JSON string literal: the one item of an encoded array without its brackets."""
    array = F.to_json(F.array(value))
    return F.substring(array, F.lit(2), F.length(array) - 2)
