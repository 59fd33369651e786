"""Delivery checks: who got what, how complete and how late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.functions.strict_json import parse_whole
from gridloom.functions.text import empty_if_null
from gridloom.functions.times import millis_between
from gridloom.operators.ordering import exact_percentiles
from gridloom.schemas import VERIFY_PAYLOAD, VERIFY_RECORD

# Tolerances of a run on shared and on local infrastructure.
SHARED_RUN_SHARE = 0.8
LOCAL_RUN_SLACK = 2
ERROR_RATE_LIMIT = 0.0001

TOPIC_SOURCES = ["enriched", "unidentified"]


def read_back(records: DataFrame) -> DataFrame:
    """Topic records with the fields that verification looks at."""
    return parse_whole(records, "payload", VERIFY_PAYLOAD, "_body")


def verify_records(records: DataFrame, received_at: Column | None = None) -> DataFrame:
    """One row per readable record; unreadable ones are skipped.

    The client time is the original client timestamp or, failing that, the
    message time.  Latency is NULL without a client time.
    """
    received_at = F.current_timestamp() if received_at is None else received_at
    body = F.col("_body")
    sent = F.coalesce(body["original_client_timestamp"], body["original_mqtt_time"])
    published = F.col("publish_time")
    return (
        read_back(records)
        .where(body.isNotNull())
        .select(
            empty_if_null(body["client_message_id"]).alias("client_message_id"),
            empty_if_null(body["device_eui"]).alias("device_eui"),
            "topic_source",
            sent.alias("original_client_timestamp"),
            received_at.alias("verifier_receive_time"),
            published.alias("pubsub_publish_time"),
            millis_between(received_at, sent).alias("latency_ms"),
            F.when(published.isNull(), F.lit(0).cast("bigint"))
            .otherwise(millis_between(published, sent))
            .alias("processing_latency_ms"),
        )
        .select(*VERIFY_RECORD.names)
    )


def verify_summary(records: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """The run's envelope and counts in one row; ``labels`` name run and environment."""
    row = records.agg(
        F.min("verifier_receive_time").alias("start_time"),
        F.max("verifier_receive_time").alias("end_time"),
        F.count("*").alias("total_messages_verified"),
        F.count_if(F.col("topic_source") == "enriched").alias("enriched_messages"),
        F.count_if(F.col("topic_source") == "unidentified").alias("unidentified_messages"),
    )
    row = row.withColumn(
        "actual_duration_ms", millis_between(F.col("end_time"), F.col("start_time"))
    )
    return row.withColumns({k: F.lit(v) for k, v in (labels or {}).items()})


def counts_by_device(records: DataFrame) -> DataFrame:
    return (
        records.groupBy("device_eui")
        .pivot("topic_source", TOPIC_SOURCES)
        .count()
        .fillna(0, subset=TOPIC_SOURCES)
    )


def completeness(
    records: DataFrame, run_devices: DataFrame, share: float = SHARED_RUN_SHARE
) -> DataFrame:
    """Observed against expected messages per device of the run.

    ``run_devices`` has device_eui, known, duration_s and rate.  A known device
    is expected on the enriched topic, any other on the unidentified one.
    """
    expected = (F.col("duration_s") * F.col("rate")).cast("bigint")
    observed = F.when(F.col("known"), F.col("enriched")).otherwise(F.col("unidentified"))
    # Both sides hold one row per device, so the planner's own choice will do.
    return (
        run_devices.join(counts_by_device(records), "device_eui", "left")
        .select(
            "device_eui",
            "known",
            expected.alias("expected"),
            F.coalesce(observed, F.lit(0)).cast("bigint").alias("observed"),
        )
        .withColumn("complete_shared", F.col("observed") >= F.col("expected") * share)
        .withColumn(
            "complete_local",
            F.col("observed") >= F.greatest(F.col("expected") - LOCAL_RUN_SLACK, F.lit(1)),
        )
    )


def violations(records: DataFrame, run_devices: DataFrame) -> DataFrame:
    """Devices seen on the topic they must not appear on."""
    wrong = F.when(F.col("known"), F.col("unidentified")).otherwise(F.col("enriched"))
    return (
        run_devices.join(counts_by_device(records), "device_eui")
        .select("device_eui", "known", wrong.cast("bigint").alias("wrong_messages"))
        .where(F.col("wrong_messages") > 0)
    )


def latency_counts(records: DataFrame, column: str = "latency_ms") -> DataFrame:
    """How often each latency occurred, per topic; combined before the shuffle."""
    return records.groupBy("topic_source", F.col(column).alias("latency_ms")).agg(
        F.count("*").alias("n")
    )


def latency_stats(counts: DataFrame) -> DataFrame:
    """Exact P50, P90 and P99, mean, least and greatest latency per topic."""
    points = {0.5: "p50", 0.9: "p90", 0.99: "p99"}
    ranked = (
        exact_percentiles(counts, "latency_ms", list(points), ["topic_source"])
        .groupBy("topic_source")
        .agg(*[F.max(F.when(F.col("point") == p, F.col("value"))).alias(n) for p, n in points.items()])
    )
    measured = F.sum(F.when(F.col("latency_ms").isNotNull(), F.col("n")))
    plain = counts.groupBy("topic_source").agg(
        F.coalesce(measured, F.lit(0)).alias("measured"),
        (F.sum(F.col("latency_ms") * F.col("n")) / measured).alias("mean"),
        F.min("latency_ms").alias("least"),
        F.max("latency_ms").alias("greatest"),
    )
    return plain.join(ranked, "topic_source", "left")


def error_counts(records: DataFrame, limit: float = ERROR_RATE_LIMIT) -> DataFrame:
    """Unreadable and untimed records per topic, with their rate against a limit."""
    body = F.col("_body")
    sent = F.coalesce(body["original_client_timestamp"], body["original_mqtt_time"])
    bad = F.col("unparseable") + F.col("missing_timestamp")
    return (
        read_back(records)
        .groupBy("topic_source")
        .agg(
            F.count("*").alias("total"),
            F.count_if(body.isNull()).alias("unparseable"),
            F.count_if(body.isNotNull() & sent.isNull()).alias("missing_timestamp"),
        )
        .withColumn("error_rate", bad / F.col("total"))
        .withColumn("within_limit", F.col("error_rate") < limit)
    )
