"""Queries over the message flow: sources, routing, decoding, archive, verification."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridloom import session
from gridloom.operators import archive, decode, parse, route, verify
from gridloom.plans.meter import Meter
from gridloom.sinks import tables
from gridloom.sources import landed

AS_OF = "2024-01-31 00:00:00"
RETENTION_DAYS = 14


def raw_scan(m: Meter) -> DataFrame:
    return m.envelopes


def registry_scan(m: Meter) -> DataFrame:
    return m.registry


def parse_messages(m: Meter) -> DataFrame:
    lora = F.col("lorawan_data")
    return m.parsed.where("parsed").select(
        "message_id",
        "topic",
        "device_eui",
        lora["rssi"].alias("rssi"),
        lora["snr"].alias("snr"),
        lora["received_at"].alias("received_at"),
        "raw_payload",
        "message_timestamp",
    )


def stamp_transport(m: Meter) -> DataFrame:
    """Parsed messages carry the envelope's topic and id, whatever their text says."""
    claims = F.concat(
        F.expr("substr(payload, 1, length(payload) - 1)"),
        F.lit(',"message_id":"inner","topic":"inner"}'),
    )
    spoken = m.envelopes.withColumn("payload", claims)
    return parse.parse_messages(spoken).where("parsed").select("message_id", "topic", "device_eui")


def raw_publish(m: Meter) -> DataFrame:
    return _flat(route.raw_records(m.parsed), "message_type", "device_eui")


def quarantine_parse(m: Meter) -> DataFrame:
    return _quarantined(m, parse.PARSE_ERROR).select(
        "message_id", "topic", "reason", "payload", "snippet"
    )


def quarantine_invalid(m: Meter) -> DataFrame:
    return _quarantined(m, parse.INVALID_MESSAGE).select("message_id", "topic", "reason", "payload")


def quarantine_incomplete(m: Meter) -> DataFrame:
    return _quarantined(m, parse.INCOMPLETE_METADATA).select(
        "message_id", "device_eui", "reason", "payload"
    )


def enrich_known(m: Meter) -> DataFrame:
    return route.enriched(m.routed, "message_id")


def route_unidentified(m: Meter) -> DataFrame:
    return route.unidentified(m.routed, "message_id")


def route_exits(m: Meter) -> DataFrame:
    """Every message with the one exit it took."""
    return m.routed.select("message_id", "exit", "reason")


def enriched_attributes(m: Meter) -> DataFrame:
    records = route.topic_records(m.routed).where(F.col("topic_source") == "enriched")
    return _flat(records, "message_type", "device_eui", "client_id", "category")


def unidentified_attributes(m: Meter) -> DataFrame:
    records = route.topic_records(m.routed).where(F.col("topic_source") == "unidentified")
    return _flat(records, "message_type", "device_eui", "error_reason")


def decode_skips(m: Meter) -> DataFrame:
    return decode.skipped(m.decoded, "message_id")


def decode_errors(m: Meter) -> DataFrame:
    return decode.errors(m.decoded, "message_id")


def decode_payload(m: Meter) -> DataFrame:
    values = [F.col(c).cast("double").alias(c) for c in decode.FLOAT_FIELDS]
    return m.decoded.where(F.col("outcome") == "reading").select("message_id", "uid", *values)


def meter_readings(m: Meter) -> DataFrame:
    return m.readings


def readings_by_day(m: Meter) -> DataFrame:
    """Write the day-partitioned table, read it back, count per day."""
    path = session.shared_folder(m.spark, "readings")
    tables.write_readings(m.readings, path)
    schema = tables.by_day(m.readings).schema
    return (
        m.spark.read.schema(schema)
        .parquet(path)
        .groupBy("reading_day")
        .agg(
            F.count("*").alias("n_readings"),
            F.sum("reading").alias("sum_reading"),
            F.min("original_mqtt_time").alias("first_time"),
            F.max("original_mqtt_time").alias("last_time"),
        )
    )


def layout_partitions(m: Meter) -> DataFrame:
    """The partition each layout unit puts readings into, with its size."""
    narrow = m.readings.select("original_mqtt_time")
    units = F.explode(F.array(*[F.lit(u) for u in tables.PARTITION_UNITS]))
    # One count per hour first; the other units are made of hours.
    hours = (
        tables.layout(narrow, "original_mqtt_time", "HOUR")
        .groupBy(F.to_timestamp("partition_time", "yyyy-MM-dd-HH").alias("hour"))
        .agg(F.count("*").alias("n"))
    )
    value = F.lit(None).cast("string")
    for unit in tables.PARTITION_UNITS:
        text = F.date_format(tables.partition_value("hour", unit), "yyyy-MM-dd-HH")
        value = F.when(F.col("unit") == unit, text).otherwise(value)
    return (
        hours.withColumn("unit", units)
        .groupBy("unit", value.alias("partition_time"))
        .agg(F.sum("n").alias("n_readings"))
    )


def reading_lookup(m: Meter) -> DataFrame:
    return landed.lookup_reading(m.readings, "DEV-000008")


def archive_union(m: Meter) -> DataFrame:
    """Both outputs as one set with all fields of either.

    The routed messages are landed once, by exit; each side reads its own part.
    """
    path = session.shared_folder(m.spark, "routed")
    tables.batch_sink(path, ["exit"])(m.routed, 0)
    landed_exits = tables.read_batches(m.spark, path, m.routed.schema)
    return archive.fan_in(route.enriched(landed_exits), route.unidentified(landed_exits))


def archive_route(m: Meter) -> DataFrame:
    return m.archive_routes.where("accepted").select("message_id", "location", "batch_key")


def archive_rejects(m: Meter) -> DataFrame:
    return archive.archive_rejects(m.archive_routes)


def archive_records(m: Meter) -> DataFrame:
    return m.archived.select("message_id", "batch_key", "line")


def archive_batches(m: Meter) -> DataFrame:
    """Numbering samples its input first, so the few columns it needs are written."""
    narrow = m.archived.select(*archive.BATCH_COLUMNS)
    return archive.archive_batches(session.settle(narrow, "archived"))


def archive_read_range(m: Meter) -> DataFrame:
    """Write the archive, read a range of days of one location back."""
    path = tables.archive_path(session.shared_folder(m.spark, "archive"))
    tables.write_archive(m.archived, path)
    return landed.read_archive(m.spark, path, "2024-01-05", "2024-01-12", "LOC-003")


def retention_candidates(m: Meter) -> DataFrame:
    accepted = m.archive_routes.where("accepted")
    return archive.retention_candidates(accepted, F.lit(AS_OF).cast("timestamp"), RETENTION_DAYS)


def retention_folders(m: Meter) -> DataFrame:
    """The same days and locations, from the files of a written archive."""
    path = tables.archive_path(session.shared_folder(m.spark, "archive"))
    tables.write_archive(m.archived, path)
    due = archive.retention_folders(landed.archive_folders(m.spark, path), F.lit(AS_OF).cast("timestamp"), RETENTION_DAYS)
    return due.select("year", "month", "day", "location", "age_days")


def verify_records(m: Meter) -> DataFrame:
    return m.verified


def verify_summary(m: Meter) -> DataFrame:
    labels = {"test_run_id": "run-1", "environment_name": "tables"}
    return verify.verify_summary(m.verified, labels)


def verify_by_device(m: Meter) -> DataFrame:
    return verify.counts_by_device(m.verified)


def verify_completeness(m: Meter) -> DataFrame:
    return verify.completeness(m.verified, m.run_devices)


def verify_violations(m: Meter) -> DataFrame:
    return verify.violations(m.verified, m.run_devices)


def latency_stats(m: Meter) -> DataFrame:
    counts = session.settle(verify.latency_counts(m.verified), "latency")
    stats = verify.latency_stats(counts)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "p50", "p90", "p99")})


def error_counts(m: Meter) -> DataFrame:
    return verify.error_counts(m.topics).withColumn("error_rate", F.round("error_rate", 9))


def _quarantined(m: Meter, reason: str) -> DataFrame:
    return route.quarantine(m.routed).where(F.col("reason") == reason)


def _flat(records: DataFrame, *attributes: str) -> DataFrame:
    values = [F.col("attributes")[a].alias(f"attr_{a}") for a in attributes]
    return records.select("message_id", "payload", *values)


QUERIES = [
    raw_scan,
    registry_scan,
    parse_messages,
    stamp_transport,
    raw_publish,
    quarantine_parse,
    quarantine_invalid,
    quarantine_incomplete,
    enrich_known,
    route_unidentified,
    route_exits,
    enriched_attributes,
    unidentified_attributes,
    decode_skips,
    decode_errors,
    decode_payload,
    meter_readings,
    readings_by_day,
    layout_partitions,
    reading_lookup,
    archive_union,
    archive_route,
    archive_rejects,
    archive_records,
    archive_batches,
    archive_read_range,
    retention_candidates,
    retention_folders,
    verify_records,
    verify_summary,
    verify_by_device,
    verify_completeness,
    verify_violations,
    latency_stats,
    error_counts,
]
