"""Send every message to exactly one exit: enriched, unidentified or quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import TimestampType

from gridloom.functions.text import empty_if_null, is_blank
from gridloom.functions.times import to_rfc3339
from gridloom.operators.joins import lookup_join
from gridloom.operators.parse import (
    INCOMPLETE_METADATA,
    INVALID_MESSAGE,
    PARSE_ERROR,
    parse_messages,
    snippet,
)
from gridloom.schemas import ENRICHED, UNIDENTIFIED

# Fixed value: the error text carried by unidentified messages.
METADATA_NOT_FOUND = "device metadata not found"

TRANSPORT = ["message_id", "topic", "publish_time"]


def registry_lookup(messages: DataFrame, registry: DataFrame, **join_options) -> DataFrame:
    """Left join to the registry; ``registered`` tells a miss from an incomplete entry."""
    registry = registry.select(
        "device_eui", "client_id", "location_id", "device_category"
    ).withColumn("registered", F.lit(True))
    return lookup_join(messages, registry, ["device_eui"], ["message_id"], **join_options)


def route(
    envelopes: DataFrame,
    registry: DataFrame,
    ingested_at: Column | None = None,
    **join_options,
) -> DataFrame:
    """One row per message with its ``exit`` and ``reason``, the same in batch and stream."""
    ingested_at = F.current_timestamp() if ingested_at is None else ingested_at
    found = registry_lookup(parse_messages(envelopes), registry, **join_options)
    incomplete = (
        is_blank(F.col("client_id"))
        | is_blank(F.col("location_id"))
        | is_blank(F.col("device_category"))
    )
    # 0 enriched, 1 unidentified, others quarantine: a number keeps filters short.
    found = found.withColumn(
        "_exit",
        F.when(~F.col("parsed"), 2)
        .when(is_blank(F.col("device_eui")), 3)
        .when(F.col("registered").isNull(), 1)
        .when(incomplete, 4)
        .otherwise(0),
    )
    code = F.col("_exit")
    known, kept = code == 0, code <= 1
    return found.select(
        *envelopes.columns,
        F.when(code == 0, "enriched").when(code == 1, "unidentified").otherwise("quarantine").alias("exit"),
        F.when(code == 1, METADATA_NOT_FOUND)
        .when(code == 2, PARSE_ERROR)
        .when(code == 3, INVALID_MESSAGE)
        .when(code == 4, INCOMPLETE_METADATA)
        .alias("reason"),
        "device_eui",
        "raw_payload",
        F.col("message_timestamp").alias("original_mqtt_time"),
        F.col("lorawan_data.received_at").alias("lorawan_received_at"),
        *[F.when(known, F.col(c)).alias(c) for c in ("client_id", "location_id", "device_category")],
        F.when(kept, ingested_at).alias("ingestion_timestamp"),
        F.when(known, F.col("message_timestamp")).alias("original_client_timestamp"),
        F.lit(None).cast("string").alias("client_message_id"),
        F.when(code == 1, METADATA_NOT_FOUND).alias("processing_error"),
    )


def enriched(routed: DataFrame, *extra: str) -> DataFrame:
    return routed.where(F.col("exit") == "enriched").select(*ENRICHED.names, *extra)


def unidentified(routed: DataFrame, *extra: str) -> DataFrame:
    return routed.where(F.col("exit") == "unidentified").select(*UNIDENTIFIED.names, *extra)


def quarantine(routed: DataFrame) -> DataFrame:
    """Rejected messages with their whole text, for audit and replay."""
    return routed.where(F.col("exit") == "quarantine").select(
        *TRANSPORT, "reason", "device_eui", "payload", snippet().alias("snippet")
    )


def raw_records(parsed: DataFrame) -> DataFrame:
    """Parsed messages as records of the raw topic."""
    lora = F.col("lorawan_data")
    unset_zero = lambda c: F.when(c != 0, c)
    unset_blank = lambda c: F.when(c != "", c)
    body = F.struct(
        F.struct(empty_if_null(F.col("device_eui")).alias("device_eui")).alias("device_info"),
        F.struct(
            unset_zero(lora["rssi"]).alias("rssi"),
            unset_zero(lora["snr"]).alias("snr"),
            unset_blank(lora["data_rate"]).alias("data_rate"),
            unset_zero(lora["frequency"]).alias("frequency"),
            unset_blank(lora["gateway_eui"]).alias("gateway_eui"),
            to_rfc3339(lora["received_at"]).alias("received_at"),
        ).alias("lorawan_data"),
        empty_if_null(F.col("raw_payload")).alias("raw_payload"),
        empty_if_null(F.col("message_id")).alias("message_id"),
        empty_if_null(F.col("topic")).alias("topic"),
        to_rfc3339(F.col("message_timestamp")).alias("message_timestamp"),
    )
    attributes = _attributes(message_type=F.lit("mqtt"), device_eui=F.col("device_eui"))
    return parsed.where("parsed").select(
        "message_id", F.to_json(body).alias("payload"), attributes.alias("attributes"), "publish_time"
    )


def topic_records(routed: DataFrame) -> DataFrame:
    """Enriched and unidentified messages as records of their topics.

    Both topics come out of one pass over the routed messages.
    """
    c = F.col
    # Only these may be unset in a message that has passed routing.
    times = [f.name for f in ENRICHED.fields if isinstance(f.dataType, TimestampType)]
    wire = {f"_{name}": to_rfc3339(c(name)) for name in times}
    wire |= {f"_{name}": empty_if_null(c(name)) for name in ("raw_payload", "client_message_id")}

    def body(*names: str) -> Column:
        fields = [c(f"_{n}" if f"_{n}" in wire else n).alias(n) for n in names]
        return F.to_json(F.struct(*fields))

    known_body = body(
        "raw_payload",
        "device_eui",
        "original_mqtt_time",
        "lorawan_received_at",
        "client_id",
        "location_id",
        "device_category",
        "ingestion_timestamp",
        "original_client_timestamp",
        "client_message_id",
    )
    unknown_body = body(
        "device_eui",
        "raw_payload",
        "original_mqtt_time",
        "lorawan_received_at",
        "ingestion_timestamp",
        "processing_error",
    )
    known_attributes = _attributes(
        message_type=F.lit("enriched"),
        device_eui=c("device_eui"),
        client_id=c("client_id"),
        category=c("device_category"),
    )
    unknown_attributes = _attributes(
        message_type=F.lit("unidentified"),
        device_eui=c("device_eui"),
        error_reason=c("processing_error"),
    )
    known = c("exit") == "enriched"
    sent = routed.where(c("exit").isin("enriched", "unidentified")).withColumns(wire)
    return sent.select(
        "message_id",
        F.when(known, known_body).otherwise(unknown_body).alias("payload"),
        F.when(known, known_attributes).otherwise(unknown_attributes).alias("attributes"),
        "publish_time",
        c("exit").alias("topic_source"),
    )


def _attributes(**named: Column) -> Column:
    pairs = []
    for name, value in named.items():
        pairs += [F.lit(name), empty_if_null(value)]
    return F.create_map(*pairs)
