"""Every record schema, declared once. Streams never infer a schema."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ArrayType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


_S, _T, _D = StringType(), TimestampType(), DoubleType()

# What a broker or a landing folder hands over.
ENVELOPE = _struct(("message_id", _S), ("topic", _S), ("payload", _S), ("publish_time", _T))

LORAWAN = _struct(
    ("rssi", LongType()),
    ("snr", _D),
    ("data_rate", _S),
    ("frequency", _D),
    ("gateway_eui", _S),
    ("received_at", _T),
)
DEVICE_INFO = _struct(("device_eui", _S))
RAW_MESSAGE = _struct(
    ("device_info", DEVICE_INFO),
    ("lorawan_data", LORAWAN),
    ("raw_payload", _S),
    ("message_id", _S),
    ("topic", _S),
    ("message_timestamp", _T),
)

ENRICHED = _struct(
    ("raw_payload", _S),
    ("device_eui", _S),
    ("original_mqtt_time", _T),
    ("lorawan_received_at", _T),
    ("client_id", _S),
    ("location_id", _S),
    ("device_category", _S),
    ("ingestion_timestamp", _T),
    ("original_client_timestamp", _T),
    ("client_message_id", _S),
)
UNIDENTIFIED = _struct(
    ("device_eui", _S),
    ("raw_payload", _S),
    ("original_mqtt_time", _T),
    ("lorawan_received_at", _T),
    ("ingestion_timestamp", _T),
    ("processing_error", _S),
)
# Either of the two above, as the decoder and the archive read them.
COMBINED = _struct(
    ("device_eui", _S),
    ("raw_payload", _S),
    ("original_mqtt_time", _T),
    ("lorawan_received_at", _T),
    ("ingestion_timestamp", _T),
    ("client_id", _S),
    ("location_id", _S),
    ("device_category", _S),
    ("processing_error", _S),
)

DECODED = _struct(
    ("uid", _S),
    ("reading", FloatType()),
    ("average_current", FloatType()),
    ("max_current", FloatType()),
    ("max_voltage", FloatType()),
    ("average_voltage", FloatType()),
)
METER_READING = _struct(
    ("uid", _S),
    ("reading", _D),
    ("average_current", _D),
    ("max_current", _D),
    ("max_voltage", _D),
    ("average_voltage", _D),
    ("device_eui", _S),
    ("client_id", _S),
    ("location_id", _S),
    ("device_category", _S),
    ("original_mqtt_time", _T),
    ("upstream_ingestion_timestamp", _T),
    ("processed_timestamp", _T),
    ("device_type", _S),
)

REGISTRY = _struct(
    ("device_eui", _S), ("client_id", _S), ("location_id", _S), ("device_category", _S)
)

# One record of a published topic.
TOPIC_RECORD = _struct(
    ("message_id", _S),
    ("payload", _S),
    ("attributes", MapType(_S, _S)),
    ("publish_time", _T),
    ("topic_source", _S),
)

# Archive lines keep the original payload as text; partition values are text too.
ARCHIVE_LINE = _struct(
    ("device_eui", _S), ("original_pubsub_payload", _S), ("archived_at", _S)
)
ARCHIVE_PARTITIONS = _struct(("year", _S), ("month", _S), ("day", _S), ("location", _S))

VERIFY_PAYLOAD = _struct(
    ("device_eui", _S),
    ("message_timestamp", _T),
    ("original_client_timestamp", _T),
    ("original_mqtt_time", _T),
    ("client_message_id", _S),
)
VERIFY_RECORD = _struct(
    ("client_message_id", _S),
    ("device_eui", _S),
    ("topic_source", _S),
    ("original_client_timestamp", _T),
    ("verifier_receive_time", _T),
    ("pubsub_publish_time", _T),
    ("latency_ms", LongType()),
    ("processing_latency_ms", LongType()),
)

TARIFF = _struct(
    ("tariff_id", _S),
    ("location_id", _S),
    ("zone", _S),
    ("valid_from", DateType()),
    ("valid_to", DateType()),
    ("days", ArrayType(IntegerType())),
    ("hour_from", IntegerType()),
    ("hour_to", IntegerType()),
    ("period", _S),
    ("rate", _D),
)
CHARGE = _struct(("location_id", _S), ("demand_rate", _D), ("fixed_rate", _D))
EMISSION_FACTOR = _struct(("region", _S), ("valid_from", _T), ("factor", _D))
TARGET = _struct(("location_id", _S), ("month", DateType()), ("target", _D))
ADJUSTMENT = _struct(
    ("device_eui", _S),
    ("original_mqtt_time", _T),
    ("adjustment_kwh", _D),
    ("justification", _S),
)
SUBSCRIPTION = _struct(("report_group", _S), ("report", _S), ("condition", _S))
