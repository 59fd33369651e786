"""Binary meter payloads to readings."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.functions.binary import be_bits, float32_of_bits, is_hex
from gridloom.functions.once import add_once
from gridloom.functions.text import is_blank
from gridloom.schemas import METER_READING

# The payload layout (name, first byte) and the texts that go with it.
PAYLOAD_BYTES = 24
UID_BYTES = 4
FLOAT_FIELDS = {
    "reading": 4,
    "average_current": 8,
    "max_current": 12,
    "max_voltage": 16,
    "average_voltage": 20,
}
BAD_HEX = "failed to decode hex payload"
DEVICE_TYPE = "XDevice"

# A decoder adds the struct column ``into``: ``error`` and the decoded fields, both
# taken from the payload text in column ``payload``; a NULL payload gives NULLs.
Decoder = Callable[[DataFrame, str, str], DataFrame]


def decode_meter(df: DataFrame, payload: str, into: str) -> DataFrame:
    """Fields of the fixed binary layout; ``error`` says why there are none.

    Each step is a projection of its own, so that the bits of a field are
    computed once however often the float formula looks at them.
    """
    text = F.col(payload)
    size = (F.length(text) / 2).cast("int")
    bad_length = F.concat(
        F.lit(f"invalid payload length: expected {PAYLOAD_BYTES} bytes, got "),
        size.cast("string"),
        F.lit(" bytes"),
    )
    error = F.when(~is_hex(text), BAD_HEX).when(size != PAYLOAD_BYTES, bad_length)
    bits = {f"_bits_{name}": be_bits("_hex", at) for name, at in FLOAT_FIELDS.items()}
    fields = [float32_of_bits(f"_bits_{name}").alias(name) for name in FLOAT_FIELDS]
    uid = F.unhex(F.substring("_hex", 1, 2 * UID_BYTES)).cast("string")
    df = (
        df.withColumn("_error", error)
        .withColumn("_hex", F.when(F.col("_error").isNull(), text))
        .withColumns(bits)
    )
    decoded = F.struct(F.col("_error").alias("error"), uid.alias("uid"), *fields)
    return add_once(df, {into: decoded}).drop("_error", "_hex", *bits)


DECODERS: dict[str, Decoder] = {DEVICE_TYPE: decode_meter}


def decode(
    messages: DataFrame,
    processed_at: Column | None = None,
    decoders: Mapping[str, Decoder] | None = None,
    type_of_category: Mapping[str, str] | None = None,
    default_type: str = DEVICE_TYPE,
) -> DataFrame:
    """Add ``outcome`` (reading, skipped or error), ``detail`` and the decoded fields.

    ``type_of_category`` chooses a decoder by device category; other categories
    use ``default_type``.  Upstream errors and empty payloads are skipped, first.
    """
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    decoders = DECODERS if decoders is None else decoders
    types = type_of_category or {}
    unknown = {default_type, *types.values()} - set(decoders)
    if unknown:
        raise ValueError(f"no decoder for {sorted(unknown)}")
    device_type = F.lit(default_type)
    for category, kind in types.items():
        device_type = F.when(F.col("device_category") == category, kind).otherwise(device_type)
    upstream = (
        ~is_blank(F.col("processing_error"))
        if "processing_error" in messages.columns
        else F.lit(False)
    )
    blank = is_blank(F.col("raw_payload"))
    df = messages.withColumns(
        {
            "device_type": device_type,
            "_skip": F.when(upstream, "upstream_error").when(blank, "empty_payload"),
        }
    )
    decoded = None
    for i, (kind, decoder) in enumerate(decoders.items()):
        chosen = F.col("_skip").isNull() & (F.col("device_type") == kind)
        df = decoder(
            df.withColumn("_payload", F.when(chosen, F.col("raw_payload"))), "_payload", f"_fields{i}"
        )
        decoded = (
            F.when(chosen, F.col(f"_fields{i}"))
            if decoded is None
            else decoded.when(chosen, F.col(f"_fields{i}"))
        )
    d = F.col("_decoded")
    df = df.withColumn("_decoded", decoded).withColumns(
        {
            "outcome": F.when(F.col("_skip").isNotNull(), "skipped")
            .when(d["error"].isNotNull(), "error")
            .otherwise("reading"),
            "detail": F.coalesce("_skip", d["error"]),
            **{name: d[name] for name in ["uid", *FLOAT_FIELDS]},
        }
    )
    helpers = ["_skip", "_payload", "_decoded", *[f"_fields{i}" for i in range(len(decoders))]]
    return df.withColumn(
        "processed_timestamp", F.when(F.col("outcome") == "reading", processed_at)
    ).drop(*helpers)


def meter_readings(decoded: DataFrame, *extra: str) -> DataFrame:
    """Decoded messages as warehouse rows: floats widened, unset times NULL."""
    widen = {name: F.col(name).cast("double") for name in FLOAT_FIELDS}
    return (
        decoded.where(F.col("outcome") == "reading")
        .withColumns(widen)
        .withColumnRenamed("ingestion_timestamp", "upstream_ingestion_timestamp")
        .select(*METER_READING.names, *extra)
    )


def skipped(decoded: DataFrame, *extra: str) -> DataFrame:
    return decoded.where(F.col("outcome") == "skipped").select("device_eui", "detail", *extra)


def errors(decoded: DataFrame, *extra: str) -> DataFrame:
    return decoded.where(F.col("outcome") == "error").select(
        "device_eui", "raw_payload", "detail", *extra
    )
