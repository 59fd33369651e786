"""Raw messages: parse, stamp transport fields, check validity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridloom.functions.strict_json import parse_whole
from gridloom.schemas import RAW_MESSAGE

# Reasons a message goes to quarantine.
PARSE_ERROR = "parse_error"
INVALID_MESSAGE = "invalid_message"
INCOMPLETE_METADATA = "incomplete_metadata"

SNIPPET_LENGTH = 100  # fixed value: how much of a bad message an error shows


def parse_messages(envelopes: DataFrame) -> DataFrame:
    """Envelope columns plus the parsed message; ``parsed`` is false on any bad field.

    The envelope's topic and message id replace those inside the message.
    """
    body = F.col("_body")
    return parse_whole(envelopes, "payload", RAW_MESSAGE, "_body").select(
        *envelopes.columns,
        body.isNotNull().alias("parsed"),
        body["device_info"]["device_eui"].alias("device_eui"),
        body["lorawan_data"].alias("lorawan_data"),
        body["raw_payload"].alias("raw_payload"),
        body["message_timestamp"].alias("message_timestamp"),
    )


def snippet(column: str = "payload"):
    return F.substring(column, 1, SNIPPET_LENGTH)
