"""Payload decoding against numpy and the known cases."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions.binary import be_bits, float32_of_bits
from gridloom.operators import decode

FIELDS = list(decode.FLOAT_FIELDS)


def run(spark, payloads, **columns):
    rows = [(i, p) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "id int, raw_payload string")
    df = df.withColumns({"device_category": F.lit("HVAC"), "processing_error": F.lit(None).cast("string")})
    df = df.withColumns(columns)
    return {r.id: r for r in decode.decode(df).collect()}


def packed(uid, *values):
    return (uid.encode() + struct.pack(">5f", *values)).hex()


@pytest.mark.parametrize("seed", range(3))
def test_float_bits_equal_numpy(spark, seed):
    bits = np.random.default_rng(seed).integers(0, 2**32, 5000, dtype=np.uint32)
    edges = [0, 0x80000000, 1, 0x007FFFFF, 0x00800000, 0x7F7FFFFF, 0x7F800000, 0xFF800000, 0x7FC00000]
    bits = np.concatenate([bits, np.array(edges, dtype=np.uint32)])
    df = spark.createDataFrame([(i, f"{b:08x}") for i, b in enumerate(bits)], "id int, h string")
    df = df.withColumn("bits", be_bits("h", 0)).withColumn("v", float32_of_bits("bits"))
    got = np.array([r.v for r in df.orderBy("id").select("v").collect()], dtype=np.float64)
    want = bits.view(np.float32).astype(np.float64)
    same = (got == want) & (np.signbit(got) == np.signbit(want)) | (np.isnan(got) & np.isnan(want))
    assert same.all()


def test_known_payloads(spark):
    cases = [
        packed("XUID", 25.67, 1.23, 2.55, 240.5, 230.1),
        packed("XUID", 25.67, 1.23, 2.55, 240.5, 230.1).upper(),
        packed("EDGE", 0, 0, 0, 0, 0),
        packed("EDGE", -123.45, -0.5, -10, -300, -200),
        "45444745" + "7fc00000" + "7f800000" + "00000000" * 3,
    ]
    rows = run(spark, cases)
    assert all(rows[i].outcome == "reading" and rows[i].detail is None for i in rows)
    assert all(rows[i].device_type == "XDevice" for i in rows)
    assert rows[0].uid == rows[1].uid == "XUID" and rows[2].uid == "EDGE"
    want = [25.67, 1.23, 2.55, 240.5, 230.1]
    for i in (0, 1):
        assert [rows[i][f] for f in FIELDS] == pytest.approx(want, abs=0.001)
    assert [rows[2][f] for f in FIELDS] == [0] * 5
    assert rows[3].reading == np.float32(-123.45) and rows[3].max_voltage == -300
    assert math.isnan(rows[4].reading) and rows[4].average_current == math.inf


def test_errors_and_skips(spark):
    cases = {
        "010203040": ("error", "failed to decode hex payload"),
        "010203040506070G": ("error", "failed to decode hex payload"),
        "00" * 24 + "\n": ("error", "failed to decode hex payload"),
        "00" * 23: ("error", "invalid payload length: expected 24 bytes, got 23 bytes"),
        "00" * 25: ("error", "invalid payload length: expected 24 bytes, got 25 bytes"),
        "": ("skipped", "empty_payload"),
        None: ("skipped", "empty_payload"),
    }
    rows = run(spark, list(cases))
    for i, want in enumerate(cases.values()):
        assert (rows[i].outcome, rows[i].detail) == want
        assert all(rows[i][f] is None for f in FIELDS) and rows[i].processed_timestamp is None


def test_decoder_alone_calls_empty_text_a_length_error(spark):
    df = spark.createDataFrame([("",)], "p string")
    (row,) = decode.decode_meter(df, "p", "d").select("d.error").collect()
    assert row.error == "invalid payload length: expected 24 bytes, got 0 bytes"


def test_upstream_error_is_skipped_before_decoding(spark):
    rows = run(spark, ["not hex", ""], processing_error=F.lit("device metadata not found"))
    assert {r.detail for r in rows.values()} == {"upstream_error"}


def test_decoder_is_chosen_by_category(spark):
    def doubled(df, payload, into):
        value = F.struct(
            F.lit(None).cast("string").alias("error"),
            F.lit("TWO").alias("uid"),
            *[F.lit(2.0).cast("float").alias(f) for f in FIELDS],
        )
        return df.withColumn(into, value)

    decoders = {**decode.DECODERS, "Two": doubled}
    df = spark.createDataFrame(
        [("HVAC", packed("XUID", 1, 1, 1, 1, 1)), ("Pump", "anything")],
        "device_category string, raw_payload string",
    )
    rows = {
        r.device_category: r
        for r in decode.decode(df, decoders=decoders, type_of_category={"Pump": "Two"}).collect()
    }
    assert rows["HVAC"].uid == "XUID" and rows["HVAC"].device_type == "XDevice"
    assert rows["Pump"].uid == "TWO" and rows["Pump"].device_type == "Two"
    with pytest.raises(ValueError):
        decode.decode(df, type_of_category={"Pump": "Nobody"})
