"""Verification records, counts and latencies."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom.operators import verify
from gridloom.sinks import tables

T0 = datetime(2024, 1, 1, 12, 0, 0)


def records(spark, *rows):
    return spark.createDataFrame(
        [(p, s, t) for p, s, t in rows], "payload string, topic_source string, publish_time timestamp"
    )


def body(eui, **more):
    extra = "".join(f',"{k}":"{v}"' for k, v in more.items())
    return f'{{"device_eui":"{eui}"{extra}}}'


def test_latency_is_from_the_client_time(spark):
    rows = records(
        spark,
        (body("A", original_mqtt_time="2024-01-01T12:00:00Z", client_message_id="m1"), "enriched", T0 + timedelta(milliseconds=100)),
        (body("B", original_mqtt_time="2024-01-01T12:00:00Z"), "unidentified", T0 + timedelta(milliseconds=100)),
        (body("C", original_mqtt_time="0001-01-01T00:00:00Z"), "enriched", T0),
        (body("D", original_mqtt_time="2024-01-01T12:00:00Z"), "enriched", None),
        ("this is not valid json {", "enriched", T0),
    )
    got = {r.device_eui: r for r in verify.verify_records(rows, F.lit(T0 + timedelta(milliseconds=150))).collect()}
    assert set(got) == {"A", "B", "C", "D"}
    assert got["A"].latency_ms == 150 and got["A"].processing_latency_ms == 100
    assert got["A"].client_message_id == "m1" and got["B"].client_message_id == ""
    assert got["B"].topic_source == "unidentified"
    assert got["C"].latency_ms is None and got["C"].original_client_timestamp is None
    assert got["D"].processing_latency_ms == 0


def test_differences_are_truncated_toward_zero(spark):
    from gridloom.functions.times import millis_between

    df = spark.sql("select timestamp'2024-01-01 00:00:00' a, timestamp'2024-01-01 00:00:00.001999' b")
    row = df.select(millis_between(F.col("b"), F.col("a")).alias("x"), millis_between(F.col("a"), F.col("b")).alias("y")).first()
    assert (row.x, row.y) == (1, -1)


@pytest.fixture
def run(spark):
    rows = [("K1", "enriched")] * 9 + [("K2", "enriched")] * 7 + [("U1", "unidentified")] * 8 + [("K2", "unidentified")]
    df = spark.createDataFrame(rows, "device_eui string, topic_source string")
    plan = spark.createDataFrame(
        [("K1", True, 10.0, 0.99), ("K2", True, 10.0, 0.99), ("U1", False, 8.0, 1.0), ("K3", True, 10.0, 0.99)],
        "device_eui string, known boolean, duration_s double, rate double",
    )
    return df, plan


def test_completeness_and_violations(run):
    records_, plan = run
    got = {r.device_eui: tuple(r)[2:] for r in verify.completeness(records_, plan).collect()}
    assert got == {
        "K1": (9, 9, True, True),
        "K2": (9, 7, False, True),
        "U1": (8, 8, True, True),
        "K3": (9, 0, False, False),
    }
    assert [(r.device_eui, r.wrong_messages) for r in verify.violations(records_, plan).collect()] == [("K2", 1)]


def test_summary_is_written_as_two_tables(spark, tmp_path):
    rows = records(spark, (body("A", original_mqtt_time="2024-01-01T12:00:00Z"), "enriched", T0))
    recs = verify.verify_records(rows, F.lit(T0 + timedelta(seconds=1)))
    summary = verify.verify_summary(recs, {"test_run_id": "r"})
    tables.write_verification(summary, recs, str(tmp_path))
    assert spark.read.json(str(tmp_path / "summary")).first().total_messages_verified == 1
    assert spark.read.json(str(tmp_path / "records")).first().latency_ms == 1000
