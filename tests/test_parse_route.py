"""Message parsing and routing on hand-written messages."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom.operators import joins, parse, route
from gridloom.schemas import ENVELOPE, REGISTRY
from gridloom.sinks import tables
from gridloom.sources.landed import RegistrySnapshot, device_registry, from_kafka

T0 = datetime(2023, 10, 26, 10, 0, 0)

VALID = (
    '{"device_info":{"device_eui":"0102030405060708"},'
    '"lorawan_data":{"rssi":-50,"snr":10.5,"data_rate":"SF7BW125","frequency":868.1,'
    '"gateway_eui":"AABBCCDDEEFF0011","received_at":"2023-10-26T09:59:59Z"},'
    '"raw_payload":"AQIDBAUGBwg=","message_id":"inner","topic":"inner",'
    '"message_timestamp":"2023-10-26T10:00:00Z"}'
)


def parsed(spark, *texts):
    rows = [(str(i), "t", text, T0) for i, text in enumerate(texts)]
    out = parse.parse_messages(spark.createDataFrame(rows, ENVELOPE)).collect()
    return sorted(out, key=lambda r: int(r.message_id))


def test_valid_message_has_all_fields(spark):
    (row,) = parsed(spark, VALID)
    assert row.parsed and row.device_eui == "0102030405060708"
    assert row.message_id == "0" and row.topic == "t"
    assert row.lorawan_data.rssi == -50 and row.lorawan_data.snr == 10.5
    assert row.lorawan_data.data_rate == "SF7BW125" and row.lorawan_data.frequency == 868.1
    assert row.lorawan_data.gateway_eui == "AABBCCDDEEFF0011"
    assert row.lorawan_data.received_at == T0 - timedelta(seconds=1)
    assert row.raw_payload == "AQIDBAUGBwg=" and row.message_timestamp == T0


@pytest.mark.parametrize(
    "text",
    [
        "{}",
        "null",
        ' \t{"raw_payload":"x"}\n',
        '{"device_info":null,"raw_payload":null,"message_timestamp":null}',
        '{"unknown":{"a":[1,{"b":2}]},"raw_payload":"x"}',
        '{"raw_payload":"x","raw_payload":"y"}',
        '{"lorawan_data":{"snr":1e3,"rssi":4294967296,"frequency":868}}',
        '{"message_timestamp":"2023-10-26T10:00:00.123456789+02:00"}',
        '{"message_timestamp":"0001-01-01T00:00:00Z"}',
    ],
)
def test_accepted_messages(spark, text):
    assert parsed(spark, text)[0].parsed


@pytest.mark.parametrize(
    "text",
    [
        None,
        "",
        "this is not valid json {",
        VALID[:-1],
        VALID[:-1] + " // comment",
        VALID + " {}",
        "{} x}",
        "{},{}",
        "{},0] {}",
        "[]",
        "[{}]",
        "5",
        '"text"',
        "{'raw_payload':'x'}",
        '{"raw_payload":5}',
        '{"raw_payload":{"a":1}}',
        '{"device_info":"x"}',
        '{"device_info":[]}',
        '{"device_info":{"device_eui":7}}',
        '{"lorawan_data":{"rssi":"-50"}}',
        '{"lorawan_data":{"rssi":1.5}}',
        '{"lorawan_data":{"snr":"7"}}',
        '{"lorawan_data":{"snr":NaN}}',
        '{"message_timestamp":"2023-10-26"}',
        '{"message_timestamp":""}',
        '{"message_timestamp":"2023-02-30T10:00:00Z"}',
        '{"message_timestamp":1698314400}',
        '{"raw_payload":"good","lorawan_data":{"received_at":"yesterday"}}',
    ],
)
def test_rejected_messages(spark, text):
    row = parsed(spark, text)[0]
    assert not row.parsed and row.raw_payload is None and row.device_eui is None


def test_missing_fields_times_and_repeats(spark):
    rows = parsed(
        spark,
        "{}",
        '{"raw_payload":"x","raw_payload":"y"}',
        '{"message_timestamp":"2023-10-26T10:00:00.5+02:00"}',
        '{"message_timestamp":"0001-01-01T00:00:00Z"}',
    )
    assert rows[0].device_eui is None and rows[0].raw_payload is None
    assert rows[1].raw_payload == "y"
    assert rows[2].message_timestamp == datetime(2023, 10, 26, 8, 0, 0, 500000)
    assert rows[3].message_timestamp is None


def message(eui, payload="00"):
    return f'{{"device_info":{{"device_eui":"{eui}"}},"raw_payload":"{payload}","message_timestamp":"2023-10-26T10:00:00Z"}}'


CASES = {
    message("DEV001"): ("enriched", None),
    message("DEV404"): ("unidentified", "device metadata not found"),
    message("DEV-HALF"): ("quarantine", "incomplete_metadata"),
    message(""): ("quarantine", "invalid_message"),
    "{}": ("quarantine", "invalid_message"),
    "null": ("quarantine", "invalid_message"),
    "this is not valid json {": ("quarantine", "parse_error"),
}


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(
        [("DEV001", "ClientA", "Loc1", "Sensor"), ("DEV-HALF", "ClientB", "", "Sensor")], REGISTRY
    )


@pytest.mark.parametrize("max_rows", [500_000, 0])
def test_every_message_takes_one_exit(spark, registry, max_rows):
    rows = [(str(i), "t", text, T0) for i, text in enumerate(CASES)]
    routed = route.route(
        spark.createDataFrame(rows, ENVELOPE), registry, F.lit(T0), max_rows=max_rows
    ).collect()
    got = {int(r.message_id): (r.exit, r.reason) for r in routed}
    assert len(routed) == len(CASES)
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())
    known = next(r for r in routed if r.exit == "enriched")
    assert (known.client_id, known.location_id, known.device_category) == ("ClientA", "Loc1", "Sensor")
    assert known.original_client_timestamp == known.original_mqtt_time == T0
    assert known.ingestion_timestamp == T0 and known.client_message_id is None


def test_quarantine_keeps_the_whole_text(spark, registry):
    text = "x" * 250
    rows = spark.createDataFrame([("1", "t", text, T0)], ENVELOPE)
    (row,) = route.quarantine(route.route(rows, registry)).collect()
    assert row.payload == text and row.snippet == "x" * 100


def test_topic_records_carry_attributes(spark, registry):
    rows = [("1", "t", message("DEV001"), T0), ("2", "t", message("DEV404"), T0)]
    routed = route.route(spark.createDataFrame(rows, ENVELOPE), registry, F.lit(T0))
    records = {r.message_id: r for r in route.topic_records(routed).collect()}
    assert records["1"].attributes == {
        "message_type": "enriched", "device_eui": "DEV001", "client_id": "ClientA", "category": "Sensor",
    }
    assert records["2"].attributes == {
        "message_type": "unidentified", "device_eui": "DEV404", "error_reason": "device metadata not found",
    }
    assert '"lorawan_received_at":"0001-01-01T00:00:00Z"' in records["1"].payload


def test_salted_lookup_equals_broadcast(spark):
    facts = spark.range(2000).selectExpr(
        "cast(id as string) id", "case when id % 3 = 0 then 'hot' else cast(id % 50 as string) end k"
    )
    dim = spark.range(40).selectExpr("cast(id as string) k", "id * 2 v").unionByName(
        spark.sql("select 'hot' k, 999L v")
    )
    for how in ("left", "inner"):
        small = joins.lookup_join(facts, dim, ["k"], ["id"], how)
        large = joins.lookup_join(facts, dim, ["k"], ["id"], how, max_rows=1)
        assert "_salt" not in large._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
        assert sorted(small.collect()) == sorted(large.collect())
    hot = joins.lookup_join(facts, dim, ["k"], ["id"], max_rows=1, salts=8)
    assert hot.where("k = 'hot'").count() == 667


def test_registry_has_one_row_per_device(spark):
    twice = spark.createDataFrame([("D", "c1", "l1", "x"), ("D", "c2", "l2", "x")], REGISTRY)
    assert [tuple(r) for r in device_registry(twice).collect()] == [("D", "c2", "l2", "x")]


def test_snapshot_holds_data_reloads_and_survives_failures(spark, tmp_path):
    now, path = [0.0], str(tmp_path / "registry")

    def replace(*devices):
        rows = [(d, "c", "l", "x") for d in devices]
        spark.createDataFrame(rows, REGISTRY).write.mode("overwrite").parquet(path)

    def load():
        if now[0] == 20:
            raise OSError("registry away")
        return spark.read.schema(REGISTRY).parquet(path)

    def devices():
        return sorted(r.device_eui for r in snapshot.get().collect())

    snapshot = RegistrySnapshot(load, ttl=10, clock=lambda: now[0])
    replace("D1")
    assert devices() == ["D1"]
    replace("D1", "D2")  # the files that were loaded are gone
    now[0] = 9
    assert devices() == ["D1"]
    now[0] = 10
    assert devices() == ["D1", "D2"]
    replace("D3")
    now[0] = 20
    assert devices() == ["D1", "D2"]
    now[0] = 21
    assert devices() == ["D3"]


def test_snapshot_needs_a_first_load():
    def load():
        raise OSError("registry away")

    with pytest.raises(OSError):
        RegistrySnapshot(load).get()


def test_kafka_headers_become_attributes(spark):
    records = spark.createDataFrame(
        [("k", "{}", {"device_eui": "D1", "category": "é"}), ("l", "{}", {})],
        "message_id string, payload string, attributes map<string,string>",
    )
    sent = tables.to_kafka(records).select(
        F.col("value").cast("binary"), "headers", F.lit("t").alias("topic"), F.lit(3).alias("partition"),
        F.col("key").alias("offset"), F.lit(T0).alias("timestamp"),
    )
    got = {r.message_id: r.attributes for r in from_kafka(sent).collect()}
    assert got == {"3-k": {"device_eui": "D1", "category": "é"}, "3-l": {}}
    twice = "array(named_struct('key', 'a', 'value', cast('1' as binary)), named_struct('key', 'a', 'value', cast('2' as binary)))"
    (row,) = from_kafka(sent.limit(1).withColumn("headers", F.expr(twice))).collect()
    assert row.attributes == {"a": "2"}


@pytest.mark.parametrize(
    "text",
    [
        '{"a":1}],"items":[{"device_info":{"device_eui":"B"}}',
        '{"device_info":{"device_eui":"C"}}],"items":[{}',
        '{"device_info":{"device_eui":"C"}}],"items":[{},{}',
        '{"device_info":{"device_eui":"C"}}],"other":[{}',
        '{"device_info":{"device_eui":"C"}},{"device_info":{}}',
        '{"device_info":{"device_eui":"C"}}]',
        '],"items":[{"device_info":{"device_eui":"C"}}',
        '{"device_info":{"device_eui":"C"}}]},{"items":[{}',
        '{"device_info":{"device_eui":["C"]}}',
        '{"device_info":{"device_eui":"C"}}}',
    ],
)
def test_text_cannot_close_its_frame(spark, text):
    rows = spark.createDataFrame([("1", "t", text, T0)], ENVELOPE)
    assert not parse.parse_messages(rows).first().parsed


def test_kafka_columns(spark):
    rows = spark.sql(
        "select cast('{}' as binary) value, 't' topic, 3 partition, 7L offset, timestamp'2024-01-01' timestamp"
    )
    (row,) = from_kafka(rows).collect()
    assert (row.message_id, row.topic, row.payload) == ("3-7", "t", "{}")
