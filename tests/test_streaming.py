"""Streaming jobs against their batch twins, in pieces and after a restart."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.operators import archive, decode, route, usage
from gridloom.plans.meter import Meter
from gridloom.schemas import METER_READING
from gridloom.sinks import tables
from gridloom.sources import landed
from gridloom.sources.landed import RegistrySnapshot
from gridloom.streaming import jobs


@pytest.fixture(scope="module")
def land(spark, sf_dir, tmp_path_factory):
    """The messages as four landed files in order of time."""
    folder = str(tmp_path_factory.mktemp("landed"))
    m = Meter(spark, sf_dir)
    rows = m.envelopes.orderBy("publish_time").toPandas()
    size = len(rows) // 4 + 1
    for i in range(4):
        part = spark.createDataFrame(rows[i * size : (i + 1) * size], m.envelopes.schema)
        micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
        part.coalesce(1).write.mode("append").json(folder, timestampFormat=micros)
    return m, folder


def rows(df):
    return sorted(map(repr, df.collect()))


def registry(m):
    return RegistrySnapshot(lambda: m.registry)


@pytest.mark.parametrize("max_files", [1, 3, None])
def test_routing_equals_batch(spark, land, tmp_path, max_files):
    m, folder = land
    stream = landed.landed_envelope_stream(spark, folder, "json", max_files)
    sink = jobs.route_batches(registry(m), tables.batch_sink(f"{tmp_path}/out", ["exit"]), F.col("publish_time"))
    jobs.start(stream, sink, f"{tmp_path}/checkpoint").awaitTermination()
    batch = m.routed
    got = tables.read_batches(spark, f"{tmp_path}/out", batch.schema)
    assert rows(got) == rows(batch)
    assert got.select("message_id").distinct().count() == got.count() == 1000


def test_restart_neither_loses_nor_doubles(spark, land, tmp_path):
    m, folder = land
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    good = tables.batch_sink(out)

    def failing(df, batch_id):
        good(df, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost after the write")

    def run(sink):
        stream = landed.landed_envelope_stream(spark, folder, "json", 1)
        readings = jobs.reading_batches(registry(m), sink, F.col("publish_time"), F.col("publish_time"))
        jobs.start(stream, readings, checkpoint).awaitTermination()

    with pytest.raises(Exception, match="lost after the write"):
        run(failing)
    run(good)
    got = tables.read_batches(spark, out, METER_READING)
    assert rows(got) == rows(m.readings)


def test_archive_equals_batch(spark, land, tmp_path):
    m, folder = land
    path = tables.archive_path(str(tmp_path))
    sink = jobs.archive_batches(tables.archive_sink(path, 50), F.col("publish_time"))

    def topics(df):
        return route.topic_records(route.route(df, m.registry, F.col("publish_time")))

    def run():
        stream = landed.landed_envelope_stream(spark, folder, "json", 3)
        jobs.start(stream, jobs.per_batch(topics, sink), f"{tmp_path}/checkpoint").awaitTermination()

    run()
    routes = archive.archive_routes(route.topic_records(m.routed))
    want = archive.archive_records(routes, F.col("publish_time"))
    got = spark.read.option("basePath", path).text(path).select("value")
    assert rows(got) == rows(want.select(F.col("line").alias("value")))
    # The age rule finds and removes what the stream wrote, days and all.
    due = archive.retention_candidates(want, F.lit("2024-01-20").cast("timestamp"), 10)
    assert tables.expire_archive(spark, path, due, act=True)
    left = landed.read_archive(spark, path, "2024-01-01", "2024-01-31")
    kept = want.where("publish_time >= timestamp'2024-01-11'")
    assert left.count() == kept.count() > 0


def messages(folder, *files):
    """Landed files, one micro-batch each, of (id, device, device time, publish time)."""
    folder.mkdir()
    for n, lines in enumerate(files):
        text = "".join(
            json.dumps({
                "message_id": i, "topic": "t", "publish_time": sent,
                "payload": json.dumps({"device_info": {"device_eui": eui}, "raw_payload": "00", "message_timestamp": at}),
            }) + "\n"
            for i, eui, at, sent in lines
        )
        (folder / f"{n}.json").write_text(text)
        os.utime(folder / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder)


def test_each_message_is_passed_or_a_repeat(spark, tmp_path):
    """A clock years ahead, out of order and old messages, a failure: none is lost."""
    t = "2024-01-01T0{}:00:00Z".format
    folder = messages(
        tmp_path / "landed",
        [("1", "A", "2031-01-01T00:00:00Z", t(1)), ("2", "A", t(1), t(1)), ("3", "A", t(1), t(1))],
        [("4", "B", t(1), t(2)), ("5", "A", t(1), "2024-01-01T01:30:00Z")],
        [("6", "A", t(1), t(5)), ("7", "C", "2019-01-01T00:00:00Z", t(2))],
        [("8", "C", "2019-01-01T00:00:00Z", "2024-01-01T01:30:00Z"), ("9", "D", t(1), "2023-12-01T00:00:00Z")],
        [("10", "A", t(1), t(1)), ("11", "E", t(1), t(9))],
    )
    out, again, failed = f"{tmp_path}/out", f"{tmp_path}/again", []

    def failing(df, batch_id):
        tables.batch_sink(again)(df, batch_id)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    def run():
        stream = landed.landed_envelope_stream(spark, folder, "json", 1)
        jobs.start(stream, jobs.unique_batches(f"{tmp_path}/seen", tables.batch_sink(out), failing), f"{tmp_path}/checkpoint").awaitTermination()

    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    ids = lambda path: sorted(int(r.message_id) for r in tables.read_batches(spark, path, StructType().add("message_id", "string")).collect())
    assert ids(out) == [1, 2, 4, 6, 7, 9, 11]
    assert ids(again) == [3, 5, 8, 10]


def test_a_new_checkpoint_leaves_the_old_rows(spark, land, tmp_path):
    m, folder = land
    sink = tables.batch_sink(f"{tmp_path}/out")
    for checkpoint in ("a", "b", "b"):
        stream = landed.landed_envelope_stream(spark, folder, "json", 2)
        jobs.start(stream, sink, f"{tmp_path}/{checkpoint}").awaitTermination()
    got = spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out")
    assert got.select("run").distinct().count() == 2
    assert got.groupBy("run").count().select("count").distinct().collect() == [(1000,)]


def hourly(spark, tmp_path, wild):
    """Readings above the threshold, one an hour and file; ``wild`` ones have odd clocks."""
    folder = tmp_path / f"readings{len(wild)}"
    schema = METER_READING
    for n in range(8):
        at = datetime(2024, 1, 1, n)
        times = [(at, "in")] + ([(datetime(2031, 1, 1), "w"), (datetime(2020, 1, 1), "w"), (None, "w")] if n in wild else [])
        rows = [
            tuple({"reading": 100.0, "location_id": "L", "device_eui": d, "original_mqtt_time": t,
                   "upstream_ingestion_timestamp": at}.get(f.name) for f in schema.fields)
            for t, d in times
        ]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_odd_clocks_stop_no_alert(spark, tmp_path):
    limit = spark.sql("select '*' location_id, 64.0D threshold_kwh")
    found = {}
    for wild in ((), (0, 3, 6)):
        stream, out = hourly(spark, tmp_path, wild), f"{tmp_path}/out{len(wild)}"
        alerts = jobs.peak_alerts(stream, limit)
        jobs.start(alerts, tables.batch_sink(out), f"{out}-checkpoint").awaitTermination()
        found[wild] = rows(tables.read_batches(spark, out, alerts.schema))
        odd = jobs.out_of_time(stream)
        jobs.start(odd, tables.batch_sink(f"{out}-odd"), f"{out}-odd-checkpoint").awaitTermination()
        got = tables.read_batches(spark, f"{out}-odd", odd.schema).groupBy("clock").count().collect()
        assert {r.clock: r["count"] for r in got} == ({"ahead": 3, "late": 3, "none": 3} if wild else {})
    assert len(found[()]) == 6 and found[()] == found[(0, 3, 6)]


def reading_files(spark, land, max_files):
    m, folder = land
    stream = landed.landed_envelope_stream(spark, folder, "json", max_files)
    known = route.enriched(route.route(stream, m.registry, F.col("publish_time")), "publish_time")
    return m, decode.meter_readings(decode.decode(known, F.col("publish_time")))


@pytest.mark.parametrize("max_files", [1, 2])
def test_latest_demand_equals_batch(spark, land, tmp_path, max_files):
    m, stream = reading_files(spark, land, max_files)
    table = jobs.demand_table(spark, f"{tmp_path}/demand")
    jobs.start(stream, jobs.demand_batches(table), f"{tmp_path}/checkpoint").awaitTermination()
    assert rows(table.current()) == rows(usage.current_demand(m.readings))


@pytest.mark.parametrize("max_files", [1, None])
def test_alerts_come_once_for_closed_intervals(spark, land, tmp_path, max_files):
    m, stream = reading_files(spark, land, max_files)
    limit = spark.sql("select '*' location_id, 64.0D threshold_kwh")
    alerts = jobs.peak_alerts(stream, limit)
    jobs.start(alerts, tables.batch_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint").awaitTermination()
    got = tables.read_batches(spark, f"{tmp_path}/out", alerts.schema)
    last = m.readings.agg(F.max("original_mqtt_time")).first()[0]
    closed = last.replace(microsecond=last.microsecond // 1000 * 1000) - timedelta(hours=1, minutes=15)
    batch = usage.peak_alerts(usage.intervals(m.readings, ["location_id"]), limit)
    assert rows(got) == rows(batch.where(F.col("interval_start") <= F.lit(closed)).select(*got.columns))
    assert got.count() > 100


def test_registry_change_is_seen_by_the_next_batch(spark, tmp_path):
    def message(eui):
        return {"message_id": eui, "topic": "t", "payload": json.dumps({"device_info": {"device_eui": eui}}),
                "publish_time": datetime(2024, 1, 1).isoformat()}

    folder, entries = tmp_path / "landed", []
    folder.mkdir()

    def load():
        return spark.createDataFrame(entries, "device_eui string, client_id string, location_id string, device_category string")

    def run():
        stream = landed.landed_envelope_stream(spark, str(folder))
        sink = jobs.route_batches(RegistrySnapshot(load, 0), tables.batch_sink(f"{tmp_path}/out"))
        jobs.start(stream, sink, f"{tmp_path}/checkpoint").awaitTermination()

    (folder / "a.json").write_text(json.dumps(message("D1")))
    run()
    entries.append(("D1", "c", "l", "x"))
    (folder / "b.json").write_text(json.dumps(message("D1")))
    run()
    got = spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out").orderBy("batch_id")
    assert [r.exit for r in got.collect()] == ["unidentified", "enriched"]
