"""Corrected alerts and retried messages against their batch twins, with failures."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gridloom.operators import route, usage
from gridloom.schemas import ENVELOPE, METER_READING
from gridloom.sinks import tables
from gridloom.sources.landed import RegistrySnapshot
from gridloom.streaming import jobs, reconcile, retry

START = datetime(2024, 1, 1)


def reading(at, arrived, value, place="L", device="D"):
    given = {
        "reading": value, "location_id": place, "device_eui": device, "device_category": "c",
        "original_mqtt_time": at, "upstream_ingestion_timestamp": at if arrived is None else arrived,
    }
    return tuple(given.get(f.name) for f in METER_READING.fields)


def limits(spark):
    return spark.sql("select * from values ('L', 64.0D), ('M', 8.0D), ('*', 32.0D) as t(location_id, threshold_kwh)")


def plain(df):
    return sorted(map(repr, df.collect()))


def feed(spark, tmp_path, batches, fail_at=None):
    """Send batches through the job; the one that fails after its write is sent again."""
    book = reconcile.AlertBook(spark, f"{tmp_path}/book")
    good, failed = tables.batch_sink(f"{tmp_path}/out"), []

    def sink(df, batch_id):
        good(df, batch_id)
        if batch_id == fail_at and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    for number, rows in enumerate(batches):
        df = spark.createDataFrame(rows, METER_READING)
        job = reconcile.reconciled_alerts(reconcile.AlertBook(spark, f"{tmp_path}/book"), sink, limits(spark))
        try:
            job(df, number)
        except RuntimeError:
            job(df, number)
        job(df, number)  # sent again after its commit
    return book, tables.read_batches(spark, f"{tmp_path}/out", reconcile.CORRECTION)


def expected(spark, batches, closed_to):
    rows = spark.createDataFrame([r for b in batches for r in b], METER_READING)
    batch = usage.peak_alerts(usage.intervals(rows, ["location_id"]), limits(spark))
    return batch.where(F.unix_micros("interval_start") + 900_000_000 <= closed_to)


@pytest.mark.parametrize("late", [10, 60, 600])
def test_a_late_batch_is_corrected(spark, tmp_path, late):
    hour = lambda n, value, place="L": reading(START + timedelta(hours=n), None, value, place)
    at = START + timedelta(hours=20) - timedelta(minutes=late)
    batches = [
        [hour(n, 60.0) for n in range(0, 16)],
        [hour(n, 60.0) for n in range(16, 22)],
        # Late in the transport, with a clock that fits it, and a location of its own.
        [reading(at, at, 10.0), reading(at, at, 9.0, "M"), reading(at, at, 31.0, "N")],
        [hour(30, 1.0)],
    ]
    book, sent = feed(spark, tmp_path, batches, fail_at=2)
    assert plain(reconcile.in_force(sent)) == plain(expected(spark, batches, book.closed_to()).select(*reconcile.in_force(sent).columns))
    if late == 600:  # the interval had been judged: its warning is taken back
        signs = {(r.level, r.sign) for r in sent.where("location_id = 'L'").groupBy("level", "sign").count().collect()}
        assert signs == {("warning", 1), ("warning", -1), ("breach", 1)}


def test_the_probed_case(spark, tmp_path):
    """A lagging partition: 10:01 comes after 15:00 with a clock that fits."""
    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    batches = [[reading(at(h), None, 1.0)] for h in (10, 14, 15)]
    batches += [[reading(at(10, 1), None, 640.0)], [reading(at(18), None, 1.0)], [reading(at(20), None, 1.0)]]
    _, sent = feed(spark, tmp_path, batches)
    (found,) = reconcile.in_force(sent).collect()
    assert (found.interval_start, found.kwh, found.level) == (at(10), 641.0, "breach")


@pytest.mark.parametrize("size", [7, 40])
def test_any_order_gives_the_same(spark, tmp_path, size):
    draw = random.Random(size)
    rows = [
        reading(START + timedelta(minutes=draw.randrange(3000)), None, draw.randrange(1, 200) / 8, draw.choice("LMN"), f"D{i % 9}")
        for i in range(120)
    ]
    rows += [reading(None, START, 5.0), reading(datetime(2031, 1, 1), START, 99.0), reading(START, START, float("nan"))]
    draw.shuffle(rows)
    batches = [rows[i : i + size] for i in range(0, len(rows), size)][:6]
    book, sent = feed(spark, tmp_path, batches, fail_at=1)
    far = spark.range(1).select(F.unix_micros(F.lit("2032-01-01").cast("timestamp"))).first()[0]
    sink = tables.batch_sink(f"{tmp_path}/last")
    reconcile.close_intervals(book, sink, limits(spark), far, "end", 0)
    whole = sent.unionByName(tables.read_batches(spark, f"{tmp_path}/last", reconcile.CORRECTION))
    names = reconcile.in_force(whole).columns
    assert plain(reconcile.in_force(whole)) == plain(expected(spark, batches, far).select(*names))


def test_locations_without_threshold_are_told(spark):
    rows = spark.createDataFrame([reading(START, None, 1.0, p) for p in "LLX"], METER_READING)
    own = spark.sql("select 'L' location_id, 64.0D threshold_kwh")
    got = usage.without_threshold(usage.intervals(rows, ["location_id"]), own).collect()
    assert [(r.location_id, r.n_intervals, r.kwh) for r in got] == [("X", 1, 1.0)]


# --- retry


def envelope(message_id, eui, at=START):
    payload = json.dumps({"device_info": {"device_eui": eui}, "raw_payload": "00"})
    given = {"message_id": message_id, "topic": "t", "payload": payload, "publish_time": at}
    return tuple(given[f.name] for f in ENVELOPE.fields)


def snapshot(spark, entries):
    schema = "device_eui string, client_id string, location_id string, device_category string"
    return RegistrySnapshot(lambda: spark.createDataFrame(entries, schema), 0)


def written(spark, path):
    schema = route.route(spark.createDataFrame([], ENVELOPE), snapshot(spark, []).get()).schema
    return tables.read_batches(spark, path, StructType([*schema.fields, StructField("tries", IntegerType())]))


@pytest.mark.parametrize("fail_at", [None, 0, 1, 2])
def test_each_message_has_one_exit(spark, tmp_path, fail_at):
    """Three snapshots, a restart in each: completed and new devices are enriched once."""
    now, failed, out = [START.replace(tzinfo=timezone.utc)], [], f"{tmp_path}/out"
    good = tables.batch_sink(out)

    def sink(df, batch_id):
        good(df, batch_id)
        if batch_id == fail_at and not failed:
            failed.append(1)
            raise RuntimeError("lost after the write")

    full, partial = ("c", "l", "k"), ("c", "l", "")
    snapshots = [
        [("A", *full), ("B", *partial), ("C", *partial)],
        [("A", *full), ("B", *full), ("C", *partial)],
        [("A", *full), ("B", *full), ("C", *full), ("N", *full)],
    ]
    batches = [
        [envelope("1", "A"), envelope("2", "B"), envelope("3", "C"), envelope("4", ""), envelope("5", "N"), envelope("6", "Z")],
        [envelope("7", "B"), envelope("3", "C")],  # 3 is sent again while it waits
        [],
        [],
        [],
    ]
    for number, rows in enumerate(batches):
        reasons = [*retry.REFUSED, route.METADATA_NOT_FOUND]
        job = lambda: retry.Retry(
            snapshot(spark, snapshots[min(number, 2)]), retry.pending_table(spark, f"{tmp_path}/pending"), sink, 4, 60, reasons, lambda: now[0]
        )
        df = spark.createDataFrame(rows, ENVELOPE)
        try:
            job()(df, number)
        except RuntimeError:
            job()(df, number)
        job()(df, number)
        now[0] += timedelta(hours=1)
    got = sorted((r.message_id, r.exit, r.tries) for r in written(spark, out).collect())
    assert got == [
        ("1", "enriched", 1), ("2", "enriched", 2), ("3", "enriched", 3), ("4", "dead_letter", 4),
        ("5", "enriched", 3), ("6", "dead_letter", 4), ("7", "enriched", 1),
    ]
    assert retry.pending_table(spark, f"{tmp_path}/pending").current().count() == 0


def test_what_is_not_due_waits(spark, tmp_path):
    now = [START.replace(tzinfo=timezone.utc)]
    pending = retry.pending_table(spark, f"{tmp_path}/pending")
    job = retry.Retry(snapshot(spark, [("A", "c", "l", "k")]), pending, tables.batch_sink(f"{tmp_path}/out"), 9, 60, clock=lambda: now[0])
    job(spark.createDataFrame([envelope("1", "")], ENVELOPE), 0)
    tries = lambda: [(r.tries, r.due_at) for r in pending.current().collect()]
    first = tries()
    now[0] += timedelta(seconds=59)
    job.due_only("idle", 0)
    assert tries() == first and first[0][0] == 1
    now[0] += timedelta(seconds=1)
    job.due_only("idle", 1)
    ((n, due),) = tries()
    assert n == 2 and due - first[0][1] == timedelta(seconds=120)


# --- repeats


def test_a_message_sent_very_often(spark, tmp_path):
    payload = envelope("0", "A")[ENVELOPE.names.index("payload")]
    many = spark.range(30_000).select(
        F.col("id").cast("string").alias("message_id"),
        F.lit("t").alias("topic"),
        F.lit(payload).alias("payload"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 1_000_000).alias("publish_time"),
    )
    table = f"{tmp_path}/seen"
    sink = jobs.unique_batches(table, tables.batch_sink(f"{tmp_path}/out"), tables.batch_sink(f"{tmp_path}/again"), 60)
    sink(many.where("id % 2 = 0"), 0)
    sink(many.where("id % 2 = 1"), 1)
    sink(many.where("id = 5"), 1)
    count = lambda name: spark.read.parquet(f"{tmp_path}/{name}").count()
    assert (count("out"), count("again")) == (1, 29_999)
    assert jobs.seen_table(spark, table).current().count() == 500


def test_old_days_are_forgotten(spark, tmp_path):
    table = jobs.seen_table(spark, f"{tmp_path}/seen")
    sink = jobs.unique_batches(f"{tmp_path}/seen", tables.batch_sink(f"{tmp_path}/out"), keep_days=2)
    for number in range(6):
        sink(spark.createDataFrame([envelope(str(number), "A", START + timedelta(days=number))], ENVELOPE), number)
    assert table.partitions() == ["2024-01-04", "2024-01-05", "2024-01-06"]
    assert spark.read.parquet(f"{tmp_path}/out").count() == 6
