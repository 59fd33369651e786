"""The streaming jobs over the same tables, drained into a sink and read back."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gridloom import session
from gridloom.operators import route
from gridloom.plans import parameters
from gridloom.plans.meter import Meter
from gridloom.schemas import METER_READING
from gridloom.sinks import tables
from gridloom.sources import derived
from gridloom.sources.landed import RegistrySnapshot, archived_payload
from gridloom.streaming import jobs, reconcile, retry


class StreamMeter(Meter):
    """The message flow with the events table read as a stream."""

    @property
    def envelopes(self) -> DataFrame:
        return derived.envelopes(derived.events_stream(self.spark, self.sf_dir))

    @property
    def snapshot(self) -> RegistrySnapshot:
        return RegistrySnapshot(lambda: derived.registry(self.spark, self.sf_dir))


def _stream(m: Meter) -> StreamMeter:
    return StreamMeter(m.spark, m.sf_dir)


def _drain(m: Meter, stream: DataFrame, sink: tables.Sink, mode: str = "append") -> None:
    checkpoint = session.shared_folder(m.spark, "checkpoint")
    jobs.start(stream, sink, checkpoint, mode).awaitTermination()


def stream_enrich(m: Meter) -> DataFrame:
    """Every message with its exit, as written by the routing job."""
    s, path = _stream(m), session.shared_folder(m.spark, "routed")
    sink = jobs.route_batches(s.snapshot, tables.batch_sink(path, ["exit"]), F.col("publish_time"))
    _drain(m, s.envelopes, sink)
    schema = route.route(m.envelopes, m.registry, F.col("publish_time")).schema
    return tables.read_batches(m.spark, path, schema).select(
        "message_id", "exit", "reason", "location_id", "original_mqtt_time"
    )


def stream_readings(m: Meter) -> DataFrame:
    s, path = _stream(m), session.shared_folder(m.spark, "readings")
    day = lambda df, batch_id: tables.batch_sink(path, ["reading_day"])(tables.by_day(df), batch_id)
    sink = jobs.reading_batches(s.snapshot, day, F.col("publish_time"), F.col("publish_time"))
    _drain(m, s.envelopes, sink)
    return tables.read_batches(m.spark, path, METER_READING)


def stream_archive(m: Meter) -> DataFrame:
    """Archived lines of the landed topics."""
    s, root = _stream(m), session.shared_folder(m.spark, "archive")
    path = tables.archive_path(root)
    archive = jobs.archive_batches(tables.archive_sink(path), F.col("publish_time"), spread=False)

    def topics(df: DataFrame) -> DataFrame:
        routed = route.route(df, s.registry, F.col("publish_time"))
        return derived.landed_topics(route.topic_records(routed))

    _drain(m, s.envelopes, jobs.per_batch(topics, archive))
    lines = m.spark.read.schema("value string, location string").option("basePath", path).text(path)
    head = F.from_json("value", "device_eui string, archived_at string")
    return lines.select(
        "location",
        head["device_eui"].alias("device_eui"),
        head["archived_at"].alias("archived_at"),
        archived_payload(F.col("value")).alias("payload"),
    )


def stream_dedup(m: Meter) -> DataFrame:
    """Every tenth message is sent twice; the job lets each through once."""
    s, path = _stream(m), session.shared_folder(m.spark, "deduplicated")
    copies = F.when(F.col("message_id").cast("bigint") % 10 == 0, 2).otherwise(1)
    twice = s.envelopes.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    seen = session.shared_folder(m.spark, "seen")
    _drain(m, twice, jobs.unique_batches(seen, tables.batch_sink(path)))
    return tables.read_batches(m.spark, path, m.parsed.select("message_id", *jobs.REPEAT_KEY).schema)


def stream_demand(m: Meter) -> DataFrame:
    s = _stream(m)
    table = jobs.demand_table(m.spark, session.shared_folder(m.spark, "demand"))
    _drain(m, s.readings, jobs.demand_batches(table))
    return table.current()


def stream_peak_alerts(m: Meter) -> DataFrame:
    """Alerts of all intervals that were closed when the stream ended."""
    s, path = _stream(m), session.shared_folder(m.spark, "alerts")
    limits = parameters.thresholds(parameters.locations(m.table("nation")))
    alerts = jobs.peak_alerts(s.readings, limits)
    _drain(m, alerts, tables.batch_sink(path))
    return tables.read_batches(m.spark, path, alerts.schema)


def stream_alerts_reconciled(m: Meter) -> DataFrame:
    """Alerts after corrections, of readings that come up to ten hours late.

    The readings land in four parts, by the time when they arrive: every tenth or so
    is 10, every fortieth 60 and every hundredth 600 minutes late.
    """
    folder, path = (session.shared_folder(m.spark, name) for name in ("late", "corrections"))
    draw = F.pmod(F.xxhash64("device_eui", "original_mqtt_time"), F.lit(200))
    late = F.when(draw < 2, 600).when(draw < 7, 60).when(draw < 27, 10).otherwise(0)
    at = F.unix_micros("original_mqtt_time") + late.cast("long") * 60_000_000
    readings = session.settle(m.readings.withColumn("arrived", at), "readings")
    # The parts need not be equal, only come one after the other.
    low, high = readings.agg(F.min("arrived"), F.max("arrived")).first()
    for part in range(4):
        first, last = (low + (high - low) * n // 4 for n in (part, part + 1)) if high is not None else (0, 0)
        rows = readings.where((F.col("arrived") > first) | F.lit(part == 0)).where((F.col("arrived") <= last) | F.lit(part == 3))
        rows.drop("arrived").coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.01)  # files are taken in order of their time
    stream = m.spark.readStream.schema(METER_READING).option("maxFilesPerTrigger", 1).parquet(folder)
    book = reconcile.AlertBook(m.spark, session.shared_folder(m.spark, "book"))
    limits = parameters.thresholds(parameters.locations(m.table("nation")))
    _drain(m, stream, reconcile.reconciled_alerts(book, tables.batch_sink(path), limits))
    return reconcile.in_force(tables.read_batches(m.spark, path, reconcile.CORRECTION))


def stream_retry(m: Meter) -> DataFrame:
    """Each message's last exit, when the registry is completed while refused ones wait."""
    s, path = _stream(m), session.shared_folder(m.spark, "retried")
    key = F.substring("device_eui", 5, 20).cast("bigint")
    state = {"completed": 0}

    def load() -> DataFrame:
        """Every 22nd device gets its category after the first try, every 33rd after the second."""
        late = ((key % 22 == 0) & F.lit(state["completed"] >= 1)) | ((key % 33 == 0) & F.lit(state["completed"] >= 2))
        category = F.when(late & (F.col("device_category") == ""), "LATE").otherwise(F.col("device_category"))
        return derived.registry(m.spark, m.sf_dir).withColumn("device_category", category)

    hours = lambda: datetime(2024, 1, 1, state["completed"], tzinfo=timezone.utc)
    pending = retry.pending_table(m.spark, session.shared_folder(m.spark, "pending"))
    job = retry.Retry(RegistrySnapshot(load, 0), pending, tables.batch_sink(path), 3, 60, clock=hours, ingested_at=F.col("publish_time"))
    _drain(m, s.envelopes, job)
    for tries in (1, 2):
        state["completed"] = tries
        job.due_only("idle", tries)
    schema = route.route(m.envelopes, m.registry, F.col("publish_time")).schema
    written = StructType([*schema.fields, StructField("tries", IntegerType())])
    return tables.read_batches(m.spark, path, written).select(
        "message_id", "exit", "reason", "device_category", "tries"
    )


QUERIES = [
    stream_enrich,
    stream_readings,
    stream_archive,
    stream_dedup,
    stream_demand,
    stream_peak_alerts,
    stream_alerts_reconciled,
    stream_retry,
]
