"""Structured Streaming jobs.

Each job is a source, the same transform that batch uses, and a sink.  Offsets
live in the checkpoint and sinks replace a repeated batch, so a restart neither
loses nor doubles a message.  ``available_now`` drains the source and stops.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gridloom import session
from gridloom.operators import archive, decode, parse, route, usage
from gridloom.operators.ordering import spread_small
from gridloom.sinks import tables
from gridloom.sinks.keyed import KeyedTable
from gridloom.sinks.tables import Sink
from gridloom.sources.landed import RegistrySnapshot


def start(
    stream: DataFrame,
    sink: Sink,
    checkpoint: str,
    mode: str = "append",
    available_now: bool = True,
    every: str = "1 minute",
) -> StreamingQuery:
    writer = (
        stream.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def per_batch(
    transform: Callable[[DataFrame], DataFrame], sink: Sink, spread: bool = True
) -> Sink:
    """Apply a batch transform inside the sink, so that it may look things up anew.

    A batch is spread over the cores where it comes from the source; a transform
    behind another one takes it as it is.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        sink(transform(spread_small(df, "message_id") if spread else df), batch_id)

    return write


def route_batches(registry: RegistrySnapshot, sink: Sink, ingested_at: Column | None = None) -> Sink:
    """All exits of a micro-batch in one write; the registry is at most its ttl old."""
    return per_batch(lambda df: route.route(df, registry.get(), ingested_at), sink)


def reading_batches(
    registry: RegistrySnapshot,
    sink: Sink,
    ingested_at: Column | None = None,
    processed_at: Column | None = None,
) -> Sink:
    """Meter readings of a micro-batch of raw messages."""

    def readings(df: DataFrame) -> DataFrame:
        known = route.enriched(route.route(df, registry.get(), ingested_at), "publish_time")
        return decode.meter_readings(decode.decode(known, processed_at))

    return per_batch(readings, sink)


def archive_batches(
    sink: Sink, archived_at: Column | None = None, spread: bool = True
) -> Sink:
    """Archive lines of a micro-batch of topic records."""
    return per_batch(
        lambda df: archive.archive_records(archive.archive_routes(df), archived_at), sink, spread
    )


REPEAT_KEY = ["device_eui", "message_timestamp", "raw_payload"]


SEEN = (
    StructType()
    .add("message_key", "string")
    .add("slice", "long")
    .add("day", "string")
    .add("first_at", "timestamp")
    .add("last_at", "timestamp")
)


def seen_table(spark: SparkSession, path: str) -> KeyedTable:
    """First and last sighting of a message per slice of time, by day."""
    return KeyedTable(spark, path, SEEN, ["message_key", "slice"], partition="day")


def unique_batches(
    seen: str, sink: Sink, repeats: Sink | None = None, keep_seconds: int = 3600, keep_days: int = 7
) -> Sink:
    """Raw messages with those sent again within ``keep_seconds`` taken out.  Off unless a job asks.

    Messages are the same when device, time and payload are, and are compared by
    the transport's publish time.  Every parsed message goes to ``sink`` or to
    ``repeats``: there is no watermark, so none is refused for its time, whatever
    its device's clock says.  Messages without a publish time are never repeats.

    Time is cut into slices of ``keep_seconds``.  Of a message and slice only the first and
    last sighting are kept, which is all that its neighbours need, so a message that is sent
    a million times is a row per slice before it is ordered.  Days more than ``keep_days``
    before the batch's newest are forgotten; what comes later than that passes as new.
    """
    span = keep_seconds * 1_000_000

    def write(df: DataFrame, batch_id: int) -> None:
        spark, run = df.sparkSession, tables.run_of(df)
        table = seen_table(spark, seen)
        if table.done(run, batch_id):
            return
        key = F.sha2(F.to_json(F.struct(*REPEAT_KEY), {"ignoreNullFields": "false"}), 256)
        at = F.unix_micros("publish_time")
        cut = F.floor(at / span).cast("long")
        rows = session.settle(
            parse.parse_messages(df).where("parsed").select(
                "message_id",
                *REPEAT_KEY,
                at.alias("at"),
                F.when(at.isNotNull(), key).alias("message_key"),
                cut.alias("slice"),
                F.monotonically_increasing_id().alias("_row"),
            ),
            "batch",
        )
        own = rows.where("at is not null").groupBy("message_key", "slice").agg(
            F.min(F.struct("at", "message_id", "_row")).alias("first"), F.max("at").alias("last")
        )
        own = session.settle(own, "sightings")
        low, high = own.agg(F.min("slice"), F.max("slice")).first()
        known = table.current(_slice_days(low, high, span, table.partitions()))
        marked = _marked(rows, own, known, span)
        out = ["message_id", *REPEAT_KEY]
        sink(marked.where("not again").select(*out), batch_id)
        if repeats is not None:
            repeats(marked.where("again").select(*out), batch_id)
        time = lambda c: F.timestamp_micros(c)
        fresh = own.select(
            "message_key",
            "slice",
            F.date_format(time(F.col("slice") * span), "yyyy-MM-dd").alias("day"),
            time(F.col("first.at")).alias("first_at"),
            time(F.col("last")).alias("last_at"),
        )
        both = fresh.unionByName(known.join(fresh.select("message_key", "slice"), ["message_key", "slice"], "left_semi"))
        table.commit(
            both.groupBy("message_key", "slice", "day").agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at")),
            run,
            batch_id,
        )
        if high is not None:
            table.expire(day_of(high * span - keep_days * 86_400_000_000))
        session.discard(rows)
        session.discard(own)

    return write


def day_of(micros: int) -> str:
    return (datetime(1970, 1, 1) + timedelta(microseconds=micros)).strftime("%Y-%m-%d")


def _slice_days(low: int | None, high: int | None, span: int, held: list[str]) -> list[str]:
    """Of the days that a table holds, those of the slices and their neighbours."""
    if low is None:
        return []
    first, last = day_of((low - 1) * span), day_of((high + 1) * span)
    return [day for day in held if first <= day <= last]


def _marked(rows: DataFrame, own: DataFrame, known: DataFrame, span: int) -> DataFrame:
    """Rows with ``again``: not the first of their slice, or near a sighting beside it."""
    order = Window.partitionBy("message_key").orderBy("slice")
    own = own.withColumn("before", F.lag("last").over(order))
    # Of earlier batches the same slice and both beside it matter.
    near = own.select("message_key", "slice", F.explode(F.array(*[F.col("slice") + d for d in (-1, 0, 1)])).alias("_s"))
    sighted = known.select(
        F.col("message_key").alias("_k"),
        F.col("slice").alias("_s2"),
        F.unix_micros("first_at").alias("_first"),
        F.unix_micros("last_at").alias("_last"),
    )
    around = (
        near.join(sighted, (F.col("message_key") == F.col("_k")) & (F.col("_s") == F.col("_s2")))
        .groupBy("message_key", "slice")
        .agg(
            F.max(F.when(F.col("_s") == F.col("slice"), True)).alias("same"),
            F.max(F.when(F.col("_s") < F.col("slice"), F.col("_last"))).alias("left"),
            F.min(F.when(F.col("_s") > F.col("slice"), F.col("_first"))).alias("right"),
        )
    )
    facts = own.join(around, ["message_key", "slice"], "left")
    at = F.col("at")
    again = (
        (F.col("_row") != F.col("first._row"))
        | (at - F.col("before") <= span)
        | F.col("same")
        | (at - F.col("left") <= span)
        | (F.col("right") - at <= span)
    )
    return rows.join(facts, ["message_key", "slice"], "left").withColumn("again", F.coalesce(again, F.lit(False)))


DEMAND = (
    StructType()
    .add("device_eui", "string")
    .add("location_id", "string")
    .add("measured_at", "timestamp")
    .add("demand_kw", "double")
)


def demand_table(spark: SparkSession, path: str) -> KeyedTable:
    """The latest demand of each device."""
    return KeyedTable(spark, path, DEMAND, ["device_eui"], ["measured_at"])


def demand_batches(table: KeyedTable) -> Sink:
    """Keep ``table`` at the latest demand: a batch adds a row per device that it has."""

    def write(readings: DataFrame, batch_id: int) -> None:
        table.commit(usage.current_demand(readings), tables.run_of(readings), batch_id)

    return write


def with_clock(
    readings: DataFrame,
    late_by: str = "1 hour",
    ahead_by: str = "5 minutes",
    disorder: str = "5 minutes",
) -> DataFrame:
    """Add ``clock``: whether a reading's own time fits the transport's.

    ``ahead`` is over ``ahead_by`` after its publish time, ``late`` so long before
    it that a watermark ``late_by`` behind might refuse it, given that clocks run
    ahead and that the transport delivers up to ``disorder`` out of order; ``none``
    has no time.  All others are ``in_time``.  A row's clock depends on the row only.
    """
    sent, at = F.col("upstream_ingestion_timestamp"), F.col("original_mqtt_time")
    oldest = sent - F.expr(f"interval {late_by}") + F.expr(f"interval {ahead_by}") + F.expr(f"interval {disorder}")
    return readings.withColumn(
        "clock",
        F.when(at.isNull() | sent.isNull(), "none")
        .when(at > sent + F.expr(f"interval {ahead_by}"), "ahead")
        .when(at < oldest, "late")
        .otherwise("in_time"),
    )


def out_of_time(readings: DataFrame, **clock: str) -> DataFrame:
    """The readings that ``peak_alerts`` leaves out, for a table of their own."""
    return with_clock(readings, **clock).where("clock <> 'in_time'")


def peak_alerts(
    readings: DataFrame, thresholds: DataFrame, late_by: str = "1 hour", share: float = 0.8, **clock: str
) -> DataFrame:
    """Alerts of closed intervals, each sent once (append mode).

    An interval is judged when the watermark has passed its end; the last intervals
    stay open until a later message closes them.  Readings whose time does not fit
    their publish time would move the watermark or be refused by it; they are not
    counted here but found by ``out_of_time``.  The transport may also deliver a reading
    after the watermark has passed it, out of order by more than ``disorder``; Spark drops
    such rows.  Where that can happen use ``reconcile.reconciled_alerts``, which refuses none.
    """
    in_time = with_clock(readings, late_by, **clock).where("clock = 'in_time'").drop("clock")
    in_time = in_time.withWatermark("original_mqtt_time", late_by)
    return usage.peak_alerts(usage.intervals(in_time, ["location_id"]), thresholds, share)
