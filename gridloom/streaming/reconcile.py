"""Peak alerts that late readings correct, whatever order the transport keeps.

No watermark refuses a reading here.  Every batch adds its sums per location and
interval to a keyed table.  An interval is judged when the clock, the newest reading
that was in time less ``late_by``, has passed its end; readings that come for a judged interval
change its sum, it is judged again, and what was sent is corrected: the alert as it was sent
with sign -1, the alert as it now stands with sign +1.  Added up, all rows sent are what the
batch operator finds in all readings so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gridloom import session
from gridloom.operators import usage
from gridloom.sinks import tables
from gridloom.sinks.keyed import KeyedTable
from gridloom.sinks.tables import Sink
from gridloom.streaming.jobs import day_of, with_clock

READING_COLUMNS = "device_eui string, location_id string, device_category string, original_mqtt_time timestamp, reading double"
SENT = ["sent_kwh", "sent_threshold_kwh", "sent_level"]
SUMS = (
    StructType()
    .add("location_id", "string")
    .add("interval_start", "timestamp")
    .add("day", "string")
    .add("kwh", "double")
    .add("sent_kwh", "double")
    .add("sent_threshold_kwh", "double")
    .add("sent_level", "string")
    .add("judged", "boolean")
)
CORRECTION = (
    StructType()
    .add("location_id", "string")
    .add("interval_start", "timestamp")
    .add("kwh", "double")
    .add("threshold_kwh", "double")
    .add("level", "string")
    .add("sign", "integer")
)


class AlertBook:
    """What is known and what was sent: sums by day, and the clock as a note of theirs."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.sums = KeyedTable(spark, path, SUMS, ["location_id", "interval_start"], partition="day")

    def closed_to(self) -> int | None:
        """Intervals that end up to here (microseconds since 1970) are judged."""
        return self.sums.note("closed_to")


def reconciled_alerts(
    book: AlertBook,
    sink: Sink,
    thresholds: DataFrame,
    late_by: str = "1 hour",
    share: float = 0.8,
    minutes: int = 15,
    **clock: str,
) -> Sink:
    """Write each batch's alerts and corrections (``CORRECTION``) to ``sink``.

    ``sink`` has to replace a repeated batch; the book is committed after it, so a batch
    that failed in between is reckoned again from the same book.
    """

    def write(readings: DataFrame, batch_id: int) -> None:
        run = tables.run_of(readings)
        if book.sums.done(run, batch_id):
            return
        batch = _sums(with_clock(readings, late_by, **clock), minutes)
        _step(book, sink, batch, thresholds, share, minutes, late_by, None, run, batch_id)

    return write


def close_intervals(
    book: AlertBook, sink: Sink, thresholds: DataFrame, closed_to: int, run: str, batch_id: int, share: float = 0.8, minutes: int = 15
) -> None:
    """Judge what ends up to ``closed_to`` without waiting for a reading to pass it."""
    if book.sums.done(run, batch_id):
        return
    nothing = book.spark.createDataFrame([], f"{READING_COLUMNS}, clock string")
    _step(book, sink, _sums(nothing, minutes), thresholds, share, minutes, "0 seconds", closed_to, run, batch_id)


def _sums(clocked: DataFrame, minutes: int) -> DataFrame:
    """The batch per location and interval, with its newest reading that was in time."""
    timed = clocked.where("original_mqtt_time is not null")
    energy = usage.energy_rows(timed, extra=["clock"])
    newest = F.max(F.when(F.col("clock") == "in_time", F.unix_micros("at"))).alias("newest")
    return energy.groupBy("location_id", F.window("at", f"{minutes} minutes").alias("w")).agg(
        F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("kwh"), newest
    ).select("location_id", F.col("w.start").alias("interval_start"), "kwh", "newest")


def _step(
    book: AlertBook,
    sink: Sink,
    sums: DataFrame,
    thresholds: DataFrame,
    share: float,
    minutes: int,
    late_by: str,
    closed_to: int | None,
    run: str,
    batch_id: int,
) -> None:
    """Judge the intervals that the batch touches or closes, send what changed, keep the sums."""
    batch = session.settle(sums.withColumn("day", F.date_format("interval_start", "yyyy-MM-dd")), "sums")
    # Days are few: those of the batch's intervals, and those that the clock passes.
    seen = batch.agg(
        F.max("newest").alias("newest"),
        F.collect_set("day").alias("days"),
        F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {late_by}")).alias("late"),
    ).first()
    before = book.closed_to()
    reached = seen["newest"] - seen["late"] if seen["newest"] is not None else None
    closed_to = max((x for x in (before, reached, closed_to) if x is not None), default=None)
    days = set(seen["days"])
    if closed_to is not None:
        first = "" if before is None else day_of(before - minutes * 60_000_000)
        days |= {p for p in book.sums.partitions() if first <= p <= day_of(closed_to)}
    fresh = batch.select(
        "location_id",
        "interval_start",
        "day",
        "kwh",
        *[F.lit(None).cast(SUMS[c].dataType).alias(c) for c in SENT],
        F.lit(False).alias("judged"),
        F.lit(True).alias("touched"),
    )
    known = book.sums.current(sorted(days)).withColumn("touched", F.lit(False))
    whole = (
        known.unionByName(fresh)
        .groupBy("location_id", "interval_start", "day")
        .agg(
            F.sum("kwh").alias("kwh"),
            *[F.max(c).alias(c) for c in [*SENT, "judged", "touched"]],
        )
    )
    end = F.unix_micros("interval_start") + minutes * 60_000_000
    closed = end <= F.lit(closed_to).cast("long") if closed_to is not None else F.lit(False)
    due = whole.withColumn("closed", closed).where("touched or (closed and not judged)")
    judged = session.settle(usage.judge(due, thresholds, share), "judged")
    _send(book, sink, judged, run, batch_id, closed_to)
    session.discard(judged)
    session.discard(batch)


def _send(book: AlertBook, sink: Sink, judged: DataFrame, run: str, batch_id: int, closed_to: int | None) -> None:
    now = F.struct("kwh", "threshold_kwh", "level", F.lit(1).alias("sign"))
    sent = F.struct(
        F.col("sent_kwh").alias("kwh"), F.col("sent_threshold_kwh").alias("threshold_kwh"), F.col("sent_level").alias("level"), F.lit(-1).alias("sign")
    )
    is_new = F.col("level").isNotNull()
    same = F.col("level").eqNullSafe(F.col("sent_level")) & (
        ~is_new | (F.col("kwh").eqNullSafe(F.col("sent_kwh")) & F.col("threshold_kwh").eqNullSafe(F.col("sent_threshold_kwh")))
    )
    signed = F.filter(F.array(F.when(F.col("sent_level").isNotNull(), sent), F.when(is_new, now)), lambda x: x.isNotNull())
    out = judged.where(F.col("closed") & ~same).select("location_id", "interval_start", F.inline(signed))
    sink(out.select(*CORRECTION.names), batch_id)
    stands = {
        "sent_kwh": F.when(is_new, F.col("kwh")),
        "sent_threshold_kwh": F.when(is_new, F.col("threshold_kwh")),
        "sent_level": F.col("level"),
    }
    kept = {c: F.when(F.col("closed"), stands[c]).otherwise(F.col(c)) for c in SENT}
    rows = judged.withColumns(kept).withColumn("judged", F.col("closed"))
    notes = {} if closed_to is None else {"closed_to": closed_to}
    book.sums.commit(rows.select(*SUMS.names), run, batch_id, **notes)


def in_force(corrections: DataFrame) -> DataFrame:
    """The alerts that stand after all corrections."""
    names = [c for c in CORRECTION.names if c != "sign"]
    return corrections.groupBy(*names).agg(F.sum("sign").alias("_n")).where("_n > 0").select(*names)
