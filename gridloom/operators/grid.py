"""The expected intervals of every device: gaps to the end, and filling by time.

Nothing is expanded to rows per interval: a stretch of equal intervals is one run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridloom.operators.usage import PLACE, energy_rows, intervals

MICRO = 1_000_000


def _cut(micros: Column, width: int) -> Column:
    return F.floor(micros / width).cast("long") * width


def gaps_until(readings: DataFrame, until: Column, devices: DataFrame | None = None, minutes: int = 15) -> DataFrame:
    """Stretches without a reading from a device's first interval to ``until``.

    Devices that fell silent have a last gap with ``open`` set.  ``devices``
    (``device_eui``, ``since``) adds those that never reported, from ``since`` on.
    """
    width = minutes * 60 * MICRO
    end = _cut(F.unix_micros(until), width)
    seen = intervals(readings, ["device_eui"], minutes).select("device_eui", F.unix_micros("interval_start").alias("at"))
    if devices is not None:
        # An interval before the first one stands for the promise to report.
        promised = devices.select("device_eui", (_cut(F.unix_micros("since"), width) - width).alias("at"))
        first = seen.groupBy("device_eui").agg(F.lit(True).alias("_reported"))
        seen = seen.unionByName(promised.join(first, "device_eui", "left_anti"))
    following = F.lead("at").over(Window.partitionBy("device_eui").orderBy("at"))
    return (
        seen.where(F.col("at") < end)
        .select("device_eui", (F.col("at") + width).alias("from"), F.coalesce(following, end).alias("to"), following.isNull().alias("open"))
        .where(F.col("to") > F.col("from"))
        .select(
            "device_eui",
            F.timestamp_micros("from").alias("gap_start"),
            F.timestamp_micros("to").alias("gap_end"),
            F.call_function("div", F.col("to") - F.col("from"), F.lit(width)).alias("missing_intervals"),
            "open",
        )
    )


def shared_by_time(readings: DataFrame, kind: str = "interval_kwh", minutes: int = 15) -> DataFrame:
    """Energy per interval when each reading's is shared over the time since the one before.

    A reading covers the time from the device's previous reading up to itself.  The share of
    an interval is in proportion to the covered time in it.  Rows are runs:
    ``n_intervals`` intervals from ``run_start`` on with ``kwh_each``; at most three per reading,
    the interval that it began in, those between, the one that it ended in.  ``filled`` marks runs
    in which the device has no reading: their energy is drawn as a straight line.  A device's
    first reading lies in its own interval.
    """
    width = minutes * 60 * MICRO
    rows = energy_rows(readings, kind).where("kwh is not null")
    # Readings of one instant are one.
    rows = rows.groupBy("device_eui", F.unix_micros("at").alias("at")).agg(F.sum("kwh").alias("kwh"))
    order = Window.partitionBy("device_eui").orderBy("at")
    step = rows.withColumn("before", F.lag("at").over(order))
    step = step.withColumns({"a": _cut(F.col("before"), width), "b": _cut(F.col("at"), width)})
    c = F.col
    rate = lambda micros: c("kwh") * (micros.cast("double") / (c("at") - c("before")).cast("double"))
    run = lambda start, n, kwh, filled: F.struct(
        start.alias("start"), n.cast("long").alias("n"), kwh.cast("double").alias("kwh"), F.lit(filled).alias("filled")
    )
    between = F.call_function("div", c("b") - c("a"), F.lit(width)) - 1
    head = rate(c("a") + width - c("before"))
    middle = rate(F.lit(width))
    tail = rate(c("at") - c("b"))
    parts = F.when(
        c("before").isNull() | (c("a") == c("b")), F.array(run(c("b"), F.lit(1), c("kwh"), False))
    ).otherwise(
        F.array(
            run(c("a"), F.lit(1), head, False), run(c("a") + width, between, middle, True), run(c("b"), F.lit(1), tail, False)
        )
    )
    runs = step.select("device_eui", F.inline(parts)).where("n > 0")
    # Several readings may end or begin in one interval.
    return (
        runs.groupBy("device_eui", "start", "n", "filled")
        .agg(F.sum("kwh").alias("kwh_each"))
        .select("device_eui", F.timestamp_micros("start").alias("run_start"), F.col("n").alias("n_intervals"), "kwh_each", "filled")
    )
