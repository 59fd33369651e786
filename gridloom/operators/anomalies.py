"""Unusual use: off-hours, above own baseline, sudden changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

KINDS = ("offhours", "baseline", "spike", "drop")


def is_off_hours(at: Column, first_hour: int = 6, last_hour: int = 22) -> Column:
    """Nights of weekdays and whole weekends."""
    return (F.weekday(at) >= 5) | (F.hour(at) < first_hour) | (F.hour(at) >= last_hour)


def anomaly_report(
    device_intervals: DataFrame,
    kinds: Sequence[str] = KINDS,
    off_hours_k: float = 1.0,
    baseline_rows: int = 8,
    baseline_factor: float = 1.5,
    change_ratio: float = 2.0,
    zone: str = "UTC",
) -> DataFrame:
    """Place, time and nature of every anomaly, with the value that was passed.

    All checks share one arrangement by device.  They run on intervals, of which
    a device has at most 96 a day, not on its readings.
    """
    unknown = set(kinds) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown anomaly kinds {sorted(unknown)}")
    device = Window.partitionBy("device_eui")
    ordered = device.orderBy("interval_start", "location_id")
    kwh = F.col("kwh")
    off = is_off_hours(F.from_utc_timestamp("interval_start", zone))
    df, found = device_intervals, []

    def finding(kind: str, limit: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), kwh.alias("kwh"), limit.alias("compared_with"))

    if "offhours" in kinds:
        quiet = F.when(off, kwh)
        limit = F.round(
            F.avg(quiet).over(device) + F.stddev_samp(quiet).over(device) * off_hours_k, 6
        )
        df = df.withColumn("_off_limit", limit)
        found.append(
            F.when(off & (kwh > F.col("_off_limit")), finding("offhours", F.col("_off_limit")))
        )
    if "baseline" in kinds:
        trailing = ordered.rowsBetween(-baseline_rows, -1)
        df = df.withColumns(
            {"_base": F.avg("kwh").over(trailing), "_base_n": F.count("kwh").over(trailing)}
        )
        above = (F.col("_base_n") == baseline_rows) & (kwh > F.col("_base") * baseline_factor)
        found.append(F.when(above, finding("baseline", F.col("_base"))))
    if "spike" in kinds or "drop" in kinds:
        df = df.withColumn("_before", F.lag("kwh").over(ordered))
        before = F.col("_before")
        if "spike" in kinds:
            up = (before > 0) & (kwh >= before * change_ratio)
            found.append(F.when(up, finding("spike", before)))
        if "drop" in kinds:
            down = (before > 0) & (kwh * change_ratio <= before)
            found.append(F.when(down, finding("drop", before)))
    return df.select(
        "device_eui", "location_id", "interval_start", F.inline(F.array_compact(F.array(*found)))
    )
