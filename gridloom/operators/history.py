"""A star for BI tools whose device dimension keeps its history.

Snapshots of the registry are compared; what a device was between two changes is one row of
the dimension with the time it was in force and a key that later snapshots do not
change.  Facts take the key that is in force at their own time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from gridloom.functions.binary import is_finite
from gridloom.operators.joins import lookup_join
from gridloom.operators.ordering import spread_write
from gridloom.operators.usage import calendar_columns, demand_kw, energy_rows

DESCRIBES = ("client_id", "location_id", "device_category")


def device_dimension(snapshots: DataFrame, values: Sequence[str] = DESCRIBES) -> DataFrame:
    """Validity intervals out of snapshots (``taken_at``, ``device_eui`` and the values).

    An interval begins with the snapshot that first shows the values and ends with the
    first one that shows others or lacks the device; the newest has no end.  A device that
    comes back gets a new interval.  Of several rows of a device in a snapshot the greatest counts.
    """
    values = list(values)
    row = F.max(F.struct(*values)).alias("_v")
    rows = snapshots.groupBy("device_eui", "taken_at").agg(row)
    # One row per snapshot, ordered once.
    times = snapshots.select("taken_at").distinct()
    times = times.withColumn("_next", F.lead("taken_at").over(Window.orderBy("taken_at")))
    rows = lookup_join(rows, times, ["taken_at"], ["device_eui"])
    order = Window.partitionBy("device_eui").orderBy("taken_at")
    goes_on = F.lag("_v").over(order).eqNullSafe(F.col("_v")) & (F.lag("_next").over(order) == F.col("taken_at"))
    begins = F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    runs = rows.withColumn("_run", F.sum(begins).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = runs.groupBy("device_eui", "_run").agg(
        F.first("_v").alias("_v"),
        F.min("taken_at").alias("valid_from"),
        F.max(F.coalesce("_next", F.lit("9999-12-31").cast("timestamp"))).alias("_end"),
    )
    return found.select(
        device_key(F.col("device_eui"), F.col("valid_from")).alias("device_key"),
        "device_eui",
        *[F.col("_v")[v].alias(v) for v in values],
        "valid_from",
        F.when(F.col("_end") < "9999-12-31", F.col("_end")).alias("valid_to"),
    )


def device_key(device, valid_from):
    return F.md5(F.concat_ws("|", device, F.unix_micros(valid_from).cast("string")))


def daily_facts(readings: DataFrame, devices: DataFrame, kind: str = "interval_kwh") -> DataFrame:
    """Energy, readings and greatest demand per device key and day.

    A device that changes inside a day has a row for each of its keys.  Readings from
    before a device's first interval, or of a device that was gone, have no key.
    """
    demand = F.when(is_finite(demand_kw()), demand_kw())
    rows = energy_rows(readings.withColumn("_kw", demand), kind, ["_kw"])
    keys = devices.select("device_eui", "device_key", "valid_from", "valid_to")
    in_force = (F.col("at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to")))
    return (
        lookup_join(rows, keys, ["device_eui"], ["at"], residual=in_force)
        .groupBy("device_eui", "device_key", F.to_date("at").alias("day"))
        .agg(
            F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("kwh"),
            F.count("kwh").alias("n_readings"),
            F.max("_kw").alias("max_demand_kw"),
        )
    )


def calendar(facts: DataFrame) -> DataFrame:
    """One row per day from the first to the last fact."""
    span = facts.agg(F.min("day").alias("first"), F.max("day").alias("last")).where("first is not null")
    days = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.select("day", *calendar_columns(F.col("day")))


def write_star(path: str, facts: DataFrame, devices: DataFrame, days: DataFrame) -> None:
    """The three tables; facts by month."""
    months = facts.withColumn("fact_month", F.date_format("day", "yyyy-MM"))
    spread_write(months, ["fact_month"]).write.mode("overwrite").partitionBy("fact_month").parquet(f"{path}/facts")
    devices.write.mode("overwrite").parquet(f"{path}/devices")
    days.write.mode("overwrite").parquet(f"{path}/calendar")
