"""Tariffs: time-of-use periods, overlaps, costs, peaks and load shifting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gridloom.operators.usage import intervals, own_or_shared
from gridloom.operators.joins import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, fits_broadcast, lookup_join

OPEN_END = "9999-12-31"
HOURS = 7 * 24


def hour_grid(tariffs: DataFrame) -> DataFrame:
    """One row per tariff, weekday and hour (at most 168 per tariff).

    A window whose end is not after its start runs past midnight into the next
    day; equal ends mean a whole day.
    """
    last = F.when(F.col("hour_to") > F.col("hour_from"), F.col("hour_to") - 1).otherwise(
        F.col("hour_to") + 23
    )
    cells = tariffs.withColumn("_day", F.explode("days")).withColumn(
        "_h", F.explode(F.sequence(F.col("hour_from"), last))
    )
    return cells.select(
        "tariff_id",
        "location_id",
        "zone",
        "valid_from",
        F.coalesce("valid_to", F.to_date(F.lit(OPEN_END))).alias("valid_to"),
        F.expr("cast((_day - 1 + _h div 24) % 7 + 1 as int)").alias("weekday"),
        F.expr("cast(_h % 24 as int)").alias("hour"),
        "period",
        "rate",
    ).distinct()


def tariff_overlaps(tariffs: DataFrame) -> DataFrame:
    """Tariffs that begin while an earlier one of the same hour is still in force.

    Each weekday hour of a location is swept once in order of validity against
    the furthest end so far; no pairs are formed.
    """
    earlier = (
        Window.partitionBy("location_id", "weekday", "hour")
        .orderBy("valid_from", "tariff_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = F.max("valid_to").over(earlier)
    return (
        hour_grid(tariffs)
        .withColumn("in_force_until", reach)
        .where(F.col("valid_from") < F.col("in_force_until"))
        .groupBy("tariff_id", "location_id")
        .agg(
            F.count("*").alias("overlapping_hours"),
            F.max("in_force_until").alias("in_force_until"),
        )
    )


def require_sound(tariffs: DataFrame) -> DataFrame:
    """The tariffs, or an error when two of them claim the same hour or zones differ."""
    clash = tariff_overlaps(tariffs).limit(1).collect()
    if clash:
        raise ValueError(f"tariff {clash[0]['tariff_id']} overlaps an earlier one")
    zones = (
        tariffs.groupBy("location_id")
        .agg(F.count_distinct("zone").alias("n"))
        .where("n > 1")
        .limit(1)
        .collect()
    )
    if zones:
        raise ValueError(f"location {zones[0]['location_id']} has tariffs in several zones")
    return tariffs


def match_tariffs(
    facts: DataFrame, tariffs: DataFrame, at: str, shared_zone: str = "UTC"
) -> DataFrame:
    """Add ``period``, ``rate`` and the local month of the tariff in force at ``at``.

    Rules are in local time: the instant is converted once, then joined on scope,
    weekday and hour, which leaves only the validity dates to compare.
    """
    # Both dimensions are made of the tariffs, which are counted once: 168 rows each at most.
    fits = fits_broadcast(tariffs, MAX_BROADCAST_ROWS // HOURS, MAX_BROADCAST_BYTES // HOURS)
    own_zones = (
        tariffs.where(F.col("location_id") != "*")
        .groupBy("location_id")
        .agg(F.max("zone").alias("_zone"))
    )
    facts = lookup_join(facts, own_zones, ["location_id"], [at], fits=fits).withColumns(
        {
            "_scope": F.when(F.col("_zone").isNotNull(), F.col("location_id")).otherwise("*"),
            "_local": F.from_utc_timestamp(F.col(at), F.coalesce("_zone", F.lit(shared_zone))),
        }
    )
    facts = facts.withColumns(
        {
            "weekday": F.weekday("_local") + 1,
            "hour": F.hour("_local"),
            "_date": F.to_date("_local"),
            "local_month": F.trunc("_local", "month"),
        }
    )
    grid = hour_grid(tariffs).select(
        F.col("location_id").alias("_scope"),
        "weekday",
        "hour",
        F.col("valid_from").alias("_valid_from"),
        F.col("valid_to").alias("_valid_to"),
        "period",
        "rate",
    )
    in_force = (F.col("_date") >= F.col("_valid_from")) & (F.col("_date") < F.col("_valid_to"))
    return lookup_join(facts, grid, ["_scope", "weekday", "hour"], [at], residual=in_force, fits=fits).drop(
        "_zone", "_scope", "_local", "_date", "_valid_from", "_valid_to", "weekday", "hour"
    )


def demand_peaks(readings: DataFrame, tariffs: DataFrame, minutes: int = 15) -> DataFrame:
    """The highest interval per location and tariff period, the earliest of equals."""
    places = intervals(readings, ["location_id"], minutes)
    start = F.unix_micros("interval_start")
    top = F.max(F.struct("kwh", (-start).alias("_t"), "interval_start")).alias("_top")
    return (
        match_tariffs(places, tariffs, "interval_start")
        .groupBy("location_id", "period")
        .agg(top)
        .select(
            "location_id",
            "period",
            "_top.interval_start",
            F.col("_top.kwh").alias("peak_kwh"),
            (F.col("_top.kwh") * (60 / minutes)).alias("peak_kw"),
        )
    )


def cost_report(
    readings: DataFrame, tariffs: DataFrame, charges: DataFrame, minutes: int = 15
) -> DataFrame:
    """Cost by component per location and month: energy by period, demand, fixed.

    Energy without a tariff is listed as its own component without a cost.
    """
    matched = match_tariffs(intervals(readings, ["location_id"], minutes), tariffs, "interval_start")
    by_period = matched.groupBy("location_id", "local_month", "period").agg(
        F.sum("kwh").alias("kwh"),
        F.sum(F.col("kwh") * F.col("rate")).alias("cost"),
        F.max("kwh").alias("peak"),
    )
    item = F.struct(
        F.coalesce(F.concat(F.lit("energy:"), F.col("period")), F.lit("energy:untariffed")).alias(
            "component"
        ),
        F.col("kwh").alias("quantity"),
        F.col("cost").alias("cost"),
    )
    # A month of a location has as many rows here as there are tariff periods.
    months = by_period.groupBy("location_id", "local_month").agg(
        F.collect_list(item).alias("_energy"),
        (F.max("peak") * (60 / minutes)).alias("_peak_kw"),
    )
    months = own_or_shared(months, charges, ["local_month"])
    demand = F.struct(
        F.lit("demand").alias("component"),
        F.col("_peak_kw").alias("quantity"),
        (F.col("_peak_kw") * F.col("demand_rate")).alias("cost"),
    )
    fixed = F.struct(
        F.lit("fixed").alias("component"),
        F.lit(1.0).alias("quantity"),
        F.col("fixed_rate").alias("cost"),
    )
    return months.select(
        "location_id",
        F.col("local_month").alias("month"),
        F.inline(F.concat("_energy", F.array(demand, fixed))),
    )


def load_shift(readings: DataFrame, tariffs: DataFrame, peak: str = "peak") -> DataFrame:
    """Share of peak-period energy by category, ranked within the location."""
    matched = match_tariffs(
        intervals(readings, ["location_id", "device_category"]), tariffs, "interval_start"
    )
    shares = (
        matched.groupBy("location_id", "device_category")
        .agg(
            F.coalesce(F.sum(F.when(F.col("period") == peak, F.col("kwh"))), F.lit(0.0)).alias(
                "peak_kwh"
            ),
            F.sum("kwh").alias("total_kwh"),
        )
        .withColumn(
            "peak_share",
            F.round(F.when(F.col("total_kwh") != 0, F.col("peak_kwh") / F.col("total_kwh")), 6),
        )
    )
    rank = Window.partitionBy("location_id").orderBy(F.desc("peak_share"), "device_category")
    return shares.withColumn("place", F.row_number().over(rank))
