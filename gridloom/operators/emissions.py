"""Emissions from energy use, with factors that change over time and by region."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gridloom.operators.joins import asof_carry, asof_join, fits_broadcast, lookup_join
from gridloom.operators.usage import energy_rows


def with_factors(facts: DataFrame, regions: DataFrame, factors: DataFrame, at: str = "at") -> DataFrame:
    """Add ``region`` and the factor in force at ``at``; NULL before the first factor."""
    placed = lookup_join(facts, regions, ["location_id"], [at])
    return asof_join(placed, factors, ["region"], at, "valid_from", ["factor"], [at])


def daily_emissions(readings: DataFrame, regions: DataFrame, factors: DataFrame) -> DataFrame:
    """Energy and CO2e per location, category, day and factor.

    Readings are summed by hour before they move; only in an hour inside which the
    region's factor changes do they keep their own time.  The factors then meet these sums,
    not the readings.
    """
    placed = lookup_join(energy_rows(readings), regions, ["location_id"], ["at"])
    hour = F.date_trunc("hour", F.col("at"))
    changes = (
        factors.select("region", F.date_trunc("hour", "valid_from").alias("_hour"), (F.date_trunc("hour", "valid_from") != F.col("valid_from")).alias("_inside"))
        .where("_inside").distinct()
    )
    marked = lookup_join(placed.withColumn("_hour", hour), changes, ["region", "_hour"], ["at"], fits=fits_broadcast(factors))
    sums = (
        marked.withColumn("at", F.when(F.col("_inside"), F.col("at")).otherwise(F.col("_hour")))
        .groupBy("region", "location_id", "device_category", "at")
        .agg(F.sum("kwh").alias("kwh"))
    )
    return (
        asof_carry(sums, factors, ["region"], "at", "valid_from", ["factor"])
        .groupBy("region", "location_id", "device_category", F.to_date("at").alias("day"), "factor")
        .agg(
            F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("kwh"),
            F.sum(F.col("kwh") * F.col("factor")).alias("co2e_kg"),
        )
    )


def co2e(daily: DataFrame) -> DataFrame:
    return daily.groupBy("location_id", "device_category", "day").agg(
        F.sum("kwh").alias("kwh"),
        F.sum("co2e_kg").alias("co2e_kg"),
        F.sum(F.when(F.col("factor").isNull(), F.col("kwh")).otherwise(0.0)).alias("unfactored_kwh"),
    )


def compliance_report(daily: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Totals and breakdown of a period with the factors used; ``level`` 0 is the finest."""
    in_period = daily.where(F.col("day").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    # One row per place and factor is left before the rollup multiplies them.
    finest = in_period.groupBy("location_id", "device_category", "factor").agg(
        F.sum("kwh").alias("kwh"), F.sum("co2e_kg").alias("co2e_kg")
    )
    used = F.transform(F.array_sort(F.collect_set("factor")), lambda x: x.cast("string"))
    return finest.rollup("location_id", "device_category").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("kwh").alias("kwh"),
        F.sum("co2e_kg").alias("co2e_kg"),
        F.array_join(used, ",").alias("factors_used"),
    )


def factors_used(daily: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Each place's factors as rows, with the days on which they were used and the energy.

    The rows behind a compliance report, however many factors it has; energy
    without a factor is a row without one.
    """
    in_period = daily.where(F.col("day").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    return in_period.groupBy("region", "location_id", "factor").agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.sum("kwh").alias("kwh"),
        F.sum("co2e_kg").alias("co2e_kg"),
    )


def target_progress(daily: DataFrame, targets: DataFrame) -> DataFrame:
    """Emissions so far in the month, per location and day, against the month's target.

    A place or month without a target is listed without one.
    """
    days = daily.groupBy(
        "location_id", F.trunc("day", "month").alias("month"), "day"
    ).agg(F.coalesce(F.sum("co2e_kg"), F.lit(0.0)).alias("co2e_kg"))
    so_far = (
        Window.partitionBy("location_id", "month")
        .orderBy("day")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        days.withColumn("co2e_to_date", F.sum("co2e_kg").over(so_far))
        .join(targets, ["location_id", "month"], "left")
        .withColumn("share_of_target", F.round(F.col("co2e_to_date") / F.col("target"), 6))
    )


def cost_emission_cube(daily: DataFrame) -> DataFrame:
    """Cost, emissions and their daily correlation by location and month, all subtotals.

    ``daily`` has one row per location and day with ``cost`` and ``co2e_kg``.  The
    correlation needs at least three days.
    """
    return (
        daily.withColumn("month", F.trunc("day", "month"))
        .cube("location_id", "month")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.count("*").alias("n_days"),
            F.sum("cost").alias("cost"),
            F.sum("co2e_kg").alias("co2e_kg"),
            F.round(F.when(F.count("*") >= 3, F.corr("cost", "co2e_kg")), 6).alias("correlation"),
        )
    )
