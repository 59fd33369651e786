"""Queries that keep history: the star, the ledger, the grid, ranges, rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridloom import session
from gridloom.operators import anomalies, grid, history, ledger, ranges, rules, usage
from gridloom.plans import parameters
from gridloom.plans.meter import Meter


def star_devices(m: Meter) -> DataFrame:
    return history.device_dimension(parameters.snapshots(m.table("customer")))


def star_facts(m: Meter) -> DataFrame:
    """The star as written: facts with the client and location that were in force."""
    path = session.shared_folder(m.spark, "star")
    devices = session.settle(star_devices(m), "devices")
    facts = session.settle(history.daily_facts(m.readings, devices), "facts")
    history.write_star(path, facts, devices, history.calendar(facts))
    read = lambda name: m.spark.read.parquet(f"{path}/{name}")
    names = read("devices").select("device_key", "client_id", "location_id", "device_category")
    return (
        read("facts").drop("fact_month")
        .join(names, "device_key", "left")
        .join(read("calendar"), "day")
        .select(
            "device_eui", "device_key", "day", "kwh", "n_readings", "max_demand_kw",
            "client_id", "location_id", "device_category", "year", "month", "iso_weekday", "is_weekend",
        )
    )


def usage_as_known(m: Meter) -> DataFrame:
    entries = parameters.ledger_entries(m.table("events"))
    return ledger.usage_as_known(m.readings, entries, parameters.KNOWN_AT)


def ledger_seals(m: Meter) -> DataFrame:
    return ledger.seals(parameters.ledger_entries(m.table("events")))


def gaps_to_date(m: Meter) -> DataFrame:
    devices = m.registry.select("device_eui", F.lit("2024-01-01").cast("timestamp").alias("since"))
    return grid.gaps_until(m.readings, F.lit(parameters.AS_OF).cast("timestamp"), devices)


def usage_filled(m: Meter) -> DataFrame:
    return grid.shared_by_time(m.readings).withColumn("kwh_each", F.round("kwh_each", 9))


def range_usage(m: Meter) -> DataFrame:
    """Ranges of their own for every location, out of a written hierarchy."""
    kept = session.settle(ranges.hierarchy(m.readings), "hierarchy")
    return ranges.range_sums(kept, parameters.asked_ranges(m.table("nation")))


def conditional_reports(m: Meter) -> DataFrame:
    """Faults, anomalies and overuse for the groups that ask for them."""
    readings = session.settle(m.readings.select(*usage.PLACE, "original_mqtt_time", "reading"), "readings")
    found = anomalies.anomaly_report(usage.intervals(readings)).select(
        "kind", "device_eui", "location_id", F.col("interval_start").alias("item_time"), F.col("kwh").alias("value")
    )
    use = usage.intervals(readings, ["location_id"]).select(
        F.lit("interval").alias("kind"), "location_id", F.col("interval_start").alias("item_time"), F.col("kwh").alias("value")
    )
    faults = m.decoded.where("outcome = 'error'").select(
        F.concat(F.lit("fault:"), F.substring("detail", 1, 7)).alias("kind"),
        "device_eui",
        F.when(F.col("exit") == "enriched", F.col("location_id")).alias("location_id"),
        F.col("original_mqtt_time").alias("item_time"),
    )
    items = found.unionByName(use, allowMissingColumns=True).unionByName(faults, allowMissingColumns=True)
    path = session.shared_folder(m.spark, "reports")
    reports = rules.conditional_reports(items, rules.load(parameters.report_rules(m.spark)))
    rules.write_groups(reports, path)
    return m.spark.read.schema(reports.schema).parquet(path)


QUERIES = [
    star_devices,
    star_facts,
    usage_as_known,
    ledger_seals,
    gaps_to_date,
    usage_filled,
    range_usage,
    conditional_reports,
]
