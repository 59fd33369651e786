"""Queries over meter readings: use, peaks, costs, anomalies, emissions, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridloom import session
from gridloom.operators import anomalies, emissions, reports, tariffs, usage
from gridloom.plans import parameters
from gridloom.plans.meter import Meter
from gridloom.sinks import tables

EMISSION_TARGET_KG = 2048.0
USAGE_TARGET_KWH = 8192.0


def usage_intervals(m: Meter) -> DataFrame:
    return usage.intervals(m.readings)


def reading_gaps(m: Meter) -> DataFrame:
    return usage.reading_gaps(m.readings)


def usage_rollup(m: Meter) -> DataFrame:
    return usage.usage_rollup(m.readings)


def current_demand(m: Meter) -> DataFrame:
    return usage.current_demand(m.readings)


def energy_to_date(m: Meter) -> DataFrame:
    return usage.energy_to_date(m.readings, F.lit(parameters.AS_OF).cast("timestamp"))


def energy_running(m: Meter) -> DataFrame:
    return usage.energy_running(usage.intervals(m.readings, ["device_eui"]))


def energy_cumulative(m: Meter) -> DataFrame:
    """Daily energy when the readings are taken for a running meter's."""
    steps = usage.energy_rows(_settled(m), "cumulative_kwh")
    return steps.groupBy("device_eui", F.to_date("at").alias("day")).agg(F.sum("kwh").alias("kwh"))


def usage_rollup_metered(m: Meter) -> DataFrame:
    """The same totals from running meters."""
    return usage.usage_rollup(_metered(m))


def cost_report_metered(m: Meter) -> DataFrame:
    return tariffs.cost_report(_metered(m), _tariffs(m), parameters.charges(_locations(m)))


def co2e_metered(m: Meter) -> DataFrame:
    factors = parameters.factors(m.table("region"))
    return emissions.co2e(emissions.daily_emissions(_metered(m), _locations(m), factors))


def bi_daily_metered(m: Meter) -> DataFrame:
    return usage.daily_star(m.readings, "cumulative_kwh")


def usage_trend(m: Meter) -> DataFrame:
    trend = usage.trend(usage.daily_usage(m.readings), "kwh")
    return trend.withColumn("change_ratio", F.round("change_ratio", 6))


def usage_vs_target(m: Meter) -> DataFrame:
    targets = parameters.targets(_locations(m), USAGE_TARGET_KWH)
    months = usage.monthly(usage.daily_usage(m.readings), "kwh")
    return usage.against_target(months, targets, ["location_id", "month"], "kwh")


def peak_alerts(m: Meter) -> DataFrame:
    places = usage.intervals(m.readings, ["location_id"])
    return usage.peak_alerts(places, parameters.thresholds(_locations(m)))


def alert_episodes(m: Meter) -> DataFrame:
    return usage.alert_episodes(m.readings, parameters.thresholds(_locations(m)))


def demand_peaks(m: Meter) -> DataFrame:
    return tariffs.demand_peaks(m.readings, _tariffs(m))


def tariff_match(m: Meter) -> DataFrame:
    """The period and rate of every location's intervals."""
    places = usage.intervals(m.readings, ["location_id"])
    return tariffs.match_tariffs(places, _tariffs(m), "interval_start").select(
        "location_id", "interval_start", "kwh", "period", "rate"
    )


def tariff_overlaps(m: Meter) -> DataFrame:
    return tariffs.tariff_overlaps(parameters.offered_tariffs(m.table("supplier")))


def cost_report(m: Meter) -> DataFrame:
    return tariffs.cost_report(m.readings, _tariffs(m), parameters.charges(_locations(m)))


def load_shift(m: Meter) -> DataFrame:
    return tariffs.load_shift(m.readings, _tariffs(m))


def anomaly_offhours(m: Meter) -> DataFrame:
    return anomalies.anomaly_report(usage.intervals(m.readings), ["offhours"])


def anomaly_baseline(m: Meter) -> DataFrame:
    return anomalies.anomaly_report(usage.intervals(m.readings), ["baseline"])


def anomaly_spikes(m: Meter) -> DataFrame:
    return anomalies.anomaly_report(usage.intervals(m.readings), ["spike", "drop"])


def anomaly_report(m: Meter) -> DataFrame:
    return anomalies.anomaly_report(usage.intervals(m.readings))


def co2e(m: Meter) -> DataFrame:
    return emissions.co2e(_daily_emissions(m))


def co2e_trend(m: Meter) -> DataFrame:
    trend = usage.trend(_daily_emissions(m), "co2e_kg")
    return trend.withColumn("change_ratio", F.round("change_ratio", 6))


def compliance_report(m: Meter) -> DataFrame:
    return emissions.compliance_report(_daily_emissions(m), "2024-01-01", "2024-01-31")


def factors_used(m: Meter) -> DataFrame:
    return emissions.factors_used(_daily_emissions(m), "2024-01-01", "2024-01-31")


def adjusted_usage(m: Meter) -> DataFrame:
    return usage.adjusted_usage(m.readings, parameters.adjustments(m.table("events")))


def target_progress(m: Meter) -> DataFrame:
    targets = parameters.targets(_locations(m), EMISSION_TARGET_KG)
    return emissions.target_progress(_daily_emissions(m), targets)


def cost_co2e_corr(m: Meter) -> DataFrame:
    """Cost and emissions of each reading, summed by day in one pass."""
    rows = emissions.with_factors(
        usage.energy_rows(m.readings), _locations(m), parameters.factors(m.table("region"))
    )
    daily = (
        tariffs.match_tariffs(rows, _tariffs(m), "at")
        .groupBy("location_id", F.to_date("at").alias("day"))
        .agg(
            F.sum(F.col("kwh") * F.col("rate")).alias("cost"),
            F.sum(F.col("kwh") * F.col("factor")).alias("co2e_kg"),
        )
    )
    return emissions.cost_emission_cube(daily)


def export_csv(m: Meter) -> DataFrame:
    """Write the daily use as CSV, read it back."""
    path = session.shared_folder(m.spark, "export")
    daily = usage.daily_usage(m.readings, ["location_id", "device_category"])
    tables.write_csv(daily, path, "day")
    return m.spark.read.schema(
        "location_id string, device_category string, kwh double, day date"
    ).csv(path, header=True)


def bi_daily(m: Meter) -> DataFrame:
    return usage.daily_star(m.readings)


def group_reports(m: Meter) -> DataFrame:
    """Anomalies for operations, costs for finance, daily use for management."""
    readings = _settled(m)
    place_intervals = usage.intervals(readings, ["location_id"])
    alerts = usage.peak_alerts(place_intervals, parameters.thresholds(_locations(m)))
    found = anomalies.anomaly_report(usage.intervals(readings)).select(
        F.lit("anomalies").alias("report"),
        "location_id",
        F.col("interval_start").alias("item_time"),
        F.concat_ws(":", "kind", "device_eui").alias("kind"),
        F.col("kwh").alias("value"),
    )
    costs = tariffs.cost_report(readings, _tariffs(m), parameters.charges(_locations(m))).select(
        F.lit("cost").alias("report"),
        "location_id",
        F.col("month").cast("timestamp").alias("item_time"),
        F.col("component").alias("kind"),
        F.col("cost").alias("value"),
    )
    use = usage.daily_usage(readings).select(
        F.lit("usage").alias("report"),
        "location_id",
        F.col("day").cast("timestamp").alias("item_time"),
        F.lit("kwh").alias("kind"),
        F.col("kwh").alias("value"),
    )
    items = found.unionByName(costs).unionByName(use)
    return reports.group_reports(items, alerts, parameters.subscriptions(m.spark))


def quality_report(m: Meter) -> DataFrame:
    return reports.quality_report(m.decoded)


def _settled(m: Meter) -> DataFrame:
    """The readings' energy columns as a table, for plans that read them several times."""
    narrow = m.readings.select(*usage.PLACE, "original_mqtt_time", "reading")
    return session.settle(narrow, "readings")


def _metered(m: Meter) -> DataFrame:
    """Energy of all devices when the readings are taken for running meters'."""
    return usage.energy_rows(_settled(m), "cumulative_kwh")


def _locations(m: Meter) -> DataFrame:
    return parameters.locations(m.table("nation"))


def _tariffs(m: Meter) -> DataFrame:
    return tariffs.require_sound(parameters.tariffs(m.spark))


def _daily_emissions(m: Meter) -> DataFrame:
    return emissions.daily_emissions(
        m.readings, _locations(m), parameters.factors(m.table("region"))
    )


QUERIES = [
    usage_intervals,
    reading_gaps,
    usage_rollup,
    current_demand,
    energy_to_date,
    energy_running,
    energy_cumulative,
    usage_rollup_metered,
    cost_report_metered,
    co2e_metered,
    bi_daily_metered,
    usage_trend,
    usage_vs_target,
    peak_alerts,
    alert_episodes,
    demand_peaks,
    tariff_match,
    tariff_overlaps,
    cost_report,
    load_shift,
    anomaly_offhours,
    anomaly_baseline,
    anomaly_spikes,
    anomaly_report,
    co2e,
    co2e_trend,
    compliance_report,
    factors_used,
    adjusted_usage,
    target_progress,
    cost_co2e_corr,
    export_csv,
    bi_daily,
    group_reports,
    quality_report,
]
