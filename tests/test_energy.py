"""Energy operators on small hand-made inputs and against brute force."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom.operators import anomalies, emissions, joins, reports, tariffs, usage
from gridloom.schemas import METER_READING, TARIFF

T0 = datetime(2024, 3, 4, 0, 0, 0)  # a Monday


def readings(spark, *rows):
    """Rows of device, minutes after T0 (None for no time), reading and optional location."""
    made = []
    for device, minute, value, *place in rows:
        at = None if minute is None else T0 + timedelta(minutes=minute)
        made.append(
            ("U", value, 2.0, 3.0, 250.0, 240.0, device, "C", (place or ["L1"])[0], "HVAC", at, T0, T0, "XDevice")
        )
    return spark.createDataFrame(made, METER_READING)


def test_intervals_count_what_they_leave_out(spark):
    df = readings(
        spark, ("A", 1, 1.0), ("A", 14, 2.0), ("A", 15, 4.0), ("A", 16, float("nan")),
        ("A", 17, float("inf")), ("A", None, 9.0), ("B", 0, 8.0),
    )
    got = {(r.device_eui, r.interval_start): tuple(r)[-3:] for r in usage.intervals(df).collect()}
    assert got == {
        ("A", T0): (3.0, 2, 0),
        ("A", T0 + timedelta(minutes=15)): (4.0, 1, 2),
        ("B", T0): (8.0, 1, 0),
    }
    assert usage.intervals(df, minutes=1).count() == 6
    for wrong in (0, 16):
        with pytest.raises(ValueError):
            usage.intervals(df, minutes=wrong)
    with pytest.raises(ValueError):
        usage.energy_rows(df, "guess")


def test_running_meter_with_restart_and_ties(spark):
    values = [(0, 10.0), (50, 12.0), (61, 15.0), (200, 3.0), (200, 2.0), (260, float("nan")), (400, 7.0)]
    df = readings(spark, *[("A", m, v) for m, v in values], ("B", 5, 1.0), ("B", 500, 1.5))
    got = sorted(
        (r.device_eui, (r.at - T0).seconds // 60, r.kwh, r.excluded)
        for r in usage.energy_rows(df, "cumulative_kwh").collect()
    )
    assert got[:6] == [
        ("A", 0, 0.0, False), ("A", 50, 2.0, False), ("A", 61, 3.0, False),
        ("A", 200, 3.0, False), ("A", 260, None, True), ("A", 400, 4.0, False),
    ]
    assert got[6:] == [("B", 5, 0.0, False), ("B", 500, 0.5, False)]


def test_gaps(spark):
    df = readings(spark, ("A", 0, 1.0), ("A", 20, 1.0), ("A", 61, 1.0))
    (gap,) = usage.reading_gaps(df).collect()
    assert gap.gap_start == T0 + timedelta(minutes=30)
    assert gap.gap_end == T0 + timedelta(minutes=60) and gap.missing_intervals == 2


def test_latest_demand_and_energy_to_date(spark):
    df = readings(spark, ("A", 0, 1.0), ("A", 50, 2.0), ("A", 130, 4.0), ("A", None, 99.0))
    (row,) = usage.current_demand(df).collect()
    assert row.measured_at == T0 + timedelta(minutes=130) and row.demand_kw == 0.48
    as_of = F.lit(str(T0 + timedelta(minutes=131))).cast("timestamp")
    (row,) = usage.energy_to_date(df, as_of).collect()
    assert tuple(row) == ("L1", 4.0, 7.0, 7.0, 7.0)


def test_adjustments_stay_visible(spark):
    df = readings(spark, ("A", 0, 5.0))
    adj = spark.createDataFrame(
        [("A", T0, -1.0, "test"), ("A", T0, -2.0, "swap"), ("Z", T0, 3.0, "estimate")],
        "device_eui string, original_mqtt_time timestamp, adjustment_kwh double, justification string",
    )
    got = {r.device_eui: r for r in usage.adjusted_usage(df, adj).collect()}
    assert (got["A"].metered_kwh, got["A"].adjustment_kwh, got["A"].net_kwh) == (5.0, -3.0, 2.0)
    assert got["A"].justifications == "swap; test" and got["A"].n_adjustments == 2
    assert (got["Z"].metered_kwh, got["Z"].net_kwh) == (0.0, 3.0)


def tariff(spark, *rows):
    """Rows of id, location, zone, days, from, to, period, rate, optional validity."""
    full = [
        (i, loc, zone, *(valid or [(date(2024, 1, 1), None)])[0], days, h0, h1, period, rate)
        for i, loc, zone, days, h0, h1, period, rate, *valid in rows
    ]
    return spark.createDataFrame(full, TARIFF)


def test_overnight_windows_zones_and_own_tariffs(spark):
    table = tariff(
        spark,
        ("night", "*", "UTC", [1], 22, 6, "night", 0.1),
        ("day", "*", "UTC", [1], 6, 22, "day", 0.2),
        ("own", "L2", "America/New_York", [7], 0, 24, "sunday", 0.3),
    )
    facts = spark.createDataFrame(
        [
            ("L1", datetime(2024, 3, 4, 5)),    # Monday before the window starts
            ("L1", datetime(2024, 3, 4, 12)),
            ("L1", datetime(2024, 3, 4, 23)),
            ("L1", datetime(2024, 3, 5, 5)),    # the window's tail
            ("L2", datetime(2024, 3, 4, 4)),    # still Sunday in New York
            ("L2", datetime(2024, 3, 4, 6)),    # own tariffs only: no fallback
        ],
        "location_id string, at timestamp",
    )
    got = [r.period for r in tariffs.match_tariffs(facts, table, "at").orderBy("location_id", "at").collect()]
    assert got == [None, "day", "night", "night", "sunday", None]


def test_validity_chooses_between_tariffs(spark):
    a, b = (date(2024, 1, 1), date(2024, 3, 4)), (date(2024, 3, 4), None)
    table = tariff(
        spark,
        ("old", "*", "UTC", [1, 7], 0, 24, "x", 0.1, a),
        ("new", "*", "UTC", [1, 7], 0, 24, "x", 0.2, b),
    )
    assert tariffs.require_sound(table) is table
    facts = spark.createDataFrame(
        [("L", datetime(2024, 3, 3, 23, 59)), ("L", datetime(2024, 3, 4))], "location_id string, at timestamp"
    )
    got = [r.rate for r in tariffs.match_tariffs(facts, table, "at").orderBy("at").collect()]
    assert got == [0.1, 0.2]


def test_overlaps_are_refused(spark):
    table = tariff(
        spark,
        ("a", "L", "UTC", [1], 22, 6, "x", 0.1),
        ("b", "L", "UTC", [2], 5, 7, "x", 0.1),
        ("c", "M", "UTC", [2], 5, 7, "x", 0.1),
    )
    (row,) = tariffs.tariff_overlaps(table).collect()
    assert (row.tariff_id, row.overlapping_hours) == ("b", 1)
    with pytest.raises(ValueError, match="overlaps"):
        tariffs.require_sound(table)
    zones = tariff(
        spark, ("a", "L", "UTC", [1], 0, 5, "x", 0.1), ("b", "L", "CET", [2], 0, 5, "x", 0.1)
    )
    with pytest.raises(ValueError, match="zones"):
        tariffs.require_sound(zones)


def test_cost_components(spark):
    df = readings(spark, ("A", 0, 2.0), ("A", 8 * 60, 4.0), ("B", 8 * 60, 4.0))
    table = tariff(
        spark, ("n", "*", "UTC", [1], 0, 6, "night", 0.5), ("d", "*", "UTC", [1], 6, 24, "day", 0.25)
    )
    charges = spark.sql("select '*' location_id, 8.0D demand_rate, 16.0D fixed_rate")
    got = {r.component: (r.quantity, r.cost) for r in tariffs.cost_report(df, table, charges).collect()}
    assert got == {
        "energy:night": (2.0, 1.0), "energy:day": (8.0, 2.0), "demand": (32.0, 256.0), "fixed": (1.0, 16.0),
    }


@pytest.mark.parametrize("max_rows", [500_000, 0])
def test_asof_join_equals_brute_force(spark, max_rows, monkeypatch):
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", max_rows)
    facts = spark.range(400).selectExpr(
        "cast(id % 3 as string) region", "timestamp_seconds(1700000000 + xxhash64(id) % 1000000) at", "id"
    )
    dim = spark.range(60).selectExpr(
        "cast(id % 2 as string) region",
        "timestamp_seconds(1700000000 + xxhash64(id, 7) % 900000) valid_from",
        "cast(id as double) factor",
    )
    got = joins.asof_join(facts, dim, ["region"], "at", "valid_from", ["factor"], ["id"])
    rows = dim.collect()
    for r in got.collect():
        before = [(d.valid_from, d.factor) for d in rows if d.region == r.region and d.valid_from <= r.at]
        assert r.factor == (max(before)[1] if before else None)
    assert got.count() == 400


def test_anomaly_kinds(spark):
    # Wednesday noon, so that only the last value is at night.
    base = 2 * 24 * 60 + 12 * 60
    steady = [("A", base + 15 * i, 10.0) for i in range(8)]
    df = readings(spark, *steady, ("A", base + 120, 16.0), ("A", base + 135, 40.0), ("A", base + 150, 12.0))
    got = sorted((r.kind, r.kwh, r.compared_with) for r in anomalies.anomaly_report(usage.intervals(df)).collect())
    assert got == [("baseline", 16.0, 10.0), ("baseline", 40.0, 10.75), ("drop", 12.0, 40.0), ("spike", 40.0, 16.0)]
    with pytest.raises(ValueError):
        anomalies.anomaly_report(usage.intervals(df), ["ghost"])


def test_off_hours(spark):
    nights = [("A", 15 * i, 10.0 + i % 2) for i in range(20)]
    df = readings(spark, *nights, ("A", 330, 30.0), ("A", 12 * 60, 90.0))
    (row,) = anomalies.anomaly_report(usage.intervals(df), ["offhours"]).collect()
    assert row.kwh == 30.0


def test_energy_before_the_first_factor_is_shown(spark):
    df = readings(spark, ("A", 0, 2.0), ("A", 60, 4.0))
    regions = spark.sql("select 'L1' location_id, 'R' region")
    factors = spark.sql("select 'R' region, timestamp'2024-03-04 00:30:00' valid_from, 0.25D factor")
    (row,) = emissions.co2e(emissions.daily_emissions(df, regions, factors)).collect()
    assert (row.kwh, row.co2e_kg, row.unfactored_kwh) == (6.0, 1.0, 2.0)


def test_groups_get_what_they_subscribed_to(spark):
    items = spark.sql(
        "select r report, l location_id, timestamp'2024-01-01' item_time, 'k' kind, 1.0D value from values"
        " ('usage','L1'),('usage','L2'),('cost','L1') t(r, l)"
    )
    alerts = spark.sql("select 'L2' location_id")
    subs = spark.sql("select * from values ('x','usage','peak_alert'),('y','cost','always') t(report_group, report, condition)")
    got = sorted((r.report_group, r.location_id) for r in reports.group_reports(items, alerts, subs).collect())
    assert got == [("x", "L2"), ("y", "L1")]


def test_an_unknown_condition_fails(spark):
    items = spark.sql("select 'usage' report, 'L1' location_id, timestamp'2024-01-01' item_time, 'k' kind, 1.0D value")
    subs = spark.sql("select 'x' report_group, 'usage' report, 'anomaly' condition")
    with pytest.raises(Exception, match="unknown condition anomaly"):
        reports.group_reports(items, spark.sql("select 'L2' location_id"), subs).collect()
