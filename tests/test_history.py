"""Star, ledger, grid, ranges and rules on cases with known results."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom.operators import grid, history, joins, ledger, ranges, rules, usage
from gridloom.schemas import METER_READING
from gridloom.sinks import tables
from gridloom.streaming import jobs

DAY = datetime(2024, 1, 1)


def readings(spark, rows):
    """Rows of (device, location, time, value, client)."""
    out = []
    for device, place, at, value, *client in rows:
        given = {"device_eui": device, "location_id": place, "device_category": "c", "client_id": client[0] if client else "k",
                 "original_mqtt_time": at, "reading": value, "average_current": 10.0, "average_voltage": 100.0}
        out.append(tuple(given.get(f.name) for f in METER_READING.fields))
    return spark.createDataFrame(out, METER_READING)


# --- episodes and factors


def test_a_load_around_the_limit_is_one_episode(spark):
    loads = {"L": [10, 40, 55, 45, 70, 70, 30, 60, 10, 40, 45, 10], "M": [55] * 3}
    rows = [("A", place, DAY + timedelta(minutes=15 * n), float(v)) for place, vs in loads.items() for n, v in enumerate(vs)]
    rows.append(("A", "M", DAY + timedelta(minutes=15 * 4), 55.0))  # after a silent interval
    limits = spark.sql("select '*' location_id, 64.0D threshold_kwh")
    got = sorted(tuple(r) for r in usage.alert_episodes(readings(spark, rows), limits).collect())
    at = lambda n: DAY + timedelta(minutes=15 * n)
    assert got == [
        ("L", at(1), at(6), 5, 280.0, 70.0, at(4), True), ("L", at(7), at(8), 1, 60.0, 60.0, at(7), False),
        ("M", at(0), at(3), 3, 165.0, 55.0, at(0), False), ("M", at(4), at(5), 1, 55.0, 55.0, at(4), False),
    ]


@pytest.mark.parametrize("files", [1, 3, 9])
def test_streamed_episodes_equal_batch(spark, tmp_path, files):
    draw = random.Random(8)
    rows = [("A", draw.choice("LM"), DAY + timedelta(minutes=5 * n), draw.randrange(10, 50) / 1.0) for n in range(400)]
    given = readings(spark, rows)
    folder = f"{tmp_path}/in"
    parts = given.orderBy("original_mqtt_time").collect()
    for i in range(9):
        spark.createDataFrame(parts[len(parts) * i // 9 : len(parts) * (i + 1) // 9], METER_READING).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)
    limits = spark.sql("select '*' location_id, 64.0D threshold_kwh")
    stream = spark.readStream.schema(METER_READING).option("maxFilesPerTrigger", files).parquet(folder).withWatermark("original_mqtt_time", "1 hour")
    found = usage.alert_episodes(stream, limits)
    jobs.start(found, tables.batch_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint").awaitTermination()
    got = {tuple(r) for r in tables.read_batches(spark, f"{tmp_path}/out", found.schema).collect()}
    whole = {tuple(r) for r in usage.alert_episodes(given, limits).collect()}
    closed = max(r[2] for r in rows) - timedelta(hours=1, minutes=45)
    assert got <= whole and {r for r in whole if r[2] <= closed} <= got and len(got) > 5


@pytest.mark.parametrize("step", [30, 60 * 24 * 9])
def test_carried_factors_equal_brute_force(spark, step):
    draw = random.Random(step)
    start = [(r, DAY + timedelta(minutes=step * n + draw.randrange(5)), float(n)) for r in "ab" for n in range(40)]
    start.append(("a", start[0][1], -1.0))  # of two rows of one instant the greater counts
    facts = [(i, draw.choice(["a", "b", "c", None]), DAY + timedelta(minutes=draw.randrange(-2000, 50 * step))) for i in range(600)]
    facts += [(1000 + i, r, at) for i, (r, at, _) in enumerate(start)]
    dim = spark.createDataFrame(start, "region string, valid_from timestamp, factor double")
    df = spark.createDataFrame(facts, "id int, region string, at timestamp")
    got = {r.id: r.factor for r in joins.asof_carry(df, dim, ["region"], "at", "valid_from", ["factor"]).collect()}
    for i, region, at in facts:
        past = [(t, f) for r, t, f in start if r == region and t <= at]
        assert got[i] == (max(past)[1] if past else None)
    assert len(got) == len(facts)


# --- star


def snapshots(spark, *copies):
    rows = [(DAY + timedelta(hours=h), *row) for h, rows in copies for row in rows]
    return spark.createDataFrame(rows, "taken_at timestamp, device_eui string, client_id string, location_id string, device_category string")


def test_intervals_begin_end_and_come_back(spark):
    copies = [(0, [("A", "c", "l", "k"), ("B", "c", "l", "k")]), (24, [("A", "c", "m", "k")]), (48, [("A", "c", "m", "k"), ("B", "c", "l", "k")])]
    got = history.device_dimension(snapshots(spark, *copies))
    found = {(r.device_eui, r.location_id, r.valid_from, r.valid_to) for r in got.collect()}
    at = lambda h: DAY + timedelta(hours=h)
    assert found == {
        ("A", "l", at(0), at(24)), ("A", "m", at(24), None), ("B", "l", at(0), at(24)), ("B", "l", at(48), None),
    }
    # A further copy changes no key and no interval that has ended.
    more = history.device_dimension(snapshots(spark, *copies, (72, [("A", "x", "m", "k"), ("B", "c", "l", "k")])))
    keys = {r.device_key for r in got.collect()}
    assert keys < {r.device_key for r in more.collect()} and len(keys) == 4


@pytest.mark.parametrize("kind", usage.READING_KINDS)
def test_a_device_that_moves_inside_a_day(spark, kind):
    """The probed case: the client changes at noon, and no energy is counted twice."""
    devices = history.device_dimension(snapshots(spark, (0, [("A", "c", "l", "k")]), (12, [("A", "d", "m", "k")])))
    values = [100.0, 104.0, 110.0, 111.0, 123.0] if kind == "cumulative_kwh" else [0.0, 4.0, 6.0, 1.0, 12.0]
    rows = [("A", "l", DAY + timedelta(hours=h), v, "c" if h < 12 else "d") for h, v in zip((1, 6, 11, 13, 20), values)]
    rows.append(("A", "l", DAY - timedelta(hours=1), 99.0 if kind == "cumulative_kwh" else 0.5, "c"))
    given = readings(spark, rows)
    facts = history.daily_facts(given, devices, kind).join(devices.select("device_key", "client_id"), "device_key", "left")
    got = {(r.client_id, r.day.day, r.kwh, r.n_readings) for r in facts.collect()}
    first = 11.0 if kind == "cumulative_kwh" else 10.0
    early = 0.0 if kind == "cumulative_kwh" else 0.5
    assert got == {("c", 1, first, 3), ("d", 1, 13.0, 2), (None, 31, early, 1)}
    star = {(r.client_id, r.day.day, r.kwh) for r in usage.daily_star(given, kind).collect()}
    assert star == {("c", 1, first), ("d", 1, 13.0), ("c", 31, early)}


def test_a_day_of_excluded_readings_has_a_row(spark):
    (row,) = usage.daily_star(readings(spark, [("A", "l", DAY, float("nan"))])).collect()
    assert (row.kwh, row.n_readings) == (0.0, 0)


def test_calendar_has_every_day(spark):
    facts = spark.sql("select date'2024-01-05' day union all select date'2024-01-09'")
    assert history.calendar(facts).count() == 5
    assert history.calendar(facts.limit(0)).count() == 0


# --- ledger


def entries(spark, rows):
    schema = "entry_id string, device_eui string, day date, recorded_at timestamp, kwh double, justification string, reverses string"
    return spark.createDataFrame([(i, d, DAY.date(), DAY + timedelta(days=n), k, "why", r) for i, d, n, k, r in rows], schema)


def test_any_past_report_can_be_drawn(spark):
    first = entries(spark, [("1", "A", 1, -2.0, None), ("2", "A", 2, -1.0, None), ("3", "B", 40, -8.0, None)])
    wrong = spark.createDataFrame([("1", DAY + timedelta(days=5), "typo"), ("1", DAY + timedelta(days=6), "again"), ("9", DAY, "")], "entry_id string, recorded_at timestamp, justification string")
    counter = ledger.reversals(first, wrong)
    assert [(r.entry_id, r.kwh, r.reverses, r.justification) for r in counter.collect()] == [("1-r", 2.0, "1", "typo")]
    book = first.unionByName(counter)
    assert ledger.reversals(book, wrong).count() == 0
    times = ["2024-01-01 12:00:00", "2024-01-04 00:00:00", "2024-01-06 00:00:00", "2024-03-01 00:00:00"]
    metered = readings(spark, [("A", "l", DAY, 10.0)])
    got = {(r.known_at.day, r.known_at.month, r.device_eui): (r.net_kwh, r.n_entries) for r in ledger.usage_as_known(metered, book, times).collect()}
    assert got == {(1, 1, "A"): (10.0, 0), (4, 1, "A"): (7.0, 2), (6, 1, "A"): (9.0, 3), (1, 3, "A"): (9.0, 3), (1, 3, "B"): (-8.0, 1)}


def test_seals_show_changes(spark):
    rows = [("1", "A", 1, -2.0, None), ("2", "A", 2, -1.0, None), ("3", "A", 40, 1.0, None), ("4", "A", 70, 1.0, None), ("5", "B", 1, 1.0, None)]
    kept = ledger.seals(entries(spark, rows)).cache()
    broken = lambda new: {(r.device_eui, r.month) for r in ledger.broken_seals(entries(spark, new), kept).collect()}
    assert broken(rows) == set() and broken(rows[::-1]) == set()
    assert broken([*rows, ("6", "A", 71, 1.0, None)]) == {("A", "2024-03")}
    assert broken([rows[0], ("2", "A", 2, -1.5, None), *rows[2:]]) == {("A", "2024-01")}
    assert broken([*rows[:2], *rows[3:]]) == {("A", "2024-02")}
    assert broken(rows[:4]) == {("B", "2024-01")}


# --- grid


def test_silent_devices_are_in_the_gaps(spark):
    rows = [("A", "l", DAY + timedelta(minutes=m), 1.0) for m in (0, 15, 60)] + [("B", "l", DAY + timedelta(days=9), 1.0)]
    devices = spark.createDataFrame([("A", DAY), ("C", DAY + timedelta(minutes=50)), ("D", DAY + timedelta(days=3))], "device_eui string, since timestamp")
    until = F.lit("2024-01-01 02:07:00").cast("timestamp")
    got = {(r.device_eui, r.gap_start.hour * 60 + r.gap_start.minute, r.missing_intervals, r.open) for r in grid.gaps_until(readings(spark, rows), until, devices).collect()}
    assert got == {("A", 30, 2, False), ("A", 75, 3, True), ("C", 45, 5, True)}


def test_energy_is_shared_by_time_and_kept(spark):
    rows = [("A", "l", DAY + timedelta(minutes=m, seconds=s), v) for m, s, v in ((5, 0, 3.0), (20, 0, 1.5), (80, 0, 64.0), (80, 0, 2.0), (81, 0, 0.25))]
    got = grid.shared_by_time(readings(spark, rows))
    found = {(r.run_start.hour * 60 + r.run_start.minute, r.n_intervals, r.kwh_each, r.filled) for r in got.collect()}
    # 1.5 over 15 minutes, 66 over 60 minutes.
    assert found == {(0, 1, 4.0, False), (15, 1, 0.5 + 11.0, False), (30, 3, 16.5, True), (75, 1, 5.5 + 0.25, False)}
    assert got.agg(F.sum(F.col("n_intervals") * F.col("kwh_each"))).first()[0] == 3.0 + 1.5 + 66.0 + 0.25


def test_a_long_silence_is_one_run(spark):
    rows = [("A", "l", DAY, 1.0), ("A", "l", DAY + timedelta(days=4096), 4096.0 * 96)]
    got = sorted(map(tuple, grid.shared_by_time(readings(spark, rows)).select("n_intervals", "kwh_each", "filled").collect()))
    assert got == [(1, 0.0, False), (1, 1.0 + 1.0, False), (4096 * 96 - 1, 1.0, True)]


# --- ranges


def test_random_ranges_equal_a_direct_sum(spark):
    draw = random.Random(4)
    hours = lambda: draw.randrange(0, 3 * 366 * 24)
    rows = [("A", draw.choice("lm"), DAY + timedelta(hours=hours(), minutes=draw.randrange(60)), draw.randrange(1, 99) / 8) for _ in range(3000)]
    asked = []
    for n in range(60):
        low = hours()
        asked.append((n, draw.choice("lm"), DAY + timedelta(hours=low), DAY + timedelta(hours=low + draw.choice([0, 1, 5, 30, 800, 9000, hours()]))))
    asked += [(100, "l", datetime(2024, 1, 1), datetime(2026, 1, 1)), (101, "l", datetime(2024, 3, 1), datetime(2024, 4, 1)), (102, "l", DAY, DAY - timedelta(hours=1))]
    wanted = spark.createDataFrame(asked, "n int, location_id string, range_start timestamp, range_end timestamp")
    given = readings(spark, rows)
    kept = ranges.hierarchy(given).cache()
    got = {r.n: (r.kwh, r.max_kw) for r in ranges.range_sums(kept, wanted).collect()}
    slots = {}
    for _, place, at, value in rows:
        slot = at.replace(minute=at.minute // 15 * 15)
        slots[place, slot] = slots.get((place, slot), 0.0) + value
    for n, place, low, high in asked:
        inside = [v for (p, at), v in slots.items() if p == place and low <= at < high]
        if low < high:
            assert got[n] == (sum(inside), max(inside) * 4 if inside else None)
    pieces = ranges.pieces(wanted).groupBy("n").count().collect()
    assert max(r["count"] for r in pieces) <= 2 * (23 + 30 + 11) + 3
    assert {r["n"]: r["count"] for r in pieces}[100] == 2 and {r["n"]: r["count"] for r in pieces}[101] == 1
    odd = spark.createDataFrame([(1, "l", DAY + timedelta(minutes=1), DAY + timedelta(days=1))], wanted.schema)
    with pytest.raises(Exception, match="begins and ends with an hour"):
        ranges.range_sums(kept, odd).collect()


# --- rules


def items(spark):
    rows = [("spike", "A", 3.0, True, DAY), ("interval", None, 70.0, None, DAY), ("fault:x", "B", None, False, None), ("drop", "C", 1.0, True, DAY + timedelta(days=1))]
    return spark.createDataFrame(rows, "kind string, device_eui string, value double, checked boolean, item_time timestamp")


def test_rules_are_evaluated_together(spark, tmp_path):
    given = [
        rules.Rule("over", "ops", "kind", "=", "interval"), rules.Rule("over", "ops", "value", ">=", "60"),
        rules.Rule("sudden", "ops", "kind", "in", "spike | drop"), rules.Rule("fault", "service", "kind", "starts with", "fault"),
        rules.Rule("big", "service", "value", ">", "2"), rules.Rule("seen", "audit", "checked", "=", "true"),
        rules.Rule("late", "audit", "item_time", ">=", "2024-01-02"),
    ]
    got = rules.conditional_reports(items(spark), given)
    found = {(r.report_group, r.kind, r.rules) for r in got.collect()}
    assert found == {
        ("ops", "interval", "over"), ("ops", "spike", "sudden"), ("ops", "drop", "sudden"), ("service", "fault:x", "fault"),
        ("service", "spike", "big"), ("service", "interval", "big"), ("audit", "spike", "seen"), ("audit", "drop", "late,seen"),
    }
    rules.write_groups(got, f"{tmp_path}/r")
    assert spark.read.parquet(f"{tmp_path}/r/report_group=audit").count() == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize(
    "field,compare,value,match",
    [
        ("nothing", "=", "1", "no field"), ("value", "~", "1", "none of"), ("value", ">", "much", "does not fit"),
        ("value", "starts with", "1", "does not fit"), ("checked", "=", "maybe", "does not fit"),
    ],
)
def test_malformed_rules_are_refused(spark, field, compare, value, match):
    with pytest.raises(rules.BadRule, match=match):
        rules.conditional_reports(items(spark), [rules.Rule("r", "g", field, compare, value)])


def test_too_many_rules_are_refused(spark):
    many = [rules.Rule(f"r{n}", "g", "value", ">", str(n)) for n in range(64)]
    with pytest.raises(rules.BadRule, match="64 conditions"):
        rules.conditional_reports(items(spark), many)
    assert rules.conditional_reports(items(spark), many[:63]).count() == 3
