"""Energy use from meter readings: intervals, gaps, breakdowns, trends, targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridloom.functions.binary import is_finite
from gridloom.operators.joins import fits_broadcast, lookup_join

READING_KINDS = ("interval_kwh", "cumulative_kwh")
PLACE = ["device_eui", "location_id", "device_category"]
TREND_UNITS = ("day", "week", "month", "year")


def demand_kw() -> Column:
    """Single phase at unit power factor."""
    return F.col("average_current") * F.col("average_voltage") / 1000


def energy_rows(
    readings: DataFrame, kind: str = "interval_kwh", extra: Sequence[str] = ()
) -> DataFrame:
    """Energy per reading: device, place, ``at``, ``kwh`` and the ``extra`` columns.

    A reading that is not a finite number has NULL energy and ``excluded`` set;
    readings without a time belong to no interval and are left out.

    Every operator on energy takes readings or such rows.  The kind is chosen here:
    what is made from running meters once is passed on and stays as it is.
    """
    if kind not in READING_KINDS:
        raise ValueError(f"reading kind {kind!r} is none of {READING_KINDS}")
    if {"at", "kwh", "excluded", *extra} <= set(readings.columns):
        return readings
    rows = readings.where(F.col("original_mqtt_time").isNotNull()).select(
        *PLACE, *extra, F.col("original_mqtt_time").alias("at"), "reading"
    )
    finite = F.coalesce(is_finite(F.col("reading")), F.lit(False))
    rows = rows.withColumn("kwh", F.when(finite, F.col("reading")))
    if kind == "cumulative_kwh":
        return _metered_steps(rows, extra)
    return rows.select(*PLACE, *extra, "at", "kwh", (~finite).alias("excluded"))


def _metered_steps(rows: DataFrame, extra: Sequence[str] = (), slice_unit: str = "hour") -> DataFrame:
    """Differences of a running meter; a decrease means it restarted from zero.

    A step belongs to the place, and to the ``extra`` columns, of the reading that ends it.

    Readings of one instant are one reading (the highest).  A device is cut into
    time slices; each slice starts from the last reading of the slice before,
    which comes from one row per slice, so no task holds a whole device.
    """
    instants = (
        rows.groupBy("device_eui", "at")
        .agg(
            F.max(F.struct("kwh", "location_id", "device_category", *extra)).alias("_r"),
            F.count_if(F.col("kwh").isNull()).alias("_lost"),
        )
        .select("device_eui", "at", *[f"_r.{c}" for c in ("location_id", "device_category", *extra)], "_r.kwh", "_lost")
        .withColumn("_slice", F.date_trunc(slice_unit, "at"))
    )
    metered = F.col("kwh").isNotNull()
    # A slice without a metered reading hands on what it was given.
    earlier = (
        Window.partitionBy("device_eui")
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    slices = (
        instants.groupBy("device_eui", "_slice")
        .agg(F.max_by("kwh", F.when(metered, F.col("at"))).alias("_last"))
        .withColumn("_given", F.last("_last", ignorenulls=True).over(earlier))
        .drop("_last")
    )
    inside = Window.partitionBy("device_eui", "_slice").orderBy("at")
    before = F.coalesce(
        F.last("kwh", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)),
        F.col("_given"),
    )
    step = (
        F.when(before.isNull(), F.lit(0.0))
        .when(F.col("kwh") >= before, F.col("kwh") - before)
        .otherwise(F.col("kwh"))
    )
    return instants.join(slices, ["device_eui", "_slice"]).select(
        *PLACE, *extra, "at", F.when(metered, step).alias("kwh"), (F.col("_lost") > 0).alias("excluded")
    )


def intervals(
    readings: DataFrame,
    by: Sequence[str] = PLACE,
    minutes: int = 15,
    kind: str = "interval_kwh",
) -> DataFrame:
    """Energy per interval of 1 to 15 minutes; the sums are combined before the shuffle."""
    if not 1 <= minutes <= 15:
        raise ValueError("an interval lasts 1 to 15 minutes")
    window = F.window("at", f"{minutes} minutes")
    return (
        energy_rows(readings, kind)
        .groupBy(*by, window)
        .agg(
            F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("kwh"),
            F.count("kwh").alias("n_readings"),
            F.count_if("excluded").alias("n_excluded"),
        )
        .select(*by, F.col("window.start").alias("interval_start"), "kwh", "n_readings", "n_excluded")
    )


def reading_gaps(readings: DataFrame, minutes: int = 15) -> DataFrame:
    """Stretches without a reading between two intervals of a device."""
    seen = intervals(readings, ["device_eui"], minutes)
    step = minutes * 60
    gap = F.unix_seconds("gap_end") - F.unix_seconds("gap_start")
    return (
        seen.select(
            "device_eui",
            F.timestamp_add("MINUTE", F.lit(minutes), F.col("interval_start")).alias("gap_start"),
            F.lead("interval_start")
            .over(Window.partitionBy("device_eui").orderBy("interval_start"))
            .alias("gap_end"),
        )
        .where(F.col("gap_end") > F.col("gap_start"))
        .withColumn("missing_intervals", F.call_function("div", gap, F.lit(step)))
    )


def usage_rollup(readings: DataFrame) -> DataFrame:
    """Facility, location and category totals; ``level`` is 0 for the finest."""
    finest = (
        energy_rows(readings)
        .groupBy("location_id", "device_category")
        .agg(F.sum("kwh").alias("kwh"), F.count("kwh").alias("n_readings"))
    )
    return finest.rollup("location_id", "device_category").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("kwh").alias("kwh"),
        F.sum("n_readings").alias("n_readings"),
    )


def current_demand(readings: DataFrame) -> DataFrame:
    """The latest demand of each device."""
    latest = F.max(
        F.struct(
            "original_mqtt_time",
            "upstream_ingestion_timestamp",
            demand_kw().alias("demand_kw"),
            "location_id",
        )
    ).alias("_l")
    return (
        readings.where(F.col("original_mqtt_time").isNotNull() & is_finite(demand_kw()))
        .groupBy("device_eui")
        .agg(latest)
        .select(
            "device_eui",
            "_l.location_id",
            F.col("_l.original_mqtt_time").alias("measured_at"),
            "_l.demand_kw",
        )
    )


def energy_to_date(readings: DataFrame, as_of: Column) -> DataFrame:
    """Energy of the last hour, today, this week and this month, up to ``as_of``."""
    starts = {
        "last_hour_kwh": F.timestamp_add("HOUR", F.lit(-1), as_of),
        "today_kwh": F.date_trunc("day", as_of),
        "week_kwh": F.date_trunc("week", as_of),
        "month_kwh": F.date_trunc("month", as_of),
    }
    at = F.col("at")
    rows = energy_rows(readings).where((at < as_of) & (at >= F.least(*starts.values())))
    sums = [
        F.coalesce(F.sum(F.when(at >= start, F.col("kwh"))), F.lit(0.0)).alias(name)
        for name, start in starts.items()
    ]
    return rows.groupBy("location_id").agg(*sums)


def energy_running(device_intervals: DataFrame) -> DataFrame:
    """Running energy per device over its intervals (at most 96 a day at 15 minutes)."""
    so_far = (
        Window.partitionBy("device_eui")
        .orderBy("interval_start")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return device_intervals.select(
        "device_eui", "interval_start", "kwh", F.sum("kwh").over(so_far).alias("running_kwh")
    )


def daily_usage(readings: DataFrame, by: Sequence[str] = ("location_id",)) -> DataFrame:
    return (
        energy_rows(readings)
        .groupBy(*by, F.to_date("at").alias("day"))
        .agg(F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("kwh"))
    )


def trend(daily: DataFrame, value: str, by: Sequence[str] = ("location_id",)) -> DataFrame:
    """Sums per day, week, month and year with the change from the period before.

    All units are made from the daily sums, which are few.
    """
    by = list(by)
    unit = F.explode(F.array(*[F.lit(u) for u in TREND_UNITS]))
    start = F.lit(None).cast("date")
    for u in TREND_UNITS:
        cut = F.to_date(F.date_trunc(u, F.col("day").cast("timestamp")))
        start = F.when(F.col("unit") == u, cut).otherwise(start)
    sums = (
        daily.withColumn("unit", unit)
        .groupBy("unit", *by, start.alias("period_start"))
        .agg(F.sum(value).alias(value))
    )
    order = Window.partitionBy("unit", *by).orderBy("period_start")
    previous = F.lag(value).over(order)
    return sums.withColumn(f"previous_{value}", previous).withColumns(
        {
            "change": F.col(value) - F.col(f"previous_{value}"),
            "change_ratio": F.when(
                F.col(f"previous_{value}") != 0, F.col(value) / F.col(f"previous_{value}") - 1
            ),
        }
    )


def monthly(daily: DataFrame, value: str, by: Sequence[str] = ("location_id",)) -> DataFrame:
    month = F.to_date(F.date_trunc("month", F.col("day").cast("timestamp")))
    return daily.groupBy(*by, month.alias("month")).agg(F.sum(value).alias(value))


def against_target(actual: DataFrame, targets: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Every target with what was used, the difference and the ratio.

    Both sides have one row per key and period, so Spark may choose the join.
    """
    return (
        targets.join(actual, list(on), "left")
        .select(*on, F.coalesce(value, F.lit(0.0)).alias(value), "target")
        .withColumns(
            {
                "delta": F.col(value) - F.col("target"),
                "ratio": F.when(F.col("target") != 0, F.col(value) / F.col("target")),
            }
        )
    )


def judge(location_intervals: DataFrame, thresholds: DataFrame, share: float = 0.8) -> DataFrame:
    """Add ``threshold_kwh`` and ``level``: breach, warning from ``share`` of it on, or NULL."""
    kwh, limit = F.col("kwh"), F.col("threshold_kwh")
    return own_or_shared(location_intervals, thresholds, ["interval_start"]).withColumn(
        "level", F.when(kwh >= limit, "breach").when(kwh >= limit * share, "warning")
    )


def peak_alerts(
    location_intervals: DataFrame, thresholds: DataFrame, share: float = 0.8
) -> DataFrame:
    """Intervals in which a location used at least ``share`` of its threshold."""
    judged = judge(location_intervals, thresholds, share).where(F.col("level").isNotNull())
    return judged.select("location_id", "interval_start", "kwh", "threshold_kwh", "level")


def alert_episodes(
    readings: DataFrame, thresholds: DataFrame, share: float = 0.8, keep: float = 0.6, minutes: int = 15
) -> DataFrame:
    """Stretches of consecutive intervals near the threshold, one row each, batch or stream.

    An episode goes on while intervals have at least ``keep`` of the threshold and
    counts if one of them reaches ``share``, so a load that swings around the limit
    is one alert, not many.  A stream needs a watermark on the readings' time.
    """
    slots = (
        energy_rows(readings)
        .groupBy("location_id", F.window("at", f"{minutes} minutes"))
        .agg(F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("kwh"))
        .select("location_id", F.window_time("window").alias("_t"), F.col("window.start").alias("interval_start"), "kwh")
    )
    kwh, limit = F.col("kwh"), F.col("threshold_kwh")
    near = judge(slots, thresholds, share).where(kwh >= limit * keep)
    start = F.unix_micros("interval_start")
    return (
        near.groupBy("location_id", F.session_window("_t", f"{minutes} minutes"))
        .agg(
            F.min("interval_start").alias("begin"),
            F.timestamp_add("MINUTE", F.lit(minutes), F.max("interval_start")).alias("end"),
            F.count("*").alias("n_intervals"),
            F.sum("kwh").alias("kwh"),
            # The earliest of the greatest.
            F.max(F.struct("kwh", (-start).alias("t"), "interval_start")).alias("_peak"),
            F.bool_or(F.col("level").isNotNull()).alias("_alert"),
            F.bool_or(F.coalesce(F.col("level") == "breach", F.lit(False))).alias("breach"),
        )
        .where("_alert")
        .select(
            "location_id", "begin", "end", "n_intervals", "kwh",
            F.col("_peak.kwh").alias("peak_kwh"), F.col("_peak.interval_start").alias("peak_start"), "breach",
        )
    )


def without_threshold(location_intervals: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Locations that no alert can be raised for, with the energy that goes unjudged."""
    open_ended = judge(location_intervals, thresholds).where(F.col("threshold_kwh").isNull())
    return open_ended.groupBy("location_id").agg(F.count("*").alias("n_intervals"), F.sum("kwh").alias("kwh"))


def own_or_shared(
    facts: DataFrame,
    dim: DataFrame,
    spread_by: Sequence[str],
    on: Sequence[str] = (),
    how: str = "left",
    residual: Column | None = None,
    key: str = "location_id",
    shared: str = "*",
) -> DataFrame:
    """Join rows of the fact's own key, or the shared rows if the key has none of its own."""
    # What is made of the dimension fits where the dimension does: it is counted once.
    fits = fits_broadcast(dim)
    own = dim.where(F.col(key) != shared).select(key).distinct().withColumn("_own", F.lit(True))
    facts = lookup_join(facts, own, [key], spread_by, fits=fits).withColumn(
        "_scope", F.when(F.col("_own"), F.col(key)).otherwise(shared)
    )
    scoped = dim.withColumnRenamed(key, "_scope")
    joined = lookup_join(facts, scoped, ["_scope", *on], spread_by, how, residual=residual, fits=fits)
    return joined.drop("_own", "_scope")


def adjusted_usage(readings: DataFrame, adjustments: DataFrame) -> DataFrame:
    """Metered, adjusted and net energy per device and day.

    Adjustments are an append-only list; they are added up beside the readings,
    never applied to them, and an adjustment without a reading still counts.
    """
    key = ["device_eui", "day"]
    metered = daily_usage(readings, ["device_eui"]).select(
        *key,
        F.col("kwh").alias("metered_kwh"),
        F.lit(0.0).alias("adjustment_kwh"),
        F.lit(0).cast("bigint").alias("n_adjustments"),
        F.lit("").alias("justifications"),
    )
    manual = (
        adjustments.groupBy("device_eui", F.to_date("original_mqtt_time").alias("day"))
        .agg(
            F.sum("adjustment_kwh").alias("adjustment_kwh"),
            F.count("*").alias("n_adjustments"),
            F.array_join(F.array_sort(F.collect_set("justification")), "; ").alias("justifications"),
        )
        .withColumn("metered_kwh", F.lit(0.0))
    )
    # At most one row of each kind per device and day is left to bring together.
    return (
        metered.unionByName(manual)
        .groupBy(*key)
        .agg(
            F.sum("metered_kwh").alias("metered_kwh"),
            F.sum("adjustment_kwh").alias("adjustment_kwh"),
            F.sum("n_adjustments").alias("n_adjustments"),
            F.max("justifications").alias("justifications"),
        )
        .withColumn("net_kwh", F.col("metered_kwh") + F.col("adjustment_kwh"))
    )


def daily_star(readings: DataFrame, kind: str = "interval_kwh") -> DataFrame:
    """One row per device, place, client and day with calendar fields, ready for BI tools.

    Energy and readings are counted for the place and client of their time, so a
    device that moves inside a day has a row for each.  A day whose readings are all
    excluded has a row without energy.
    """
    demand = F.when(is_finite(demand_kw()), demand_kw())
    rows = energy_rows(readings.withColumn("_kw", demand), kind, ["client_id", "_kw"])
    key = [*PLACE, "client_id", F.to_date("at").alias("day")]
    days = rows.groupBy(*key).agg(
        F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("kwh"),
        F.count("kwh").alias("n_readings"),
        F.max("_kw").alias("max_demand_kw"),
    )
    return days.select("*", *calendar_columns(F.col("day")))


def calendar_columns(day: Column) -> list[Column]:
    weekday = F.weekday(day) + 1
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        weekday.alias("iso_weekday"),
        (weekday >= 6).alias("is_weekend"),
    ]
