"""Parameter tables of the energy queries: tariffs, factors, targets and the like."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.operators import ledger
from gridloom.sources.derived import location_of_nation, registry_rows

# Our default parameters.
AS_OF = "2024-01-31 00:00:00"
TARIFF_ROWS = """
 ('peak', array(1,2,3,4,5), 16, 20, 'peak', 0.5D),
 ('shoulder-day', array(1,2,3,4,5), 7, 16, 'shoulder', 0.25D),
 ('shoulder-evening', array(1,2,3,4,5), 20, 22, 'shoulder', 0.25D),
 ('off-night', array(1,2,3,4,5), 22, 24, 'off-peak', 0.125D),
 ('off-morning', array(1,2,3,4,5), 0, 7, 'off-peak', 0.125D),
 ('off-weekend', array(6,7), 0, 24, 'off-peak', 0.125D)"""
FACTORS = [
    ("2024-01-01 00:00:00", 0.25),
    ("2024-01-11 00:00:00", 0.375),
    ("2024-01-21 00:00:00", 0.125),
]


def tariffs(spark: SparkSession) -> DataFrame:
    """Shared time-of-use tariff for all locations."""
    return spark.sql(
        "select tariff_id, '*' location_id, 'UTC' zone, date'2024-01-01' valid_from,"
        " cast(null as date) valid_to, days, hour_from, hour_to, period, rate"
        f" from values {TARIFF_ROWS} as t(tariff_id, days, hour_from, hour_to, period, rate)"
    )


def charges(places: DataFrame) -> DataFrame:
    """Each location's price per kW of peak demand and per month."""
    return places.select(
        "location_id", F.lit(8.0).alias("demand_rate"), F.lit(16.0).alias("fixed_rate")
    )


def thresholds(places: DataFrame) -> DataFrame:
    """Each location's contractual energy per 15 minutes."""
    return places.select("location_id", F.lit(64.0).alias("threshold_kwh"))


def subscriptions(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "select * from values ('ops', 'anomalies', 'always'), ('finance', 'cost', 'always'),"
        " ('exec', 'usage', 'peak_alert') as t(report_group, report, condition)"
    )


def locations(nation: DataFrame) -> DataFrame:
    """Locations with their region, one per nation."""
    return nation.select(
        location_of_nation(F.col("n_nationkey")).alias("location_id"),
        F.col("n_regionkey").cast("string").alias("region"),
    )


def factors(region: DataFrame) -> DataFrame:
    """Each region's factors; region 0 adopts every change two days later."""
    delay = F.when(F.col("r_regionkey") == 0, 2).otherwise(0)
    rows = F.array(*[F.expr(f"named_struct('start', timestamp'{t}', 'factor', {f}D)") for t, f in FACTORS])
    return region.select(
        F.col("r_regionkey").cast("string").alias("region"), delay.alias("_delay"), F.inline(rows)
    ).select(
        "region", F.timestamp_add("DAY", F.col("_delay"), F.col("start")).alias("valid_from"), "factor"
    )


def targets(places: DataFrame, amount: float) -> DataFrame:
    return places.select(
        "location_id", F.lit("2024-01-01").cast("date").alias("month"), F.lit(amount).alias("target")
    )


def adjustments(events: DataFrame) -> DataFrame:
    """A manual correction for every 500th message."""
    return events.where(F.col("event_id") % 500 == 0).select(
        F.concat(F.lit("DEV-"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("device_eui"),
        F.col("ts").cast("timestamp").alias("original_mqtt_time"),
        F.lit(-1.0).alias("adjustment_kwh"),
        F.lit("meter test").alias("justification"),
    )


def offered_tariffs(supplier: DataFrame) -> DataFrame:
    """Tariff offers of all suppliers, which do overlap."""
    key = F.col("s_suppkey")
    start = F.date_add(F.lit("2024-01-01").cast("date"), (key % 60).cast("int"))
    return supplier.select(
        F.concat(F.lit("T-"), F.lpad(key.cast("string"), 6, "0")).alias("tariff_id"),
        location_of_nation(F.col("s_nationkey")).alias("location_id"),
        F.lit("UTC").alias("zone"),
        start.alias("valid_from"),
        F.date_add(start, (10 + key % 50).cast("int")).alias("valid_to"),
        F.sequence((1 + key % 3).cast("int"), (3 + key % 5).cast("int")).alias("days"),
        (key % 24).cast("int").alias("hour_from"),
        (key * 7 % 24).cast("int").alias("hour_to"),
        F.lit("offer").alias("period"),
        F.lit(0.25).alias("rate"),
    )


# When the registry was copied, and when reports were drawn.
SNAPSHOTS = ["2024-01-01 00:00:00", "2024-01-11 00:00:00", "2024-01-21 12:00:00"]
KNOWN_AT = ["2024-01-15 00:00:00", "2024-01-31 12:00:00"]


def snapshots(customer: DataFrame) -> DataFrame:
    """Three copies of the registry: every 6th device gets another client in the second, every
    10th another place in the third, and every 13th is missing from the second."""
    base = registry_rows(customer.where(F.col("c_custkey") % 7 != 0))
    n = F.substring("device_eui", 5, 20).cast("bigint")
    nation = F.substring("location_id", 5, 20).cast("bigint")
    copies = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.lit(t).cast("timestamp").alias("at")) for i, t in enumerate(SNAPSHOTS)]))
    k = F.col("_copy.k")
    return (
        base.withColumn("_copy", copies)
        .where(~((k == 1) & (n % 13 == 0)))
        .select(
            F.col("_copy.at").alias("taken_at"),
            "device_eui",
            F.when((k >= 1) & (n % 6 == 0), F.concat(F.lit("MOVED-"), "client_id")).otherwise(F.col("client_id")).alias("client_id"),
            F.when((k >= 2) & (n % 10 == 0), location_of_nation((nation + 1) % 25)).otherwise(F.col("location_id")).alias("location_id"),
            "device_category",
        )
    )


def ledger_entries(events: DataFrame) -> DataFrame:
    """Every 500th message is adjusted a day later; every 1000th entry was wrong, is
    reversed two days after and entered anew."""
    after = lambda days: F.timestamp_add("DAY", F.lit(days), F.col("ts").cast("timestamp"))
    name = F.concat(F.lit("E"), F.col("event_id").cast("string"))
    entry = lambda rows, name, days, kwh, why: rows.select(
        name.alias("entry_id"),
        F.concat(F.lit("DEV-"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("device_eui"),
        F.to_date("ts").alias("day"),
        after(days).alias("recorded_at"),
        F.lit(kwh).alias("kwh"),
        F.lit(why).alias("justification"),
        F.lit(None).cast("string").alias("reverses"),
    )
    first = entry(events.where(F.col("event_id") % 500 == 0), name, 1, -1.0, "meter test")
    wrong = events.where(F.col("event_id") % 1000 == 0)
    counter = ledger.reversals(
        first, wrong.select(name.alias("entry_id"), after(3).alias("recorded_at"), F.lit("wrong amount").alias("justification"))
    )
    again = entry(wrong, F.concat(name, F.lit("-2")), 3, -0.5, "meter test")
    return first.unionByName(counter).unionByName(again)


def asked_ranges(nation: DataFrame) -> DataFrame:
    """A range per location: seven hours a nation later at its start, five earlier at its end."""
    key = F.col("n_nationkey").cast("int")
    start, end = (F.lit(t).cast("timestamp") for t in ("2023-12-30 00:00:00", "2024-02-02 00:00:00"))
    return nation.select(
        location_of_nation(F.col("n_nationkey")).alias("location_id"),
        F.timestamp_add("HOUR", key * 7, start).alias("range_start"),
        F.timestamp_add("HOUR", -key * 5, end).alias("range_end"),
    )


def report_rules(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "select * from values ('overuse', 'ops', 'kind', '=', 'interval'), ('overuse', 'ops', 'value', '>=', '60'),"
        " ('sudden', 'ops', 'kind', 'in', 'spike|drop'), ('fault', 'service', 'kind', 'starts with', 'fault'),"
        " ('unusual', 'exec', 'kind', 'in', 'offhours|baseline'), ('large', 'exec', 'value', '>', '100')"
        " as t(name, report_group, field, compare, value)"
    )
