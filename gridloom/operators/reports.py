"""Quality checks and reports for user groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridloom.functions.binary import is_finite
from gridloom.operators.decode import FLOAT_FIELDS
from gridloom.operators.joins import lookup_join

ITEM = ["report", "location_id", "item_time", "kind", "value"]


def quality_report(decoded: DataFrame, max_kwh: float = 120.0) -> DataFrame:
    """Rows that break each rule, out of all messages that reached the decoder."""
    c = F.col
    read = c("outcome") == "reading"
    finite = F.lit(True)
    for name in FLOAT_FIELDS:
        finite = finite & is_finite(c(name))
    rules = {
        "unknown_device": c("exit") == "unidentified",
        "empty_payload": c("detail") == "empty_payload",
        "undecodable": c("outcome") == "error",
        "missing_time": read & c("original_mqtt_time").isNull(),
        "future_time": read & (c("original_mqtt_time") > c("ingestion_timestamp")),
        "uid_not_text": read & ~F.is_valid_utf8("uid"),
        "not_finite": read & ~finite,
        "out_of_range": read & finite & ((c("reading") < 0) | (c("reading") > max_kwh)),
        "max_current_below_average": read & finite & (c("max_current") < c("average_current")),
        "max_voltage_below_average": read & finite & (c("max_voltage") < c("average_voltage")),
    }
    counts = decoded.agg(
        F.count("*").alias("n_total"),
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
    )
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), c(n).alias("n_rows")) for n in rules])
    return counts.select("n_total", F.inline(rows)).withColumn(
        "share", F.round(F.when(c("n_total") > 0, c("n_rows") / c("n_total")), 9)
    )


def group_reports(items: DataFrame, alerts: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Report items for each group that subscribed to them.

    ``condition`` is ``always`` or ``peak_alert``; with the latter a group gets the
    items of a location only when that location had a peak alert.  Any other
    condition fails the query instead of sending nothing.
    """
    alerted = alerts.select("location_id").distinct().withColumn("_alerted", F.lit(True))
    spread = ["location_id", "item_time", "kind"]
    wanted = lookup_join(items, subscriptions, ["report"], spread, "inner")
    # At most one row per location; counting it beforehand would compute it twice.
    marked = wanted.join(alerted, "location_id", "left")
    condition = F.col("condition")
    unknown = F.raise_error(F.concat(F.lit("unknown condition "), F.coalesce(condition, F.lit("NULL"))))
    due = (
        F.when(condition == "always", True)
        .when(condition == "peak_alert", F.coalesce("_alerted", F.lit(False)))
        .otherwise(unknown.cast("boolean"))
    )
    return marked.where(due).select("report_group", *ITEM)
