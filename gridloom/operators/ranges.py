"""Sums over any range of time out of a kept hierarchy of hours, days, months and years.

A range is cut into its greatest whole pieces: hours up to the next day, days up to the next
month, months up to the next year, years, and back down.  So it meets some tens of rows of
the hierarchy whatever its length, never the readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.operators.usage import energy_rows

UNITS = ("hour", "day", "month", "year")


def hierarchy(readings: DataFrame, by: Sequence[str] = ("location_id",), kind: str = "interval_kwh", minutes: int = 15) -> DataFrame:
    """Energy and greatest interval power per unit of time, all made of the hours.

    ``max_kw`` is the greatest mean power of an interval of ``minutes``.
    """
    by = list(by)
    slots = energy_rows(readings, kind).groupBy(*by, F.window("at", f"{minutes} minutes").alias("w")).agg(F.sum("kwh").alias("kwh"))
    hours = slots.groupBy(*by, F.date_trunc("hour", F.col("w.start")).alias("hour")).agg(
        F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("kwh"), F.max(F.col("kwh") * (60 / minutes)).alias("max_kw")
    )
    units = F.explode(F.array(*[F.struct(F.lit(u).alias("unit"), F.date_trunc(u, "hour").alias("start")) for u in UNITS]))
    return (
        hours.select(*by, "kwh", "max_kw", units.alias("u"))
        .groupBy(*by, "u.unit", "u.start")
        .agg(F.sum("kwh").alias("kwh"), F.max("max_kw").alias("max_kw"))
    )


def _next(unit: str, at: Column) -> Column:
    """The first whole unit that begins at ``at`` or after it."""
    floor = F.date_trunc(unit, at)
    return F.when(floor == at, at).otherwise(floor + F.expr(f"interval 1 {unit}"))


def pieces(ranges: DataFrame) -> DataFrame:
    """``unit`` and ``start`` of the greatest whole pieces of [``range_start``, ``range_end``).

    Both ends are whole hours; other ranges are refused when they are read.
    """
    low, high = F.col("range_start"), F.col("range_end")
    whole = (F.date_trunc("hour", low) == low) & (F.date_trunc("hour", high) == high)
    checked = F.when(whole, low).otherwise(F.raise_error(F.lit("a range begins and ends with an hour")))
    rows = ranges.withColumn("range_start", checked).where("range_start < range_end")
    bounds: list[tuple[str, Column, Column]] = []
    for at, unit in enumerate(UNITS):
        if at + 1 == len(UNITS):
            bounds.append((unit, low, high))
            break
        greater = UNITS[at + 1]
        # Up to the next greater unit, and from the last greater unit on.
        up, down = F.least(_next(greater, low), high), F.greatest(F.date_trunc(greater, high), F.least(_next(greater, low), high))
        bounds += [(unit, low, up), (unit, down, high)]
        low, high = up, down
    cut = F.array(*[F.struct(F.lit(u).alias("unit"), a.alias("a"), b.alias("b")) for u, a, b in bounds])
    spans = rows.withColumn("_c", F.explode(cut)).where(F.col("_c.a") < F.col("_c.b"))
    start = F.lit(None).cast("array<timestamp>")
    for unit in UNITS:
        step = F.expr(f"interval 1 {unit}")
        start = F.when(F.col("_c.unit") == unit, F.sequence(F.col("_c.a"), F.col("_c.b") - step, step)).otherwise(start)
    return spans.select(*ranges.columns, F.col("_c.unit").alias("unit"), F.explode(start).alias("start"))


def range_sums(kept: DataFrame, ranges: DataFrame, by: Sequence[str] = ("location_id",)) -> DataFrame:
    """Energy and greatest power of every range; ``ranges`` has the ``by`` columns."""
    found = pieces(ranges).join(kept, [*by, "unit", "start"], "left")
    return found.groupBy(*ranges.columns).agg(
        F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("kwh"), F.max("max_kw").alias("max_kw")
    )
