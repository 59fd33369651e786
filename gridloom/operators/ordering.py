"""Positions in an ordered group, without one task ever holding the group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from gridloom import session


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str],
    into: str = "position",
) -> DataFrame:
    """Exact 1-based row numbers per key, ordered by ``time`` then ``ties``.

    Rows are cut into ranges of (key, time, ties) of about equal size, whatever
    the share of one key or of one instant.  The cut rows are written, which
    fixes each row's cut.  Rows are then counted per key and cut, running totals
    are taken over those counts only, and rows are numbered inside (key, cut).
    Spark samples the input before it cuts, so it should be a table.
    """
    # One text key that is never NULL serves the cut, the count and the join.
    ordered = df.withColumn("_key", F.to_json(F.struct(*[F.col(k) for k in keys])))
    ordered = ordered.repartitionByRange("_key", time, *ties)
    cut = session.settle(ordered.withColumn("_cut", F.spark_partition_id()), "ordered")
    earlier = Window.partitionBy("_key").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("_key", "_cut")
        .agg(F.count("*").alias("_n"))
        .select("_key", "_cut", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_key", "_cut").orderBy(time, *ties)
    return (
        cut.join(offsets, ["_key", "_cut"])
        .withColumn(into, F.row_number().over(inside) + F.col("_before"))
        .drop("_key", "_cut", "_before")
    )


def exact_percentiles(
    counts: DataFrame,
    value: str,
    points: Sequence[float],
    by: Sequence[str],
    width: int = 1 << 16,
) -> DataFrame:
    """Interpolated percentiles of whole numbers, per group, from their counts.

    ``counts`` has one row per group and value with its frequency ``n``.  Values
    are cut into ranges of ``width``; running totals over the ranges give each
    range its first rank, and ranks inside a range are counted there.  No task
    sees all values of a group.  ``counts`` is read twice, so it should be a table.
    """
    by = list(by)
    counts = counts.where(F.col(value).isNotNull()).withColumn(
        "_range", F.floor(F.col(value) / width)
    )
    ranges = counts.groupBy(*by, "_range").agg(F.sum("n").alias("_rn"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *by,
        "_range",
        F.coalesce(F.sum("_rn").over(earlier), F.lit(0)).alias("_first"),
        F.sum("_rn").over(Window.partitionBy(*by)).alias("_total"),
    )
    inside = (
        Window.partitionBy(*by, "_range")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = (
        counts.join(ranges, [*by, "_range"])
        .withColumn("_end", F.col("_first") + F.sum("n").over(inside))
        .withColumn("_start", F.col("_end") - F.col("n"))
        .withColumn("point", F.explode(F.array(*[F.lit(float(p)) for p in points])))
        .withColumn("_at", F.col("point") * (F.col("_total") - 1))
    )
    low, high = F.floor("_at"), F.ceil("_at")
    holds_low = (low >= F.col("_start")) & (low < F.col("_end"))
    holds_high = (high >= F.col("_start")) & (high < F.col("_end"))
    return (
        ranked.where(holds_low | holds_high)
        .groupBy(*by, "point")
        .agg(
            F.max(F.when(holds_low, F.col(value))).alias("_low"),
            F.max(F.when(holds_high, F.col(value))).alias("_high"),
            F.max(F.col("_at") - low).alias("_share"),
        )
        .select(
            *by,
            "point",
            (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("value"),
        )
    )


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on a source that has fewer splits than there are cores.

    Parsing costs far more than moving a few raw rows.  A large source has more
    splits than cores and is left alone, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def spread_write(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Group rows by partition columns for a write; hot groups are split again."""
    return df.hint("rebalance", *columns)
