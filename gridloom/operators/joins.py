"""Joins against dimension tables: lookup, as-of and time-range.

A dimension is broadcast only after its rows and bytes were counted; beyond the
bound the join shuffles, each side once, and Spark splits the rows of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(
    dim: DataFrame, max_rows: int | None = None, max_bytes: int | None = None
) -> bool:
    """Count at most ``max_rows + 1`` rows and their text size.

    A dimension object keeps the answer: further joins with it count nothing.
    """
    max_rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    known = vars(dim).setdefault("_fits_broadcast", {})
    if (max_rows, max_bytes) not in known:
        known[max_rows, max_bytes] = _fits(dim, max_rows, max_bytes)
    return known[max_rows, max_bytes]


def _fits(dim: DataFrame, max_rows: int, max_bytes: int) -> bool:
    width = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in dim.columns])))
    found = (
        dim.limit(max_rows + 1)
        .agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b"))
        .first()
    )
    return found["n"] <= max_rows and found["b"] <= max_bytes


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    max_rows: int | None = None,
    salts: int = 1,
    residual: Column | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """Join facts to a dimension on equal keys (and an optional residual condition).

    ``fits`` is the answer for a dimension that was counted before.

    With ``salts`` over 1 the dimension is copied so often and the facts' keys are
    spread by the columns ``spread_by``, which vary within a hot key: for sessions
    without Spark's skew join.
    """
    if how not in ("left", "inner"):
        raise ValueError("lookup_join keeps or filters facts: left or inner")
    names = {c: f"_dim_{c}" for c in on}
    fits = fits_broadcast(dim, max_rows) if fits is None else fits
    dim = dim.withColumnsRenamed(names)
    matches = F.lit(True)
    for c in on:
        matches = matches & (F.col(c) == F.col(names[c]))
    if residual is not None:
        matches = matches & residual
    if fits:
        return facts.join(F.broadcast(dim), matches, how).drop(*names.values())
    if salts <= 1:
        return facts.join(dim, matches, how).drop(*names.values())
    facts = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    dim = dim.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    matches = matches & (F.col("_salt") == F.col("_dim_salt"))
    return facts.join(dim, matches, how).drop("_salt", "_dim_salt", *names.values())


def asof_join(
    facts: DataFrame,
    dim: DataFrame,
    by: Sequence[str],
    fact_time: str,
    valid_from: str,
    values: Sequence[str],
    spread_by: Sequence[str],
) -> DataFrame:
    """Add ``values`` of the latest dimension row with ``valid_from <= fact_time``.

    Rows of a key that a later row ends are expanded to the days they cover and
    joined on (key, day); the last row of each key is joined on the key alone.
    Either way a fact meets a handful of rows, not the whole history of its key.
    Facts before the first row keep NULL.
    """
    by = list(by)
    history = dim.groupBy(*by, valid_from).agg(
        F.max(F.struct(*[F.col(v) for v in values])).alias("_values")
    )
    history = history.withColumn(
        "_until", F.lead(valid_from).over(Window.partitionBy(*by).orderBy(valid_from))
    ).withColumnRenamed(valid_from, "_from")
    day = F.explode(
        F.sequence(F.to_date("_from"), F.to_date(F.col("_until") - F.expr("interval 1 microsecond")))
    )
    ended = history.where(F.col("_until").isNotNull()).select(
        *by, "_from", "_until", day.alias("_day"), F.col("_values").alias("_ended")
    )
    open_end = history.where(F.col("_until").isNull()).select(
        *by, F.col("_from").alias("_open_from"), F.col("_values").alias("_open")
    )
    # One count for both parts, kept with the dimension.
    fits = vars(dim).get("_fits_asof")
    if fits is None:
        parts = ended.drop("_ended").unionByName(open_end.drop("_open"), allowMissingColumns=True)
        fits = vars(dim)["_fits_asof"] = fits_broadcast(parts)
    facts = facts.withColumn("_day", F.to_date(fact_time))
    at = F.col(fact_time)
    out = lookup_join(
        facts,
        ended,
        [*by, "_day"],
        spread_by,
        residual=(at >= F.col("_from")) & (at < F.col("_until")),
        fits=fits,
    ).drop("_from", "_until", "_day")
    out = lookup_join(out, open_end, by, spread_by, residual=at >= F.col("_open_from"), fits=fits)
    picked = F.coalesce("_ended", "_open")
    for v in values:
        out = out.withColumn(v, picked[v])
    return out.drop("_ended", "_open", "_open_from")


def asof_carry(
    facts: DataFrame,
    dim: DataFrame,
    by: Sequence[str],
    fact_time: str,
    valid_from: str,
    values: Sequence[str],
) -> DataFrame:
    """The same result by merging: facts and dimension rows in one order, the last value carried.

    Both are cut by key and day and sorted together; a day begins with one row that carries
    the value in force, so no task holds a key's whole history and no fact meets more than
    one dimension row.  Days after a key's last change take its last value without
    the merge.  For histories too dense or too long to broadcast.
    """
    by, at = list(by), F.col(fact_time)
    history = dim.select(*by, F.col(valid_from).alias("_at"), F.struct(*[F.col(v) for v in values]).alias("_value"))
    # Everything about the history comes out of one ordering of it.
    last_of_equals = F.lead("_at").over(Window.partitionBy(*by).orderBy("_at", "_value"))
    history = history.withColumn("_next", last_of_equals).where(F.col("_next").isNull() | (F.col("_next") > F.col("_at")))
    order = Window.partitionBy(*by).orderBy("_at")
    history = history.select(
        *by,
        "_at",
        "_value",
        F.to_date("_at").alias("_day"),
        F.lag("_value").over(order).alias("_before"),
        F.date_add(F.to_date(F.lag("_at").over(order)), 1).alias("_from"),
        F.lead("_at").over(order).isNull().alias("_ends"),
    )
    ends = history.where("_ends").select(*by, F.col("_day").alias("_last"), F.col("_value").alias("_final"))
    # A change is a row, and so is the beginning of every day since the change before it.
    days = F.when(F.col("_from") <= F.col("_day"), F.sequence("_from", "_day"))
    own = F.array(F.struct(F.col("_at"), F.col("_day"), F.col("_value"), F.lit(1).alias("_kind")))
    carried = F.transform(
        F.coalesce(days, F.array().cast("array<date>")),
        lambda d: F.struct(d.cast("timestamp").alias("_at"), d.alias("_day"), F.col("_before").alias("_value"), F.lit(0).alias("_kind")),
    )
    changes = history.select(*by, F.inline(F.concat(own, carried)))
    row = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    merged = (
        facts.select(*by, at.alias("_at"), F.to_date(at).alias("_day"), row.alias("_row"), F.lit(2).alias("_kind"))
        .unionByName(changes, allowMissingColumns=True)
    )
    inside = Window.partitionBy(*by, "_day").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = merged.withColumn("_value", F.last("_value", ignorenulls=True).over(inside)).where("_kind = 2")
    found = lookup_join(found, ends, by, ["_at"], fits=fits_broadcast(dim))
    value = F.when(F.col("_day") > F.col("_last"), F.col("_final")).otherwise(F.col("_value"))
    return found.select("_row.*", *[value[v].alias(v) for v in values])
