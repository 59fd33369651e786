"""Manual adjustments as a ledger in two times: the day they are for, and when they were made.

Entries are only added.  One that was wrong is reversed by a counter entry and, if need be,
followed by another, so whatever was known at any time can be reckoned again.  Seals make
later changes show: the entries of a device and month give a digest, and each month's seal
is taken of the seal before and that digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.operators.usage import daily_usage

ENTRY = ["entry_id", "device_eui", "day", "recorded_at", "kwh", "justification", "reverses"]


def reversals(entries: DataFrame, wrong: DataFrame) -> DataFrame:
    """Counter entries for ``wrong`` (``entry_id``, ``recorded_at``, ``justification``).

    An entry that is reversed already, or is a counter entry itself, is not reversed again.
    """
    w = wrong.groupBy("entry_id").agg(F.min(F.struct("recorded_at", "justification")).alias("_w"))
    done = entries.where("reverses is not null").select(F.col("reverses").alias("entry_id"))
    open_entries = entries.where("reverses is null").join(done, "entry_id", "left_anti")
    return open_entries.join(w, "entry_id").select(
        F.concat(F.col("entry_id"), F.lit("-r")).alias("entry_id"),
        "device_eui",
        "day",
        F.col("_w.recorded_at").alias("recorded_at"),
        (-F.col("kwh")).alias("kwh"),
        F.col("_w.justification").alias("justification"),
        F.col("entry_id").alias("reverses"),
    )


def known_adjustments(entries: DataFrame, known_at: Sequence[str]) -> DataFrame:
    """Per time of knowledge, device and day: the sum of what had been recorded by then."""
    times = F.explode(F.array(*[F.lit(t).cast("timestamp") for t in known_at])).alias("known_at")
    # Summed by day of record first: few rows are left to be copied per time.
    return (
        entries.select("*", times)
        .where(F.col("recorded_at") <= F.col("known_at"))
        .groupBy("known_at", "device_eui", "day")
        .agg(F.sum("kwh").alias("adjustment_kwh"), F.count("*").alias("n_entries"))
    )


def usage_as_known(readings: DataFrame, entries: DataFrame, known_at: Sequence[str]) -> DataFrame:
    """Metered, adjusted and net energy per device and day, as known at each of the times."""
    times = F.explode(F.array(*[F.lit(t).cast("timestamp") for t in known_at])).alias("known_at")
    metered = daily_usage(readings, ["device_eui"]).select(times, "device_eui", "day", F.col("kwh").alias("metered_kwh"))
    both = metered.unionByName(known_adjustments(entries, known_at), allowMissingColumns=True)
    return (
        both.groupBy("known_at", "device_eui", "day")
        .agg(
            F.coalesce(F.sum("metered_kwh"), F.lit(0.0)).alias("metered_kwh"),
            F.coalesce(F.sum("adjustment_kwh"), F.lit(0.0)).alias("adjustment_kwh"),
            F.coalesce(F.sum("n_entries"), F.lit(0)).alias("n_entries"),
        )
        .withColumn("net_kwh", F.col("metered_kwh") + F.col("adjustment_kwh"))
    )


def entry_digest() -> Column:
    """Every field with its length, so that no two entries read alike."""
    text = {
        "day": F.date_format("day", "yyyy-MM-dd"),
        "recorded_at": F.unix_micros("recorded_at").cast("string"),
    }
    fields = [text.get(c, F.col(c).cast("string")) for c in ENTRY]
    framed = [F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in fields]
    return F.sha2(F.concat(*framed), 256)


def seals(entries: DataFrame) -> DataFrame:
    """Per device and month of record: its entries' digest and the running seal.

    A slice, a device's entries of one month, and a device's months are collected; both
    are bounded by what people enter by hand.
    """
    rows = entries.select("device_eui", F.date_format("recorded_at", "yyyy-MM").alias("month"), "recorded_at", "entry_id", entry_digest().alias("d"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("recorded_at", "entry_id", "d"))), lambda x: x["d"])
    slices = rows.groupBy("device_eui", "month").agg(
        F.count("*").alias("n_entries"), F.sha2(F.array_join(in_order, ""), 256).alias("digest")
    )
    chain = slices.groupBy("device_eui").agg(F.array_sort(F.collect_list(F.struct("month", "n_entries", "digest"))).alias("s"))
    seal = lambda n: F.aggregate(
        F.slice("s", F.lit(1), n), F.lit(""), lambda before, x: F.sha2(F.concat(before, x["digest"]), 256)
    )
    sealed = F.transform(F.sequence(F.lit(1), F.size("s")), lambda n: F.struct(F.element_at("s", n).alias("x"), seal(n).alias("seal")))
    return chain.select("device_eui", F.inline(sealed)).select("device_eui", "x.month", "x.n_entries", "x.digest", "seal")


def broken_seals(entries: DataFrame, kept: DataFrame) -> DataFrame:
    """Months whose entries no longer give the seal that was kept, per device the first one."""
    now = seals(entries).select("device_eui", "month", F.col("seal").alias("_now"))
    joined = kept.join(now, ["device_eui", "month"], "left")
    wrong = joined.where(~F.col("seal").eqNullSafe(F.col("_now")))
    return wrong.groupBy("device_eui").agg(F.min("month").alias("month"))
