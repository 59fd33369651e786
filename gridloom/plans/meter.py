"""The message flow over one data folder, step by step and lazily."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from gridloom import session
from gridloom.operators import archive, decode, parse, route, verify
from gridloom.operators.ordering import spread_small
from gridloom.sources import derived



class Meter:
    """Everything that queries over derived meter messages start from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = session.prepare(spark)
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A data table; its schema is read once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def envelopes(self) -> DataFrame:
        return derived.envelopes(spread_small(self.table("events"), "event_id"))

    @cached_property
    def registry(self) -> DataFrame:
        return derived.registry(self.spark, self.sf_dir)

    @cached_property
    def parsed(self) -> DataFrame:
        return parse.parse_messages(self.envelopes)

    @cached_property
    def routed(self) -> DataFrame:
        return route.route(self.envelopes, self.registry, F.col("publish_time"))

    @cached_property
    def decoded(self) -> DataFrame:
        """Everything the decoder receives, from both outputs."""
        both = self.routed.where(F.col("exit").isin("enriched", "unidentified"))
        return decode.decode(both, F.col("publish_time"))

    @cached_property
    def readings(self) -> DataFrame:
        known = route.enriched(self.routed, "publish_time")
        return decode.meter_readings(decode.decode(known, F.col("publish_time")))

    @cached_property
    def topics(self) -> DataFrame:
        return derived.landed_topics(route.topic_records(self.routed))

    @cached_property
    def archive_routes(self) -> DataFrame:
        return archive.archive_routes(self.topics)

    @cached_property
    def archived(self) -> DataFrame:
        return archive.archive_records(self.archive_routes, F.col("publish_time"))

    @cached_property
    def verified(self) -> DataFrame:
        received = F.timestamp_add("MILLISECOND", F.lit(50), F.col("publish_time"))
        return verify.verify_records(self.topics, received)

    @cached_property
    def run_devices(self) -> DataFrame:
        """A run plan: every device, which of them should be known, and its rate."""
        key = F.col("c_custkey")
        return self.table("customer").select(
            F.concat(F.lit("DEV-"), F.lpad(key.cast("string"), 6, "0")).alias("device_eui"),
            (key % 5 != 0).alias("known"),
            F.lit(2_592_000.0).alias("duration_s"),
            F.lit(0.000025).alias("rate"),
        )


def comparable(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times without a zone."""
    zoned = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in df.schema.fields
        if isinstance(f.dataType, TimestampType)
    }
    return df.withColumns(zoned) if zoned else df
