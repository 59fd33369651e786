"""Message, registry and archive sources."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom import session
from gridloom.schemas import ARCHIVE_PARTITIONS, ENVELOPE, REGISTRY


def landed_envelopes(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed messages: payload text with its transport fields."""
    return spark.read.schema(ENVELOPE).format(fmt).load(path)


def landed_envelope_stream(
    spark: SparkSession, path: str, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    """The same as a stream; ``max_files`` bounds each micro-batch, nothing is dropped."""
    reader = spark.readStream.schema(ENVELOPE).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def kafka_stream(
    spark: SparkSession, servers: str, topics: str, max_offsets: int | None = None, **options: str
) -> DataFrame:
    """Topic records as a stream; needs Spark's Kafka package on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("includeHeaders", "true")
        .options(**options)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return from_kafka(reader.load())


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka's columns as an envelope; partition and offset identify a message.

    Headers, if asked for, become the attribute map that the sink made them from.
    """
    attributes = []
    if "headers" in records.columns:
        entries = F.transform(
            F.col("headers"), lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value"))
        )
        # A repeated header counts once, the last one.
        distinct = F.aggregate(
            entries,
            F.create_map().cast("map<string,string>"),
            lambda all_, e: F.map_concat(
                F.map_filter(all_, lambda k, _: ~k.eqNullSafe(e["key"])), F.create_map(e["key"], e["value"])
            ),
        )
        attributes = [F.coalesce(distinct, F.create_map().cast("map<string,string>")).alias("attributes")]
    return records.select(
        F.concat_ws("-", F.col("partition").cast("string"), F.col("offset").cast("string")).alias(
            "message_id"
        ),
        "topic",
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").alias("publish_time"),
        *attributes,
    )


def device_registry(table: DataFrame) -> DataFrame:
    """One row per device, as in a keyed store, whatever the table holds."""
    rest = [c for c in REGISTRY.names if c != "device_eui"]
    return (
        table.groupBy("device_eui")
        .agg(F.max(F.struct(*rest)).alias("_entry"))
        .select("device_eui", *[F.col("_entry")[c].alias(c) for c in rest])
    )


class RegistrySnapshot:
    """Registry data that is at most ``ttl`` seconds old.

    A stream asks for it once per micro-batch.  What is loaded is written to the
    shared folder, so it can be read whatever becomes of its source.  When a reload
    fails, the last good data is kept; a device that was not found is looked up again
    in the next batch, as misses are never remembered.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        ttl: float = 300.0,
        clock: Callable[[], float] = time.monotonic,
    ):
        self._load, self._ttl, self._clock = load, ttl, clock
        self._data: DataFrame | None = None
        self._before: DataFrame | None = None
        self._loaded_at = 0.0

    def get(self) -> DataFrame:
        now = self._clock()
        if self._data is None or now - self._loaded_at >= self._ttl:
            try:
                fresh = session.settle(self._load(), "registry")
            except Exception:
                if self._data is None:
                    raise
                return self._data
            # The one before may still be read by the batch that asked for it.
            if self._before is not None:
                session.discard(self._before)
            self._before, self._data, self._loaded_at = self._data, fresh, now
        return self._data


def read_archive(
    spark: SparkSession,
    path: str,
    first_day: str,
    last_day: str,
    location: str | None = None,
) -> DataFrame:
    """Archived records of a range of days (ISO dates, both included).

    Only the folders of these days are listed, and of those only the location's are
    scanned.  Payloads stay text.
    """
    parts = ", ".join(f"{f.name} string" for f in ARCHIVE_PARTITIONS.fields)
    first, last = date.fromisoformat(first_day), date.fromisoformat(last_day)
    days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    folders = [f"{path}/year={d:%Y}/month={d:%m}/day={d:%d}" for d in days]
    folders = [folder for folder in folders if session.exists(spark, folder)]
    reader = spark.read.schema(f"value string, {parts}").option("basePath", path)
    lines = reader.text(folders) if folders else spark.createDataFrame([], f"value string, {parts}")
    day = F.concat_ws("-", "year", "month", "day")
    lines = lines.where((day >= first_day) & (day <= last_day))
    if location is not None:
        lines = lines.where(F.col("location") == location)
    head = F.from_json("value", "device_eui string, archived_at string")
    return lines.select(
        head["device_eui"].alias("device_eui"),
        archived_payload(F.col("value")).alias("original_pubsub_payload"),
        head["archived_at"].alias("archived_at"),
        *ARCHIVE_PARTITIONS.names,
    )


def archive_folders(spark: SparkSession, path: str) -> DataFrame:
    """Day and location of every archived file, from its place; no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(path)
    # Taken as text: the values of partitions would be read as numbers.
    value = lambda name: F.url_decode(
        F.replace(F.regexp_extract("path", f"/{name}=([^/]*)/", 1), F.lit("+"), F.lit("%2B"))
    )
    return listed.select(*[value(p).alias(p) for p in ARCHIVE_PARTITIONS.names], F.col("length").alias("bytes"))


def archived_payload(line):
    """The payload exactly as archived: from its key up to the last field."""
    return F.regexp_extract(
        line, r'(?s)"original_pubsub_payload":(.*),"archived_at":"[^"]*"\}\z', 1
    )


def lookup_reading(readings: DataFrame, device_eui: str) -> DataFrame:
    """The latest reading of one device."""
    return (
        readings.where(F.col("device_eui") == device_eui)
        .select(
            "uid",
            "reading",
            "device_eui",
            "client_id",
            "location_id",
            "device_category",
            "device_type",
            "original_mqtt_time",
        )
        .orderBy(F.desc("original_mqtt_time"), F.desc("reading"), "uid")
        .limit(1)
    )
