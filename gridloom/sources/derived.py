"""Meter messages and a device registry derived from the star-schema tables.

``events`` become raw messages, ``customer`` becomes the registry.  Some messages
are spoiled on purpose (cut text, no device, bad payloads) and some devices are
left out of the registry or incomplete, so that every exit gets rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.sources.landed import device_registry

WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str, max_files: int = 1000) -> DataFrame:
    """The same table as a file stream with the schema that the table declares.

    The pattern lets the table be one file or a folder of files.
    """
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(f"{sf_dir}/events.parque[t]")
    )


def envelopes(events: DataFrame) -> DataFrame:
    """Events as transport envelopes with a JSON payload (batch or stream)."""
    n = F.col("event_id")
    text_id = n.cast("string")
    digest = F.md5(text_id)
    eui = F.concat(F.lit("DEV-"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
    # A payload of two letters, two digits and five floats in known ranges.
    lead = ["42", "40", "41", "43", "43"]
    floats = [
        part
        for i, byte in enumerate(lead)
        for part in (F.lit(byte), F.substring(digest, 1 + 6 * i, 6))
    ]
    last_two = F.expr("substr(lpad(cast(event_id as string), 2, '0'), -2)")
    good = F.concat(F.lit("4456"), F.hex(last_two), *floats)
    sent = F.col("ts").cast("timestamp")
    rows = events.select(
        "event_id",
        text_id.alias("message_id"),
        F.concat(F.lit("devices/"), eui, F.lit("/up")).alias("topic"),
        F.timestamp_add("MILLISECOND", (n % 5000).cast("int"), sent).alias("publish_time"),
        F.when(n % 89 == 0, "").otherwise(eui).alias("_eui"),
        F.date_format(sent, WIRE_TIME).alias("_sent"),
        F.date_format(sent - F.expr("interval 1 second"), WIRE_TIME).alias("_received"),
        good.alias("_good"),
    )
    hex_text = (
        F.when(n % 73 == 0, "")
        .when(n % 79 == 0, F.concat(F.lit("zz"), F.expr("substr(_good, 3)")))
        .when(n % 83 == 0, F.substring("_good", 1, 46))
        .otherwise(F.col("_good"))
    )
    whole = F.concat(
        F.lit('{"device_info":{"device_eui":"'),
        F.col("_eui"),
        F.lit('"},"lorawan_data":{"rssi":-70,"snr":7.5,"received_at":"'),
        F.col("_received"),
        F.lit('"},"raw_payload":"'),
        hex_text,
        F.lit('","message_timestamp":"'),
        F.col("_sent"),
        F.lit('"}'),
    )
    rows = rows.withColumn("_whole", whole)
    payload = F.when(n % 97 == 0, F.substring("_whole", 1, 20)).otherwise(F.col("_whole"))
    return rows.select("message_id", "topic", payload.alias("payload"), "publish_time")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return device_registry(registry_rows(customer.where(F.col("c_custkey") % 7 != 0)))


def registry_rows(customer: DataFrame) -> DataFrame:
    key = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    return customer.select(
        F.concat(F.lit("DEV-"), key).alias("device_eui"),
        F.concat(F.lit("CLIENT-"), key).alias("client_id"),
        location_of_nation(F.col("c_nationkey")).alias("location_id"),
        F.when(F.col("c_custkey") % 11 == 0, "")
        .otherwise(F.col("c_mktsegment"))
        .alias("device_category"),
    )


def location_of_nation(nation_key):
    return F.concat(F.lit("LOC-"), F.lpad(nation_key.cast("string"), 3, "0"))


def landed_topics(records: DataFrame) -> DataFrame:
    """Topic records as they arrive elsewhere: some cut, some without times.

    Every 101st text is cut, every 103rd lost its client times.
    """
    n = F.col("message_id").cast("bigint")
    zero = '$1"0001-01-01T00:00:00Z"'
    untimed = F.regexp_replace(
        "payload", r'("(?:original_mqtt_time|original_client_timestamp)":)"[^"]*"', zero
    )
    payload = (
        F.when(n % 101 == 0, F.substring("payload", 1, 30))
        .when(n % 103 == 0, untimed)
        .otherwise(F.col("payload"))
    )
    return records.withColumn("payload", payload)
