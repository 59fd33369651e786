"""Archive routing, batching, files, read-back and expiry."""

import glob
import gzip
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom.operators import archive, ordering
from gridloom.sinks import tables
from gridloom.sources import landed

DAY = datetime(2023, 11, 15, 9, 0, 0)


def record(n, eui, location=None, error=None, when=DAY):
    body = {"device_eui": eui, "raw_payload": "00", "ingestion_timestamp": "2023-11-15T09:00:00Z"}
    if location is not None:
        body["location_id"] = location
    if error is not None:
        body["processing_error"] = error
    return (f"{n}", json.dumps(body), when + timedelta(seconds=n))


def routes(spark, *rows):
    df = spark.createDataFrame(rows, "message_id string, payload string, publish_time timestamp")
    return archive.archive_routes(df)


GOLDEN = [
    record(1, "DEV001", "LOC01"),
    record(2, "DEV002", "LOC09", "device metadata not found"),
    record(3, "DEV003", "LOC01"),
    record(4, "DEV004"),
    ("5", "this is not valid json", DAY),
    record(6, "DEV_STOP", "LOC_STOP"),
]


def test_routing_and_batches(spark):
    routed = routes(spark, *GOLDEN)
    records = archive.archive_records(routed, F.col("publish_time"))
    batches = {
        r.batch_key: (r.batch_no, r.message_count, r.first_message_eui)
        for r in archive.archive_batches(records, 2).collect()
    }
    assert batches == {
        "2023/11/15/LOC01": (0, 2, "DEV001"),
        "2023/11/15/deadletter": (0, 2, "DEV002"),
        "2023/11/15/LOC_STOP": (0, 1, "DEV_STOP"),
    }
    (bad,) = archive.archive_rejects(routed).collect()
    assert (bad.message_id, bad.reason) == ("5", "archive_unparseable")


def test_remainder_is_a_batch_of_its_own(spark):
    rows = [record(i, f"D{i}", "L") for i in range(7)]
    records = archive.archive_records(routes(spark, *rows), F.col("publish_time"))
    got = sorted(tuple(r)[1:4] for r in archive.archive_batches(records, 3).collect())
    assert got == [(0, 3, "D0"), (1, 3, "D3"), (2, 1, "D6")]


def test_files_and_read_back(spark, tmp_path):
    odd = '{"device_eui":"Q\\"1","location_id":"L/1","raw_payload":"00",\n "extra":1.50,"b":{"z":1,"a":2}}'
    rows = [record(i, f"D{i}", "LOC01") for i in range(25)]
    rows += [("90", odd, DAY + timedelta(days=1)), record(91, "LATE", when=DAY + timedelta(days=2))]
    path = tables.archive_path(str(tmp_path))
    records = archive.archive_records(routes(spark, *rows), F.col("publish_time"))
    tables.write_archive(records, path, threshold=10)

    files = glob.glob(f"{path}/year=2023/month=11/day=15/location=LOC01/batch=*/*.gz")
    sizes = [len(gzip.open(f).read().splitlines()) for f in files]
    assert sum(sizes) == 25 and max(sizes) <= 10
    lines = [json.loads(x) for f in files for x in gzip.open(f, "rt")]
    assert set(lines[0]) == {"device_eui", "original_pubsub_payload", "archived_at"}

    everything = landed.read_archive(spark, path, "2023-11-15", "2023-11-17")
    assert everything.count() == 27
    (kept,) = landed.read_archive(spark, path, "2023-11-16", "2023-11-16").collect()
    assert kept.original_pubsub_payload == odd.replace("\n", " ") and kept.device_eui == 'Q"1'
    assert kept.location == "L/1" and kept.day == "16"
    one = landed.read_archive(spark, path, "2023-11-15", "2023-11-15", "LOC01")
    assert one.count() == 25
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert all(column in filters for column in ("year", "month", "day", "location"))


@pytest.mark.parametrize("odd", ["\x85", "\u2028", "\u2029", "é漢🙂", '\\"}', '","archived_at":"x'])
def test_any_text_is_read_back(spark, tmp_path, odd):
    row = record(1, f"D{odd}", "L")
    text = json.dumps(json.loads(row[1]), ensure_ascii=False)
    path = tables.archive_path(str(tmp_path))
    records = archive.archive_records(routes(spark, ("1", text, DAY)), F.col("publish_time"))
    tables.write_archive(records, path)
    (kept,) = landed.read_archive(spark, path, "2023-11-14", "2023-11-16").collect()
    assert kept.original_pubsub_payload == text and kept.device_eui == f"D{odd}"
    assert landed.read_archive(spark, path, "2023-11-16", "2023-11-16").collect() == []


def test_a_named_load_replaces_itself(spark, tmp_path):
    path = tables.archive_path(str(tmp_path))
    records = archive.archive_records(routes(spark, *GOLDEN), F.col("publish_time"))
    for batch in ("a", "a", "b"):
        tables.write_archive(records, path, batch=batch)
    assert landed.read_archive(spark, path, "2023-11-15", "2023-11-15").count() == 2 * records.count()


def test_expiry_reports_first_and_acts_when_told(spark, tmp_path):
    rows = [record(i, "D", "L", when=DAY + timedelta(days=d)) for i, d in enumerate([0, 0, 5, 10])]
    path = tables.archive_path(str(tmp_path))
    records = archive.archive_records(routes(spark, *rows), F.col("publish_time"))
    tables.write_archive(records, path)
    as_of = F.lit("2023-11-25").cast("timestamp")
    due = archive.retention_candidates(records, as_of, 5)
    got = {(r.day, r.message_count, r.age_days) for r in due.collect()}
    assert got == {("15", 2, 10), ("20", 1, 5)}
    listed = archive.retention_folders(landed.archive_folders(spark, path), as_of, 5).collect()
    assert {(r.year, r.month, r.day, r.location, r.age_days) for r in listed} == {(r.year, r.month, r.day, r.location, r.age_days) for r in due.collect()}
    folders = tables.expire_archive(spark, path, due)
    assert folders == [f"{path}/year=2023/month=11/day={d}" for d in (15, 20)]
    assert landed.read_archive(spark, path, "2023-11-01", "2023-11-30").count() == 4
    tables.expire_archive(spark, path, due, act=True)
    spark.catalog.refreshByPath(path)
    left = landed.read_archive(spark, path, "2023-11-01", "2023-11-30")
    assert [r.day for r in left.collect()] == ["25"]


def test_numbering_equals_a_plain_window(spark, monkeypatch):
    """One key with most rows, a third of them at one instant, NULL keys and times."""
    df = spark.range(3000).selectExpr(
        "cast(id as string) id",
        "case when id % 3 <> 0 then 'hot' when id % 30 = 0 then null else cast(id % 7 as string) end k",
        "case when id % 3 = 1 then timestamp'2024-01-01' when id % 11 <> 0"
        " then timestamp_seconds(cast(xxhash64(id) % 900 as bigint) + 1700000000) end t",
    )
    df.createOrReplaceTempView("numbered_input")
    want = spark.sql(
        "select id, row_number() over (partition by k order by t, id) n from numbered_input"
    )
    written = []
    settle = ordering.session.settle

    def keep(cut, purpose):
        written.append(settle(cut, purpose))
        return written[-1]

    monkeypatch.setattr(ordering.session, "settle", keep)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordering.number_rows(df, ["k"], "t", ["id"]).select("id", "position")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    largest = written[0].groupBy("_key", "_cut").count().agg(F.max("count")).first()[0]
    assert largest < 800


@pytest.mark.parametrize("width", [1, 10, 1 << 16])
def test_percentiles_equal_the_builtin(spark, width):
    df = spark.range(5001).selectExpr(
        "case when id % 3 = 0 then 'a' else 'b' end g", "cast(xxhash64(id) % 1000 as bigint) v"
    )
    points = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    counts = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = ordering.exact_percentiles(counts, "v", points, ["g"], width)
    for g in ("a", "b"):
        want = df.where(F.col("g") == g).agg(F.percentile("v", points)).first()[0]
        mine = [r.value for r in got.where(F.col("g") == g).orderBy("point").collect()]
        assert mine == pytest.approx(want, abs=1e-9)


def test_layout_units(spark, tmp_path):
    df = spark.sql(
        "select timestamp'2024-03-05 07:08:09' t, 'b' d union all select timestamp'2024-03-05 09:00:00', 'a'"
    )
    got = {u: tables.layout(df, "t", u).select("partition_time").distinct().count() for u in tables.PARTITION_UNITS}
    assert got == {"HOUR": 2, "DAY": 1, "MONTH": 1, "YEAR": 1}
    with pytest.raises(ValueError):
        tables.layout(df, "t", "MINUTE")
    tables.write_layout(df, str(tmp_path / "t"), "t", "month", ["d"])
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 2 and glob.glob(str(tmp_path / "t/partition_time=2024-03-01-00/*.parquet"))


def test_odd_locations_are_listed_as_they_are(spark, tmp_path):
    rows = [record(i, "D", place, when=DAY) for i, place in enumerate(["007", "a/b", "c+d e", "1e3"])]
    path = tables.archive_path(str(tmp_path))
    tables.write_archive(archive.archive_records(routes(spark, *rows), F.col("publish_time")), path)
    assert {r.location for r in landed.archive_folders(spark, path).collect()} == {"007", "a/b", "c+d e", "1e3"}


def test_clustered_files_can_be_skipped(spark, tmp_path):
    """A filter on two fields, or on either, leaves most files out by their bounds."""
    rows = spark.range(200_000).selectExpr(
        "timestamp'2024-03-05 00:00:00' t", "cast(xxhash64(id) % 5000 as int) x", "concat('d', lpad(cast(pmod(xxhash64(id, 1), 3000) as string), 5, '0')) y", "id"
    )
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_clustered(rows, str(tmp_path / "t"), "t", "DAY", ["x", "y"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 200_000 and back.selectExpr("sum(id)", "sum(x)").first() == rows.selectExpr("sum(id)", "sum(x)").first()
    bounds = back.groupBy(F.input_file_name().alias("f")).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    share = lambda where: bounds.where(where).count() / bounds.count()
    assert bounds.count() > 40
    assert share("x0 <= 100 and x1 >= 100 and y0 <= 'd01000' and y1 >= 'd01000'") < 0.1
    assert share("x0 <= 100 and x1 >= 100") < 0.35 and share("y0 <= 'd01000' and y1 >= 'd01000'") < 0.35


def test_clustering_of_odd_rows(spark, tmp_path):
    rows = spark.sql("select timestamp'2024-03-05' t, cast(null as int) x, 'a' y union all select timestamp'2024-03-06', 1, null")
    tables.write_clustered(rows, str(tmp_path / "t"), "t", "DAY", ["x", "y"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    key = tables.cluster_key(rows.limit(0), ["x", "y"])
    assert {r[0] for r in rows.select(key).collect()} == {0}


def test_kafka_sink_columns(spark):
    df = spark.sql("select '1' message_id, '{}' payload, map('a', 'x') attributes")
    (row,) = tables.to_kafka(df).collect()
    assert (row.key, row.value) == ("1", "{}")
    assert row.headers[0].key == "a" and bytes(row.headers[0].value) == b"x"
