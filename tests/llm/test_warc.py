"""Archives against SQL, against a plain version, and as exact round trips."""

import base64
import gzip
import hashlib
import io
import random

import compare
import pytest
from pyspark.sql import datasource as ds, functions as F

from gridloom import session
from gridloom.llm import warc

SCHEMA = "sha string, page_id long, url string, html string, doc_id int, _key int, record_type string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain(rows):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for payload, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        for number, page_id in enumerate(ids):
            last = number == len(ids) - 1
            out.append((page_id, len(payload), digest(payload), "response" if last else "revisit", None if last else ids[-1]))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([("s", *r, 1, 2, "x") for r in rows], SCHEMA)


def result(spark, monkeypatch, rows):
    monkeypatch.setattr(warc, "table", lambda *_: frame(spark, rows))
    got = warc.op13_warc(spark, "")
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(map(tuple, got.collect()), key=str)


def test_equals_sql(spark, sf_dir):
    tables = compare.connect(sf_dir)
    assert compare.difference(warc.op13_warc(spark, sf_dir), tables, warc.ORACLE_SQL) is None


def test_copies_nulls_and_odd_texts(spark, monkeypatch):
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}</p>") for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "http://h/a b\r\nWARC-Type: x", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n")]
    rows += [(103, "é", "é" * 300_000), (104, "u", "HTTP/1.1 200 OK\r\n\r\n\r\n")]
    assert result(spark, monkeypatch, rows) == plain(rows)


def test_repeated_and_null_ids(spark, monkeypatch):
    rows = [(1, "u", "a")] * 4 + [(None, "u", "a"), (None, "v", "b"), (None, "v", "b"), (2, "u", "c"), (2, "u", "d")]
    assert result(spark, monkeypatch, rows) == plain(rows)


def test_empty(spark, monkeypatch):
    assert result(spark, monkeypatch, []) == []


@pytest.fixture(scope="module")
def archive(spark):
    rows = [(i, f"http://{'ab'[i % 2]}.org/{i}", f"<p>{'x' * 3000}{i // 2}</p>") for i in range(40)]
    path = session.shared_folder(spark, "test-warc")
    warc.register(spark)
    records = warc.revisit_records(frame(spark, rows)).repartition(4, "record_id")
    records.write.format("warc").mode("append").option("file_bytes", 2000).save(path)
    return path, rows


def test_round_trip(spark, archive):
    path, rows = archive
    got = warc.read_archives(spark, path)
    bodies = {r["target_uri"]: bytes(r["payload"]).decode() for r in got.where("record_type = 'response'").collect()}
    assert bodies == {url: html for i, url, html in rows if i % 2}
    ids = {r["record_id"]: r["target_uri"] for r in got.where("record_type = 'response'").collect()}
    for r in got.where("record_type = 'revisit'").collect():
        assert r["payload"] is None and r["payload_bytes"] == len(rows[int(r["headers"]["X-Page-ID"])][2])
        assert ids[r["refers_to"]].endswith(f"/{r['headers']['X-Refers-To-Page-ID']}")
    assert got.where("record_type = 'warcinfo'").count() > 4  # one a file, files roll over


@pytest.mark.parametrize(
    "where",
    [
        "record_type = 'revisit' and target_uri like 'http://a%'",
        "target_uri in ('http://a.org/4', 'http://b.org/5', 'none')",
        "refers_to is null and not (target_uri = 'http://b.org/1')",
        "content_length > 3000 and target_uri like '%/1%' and target_uri like '%7'",
        "target_uri is null",
        "not (refers_to = 'x')",
        "payload_digest <=> null",
        "headers['X-Page-ID'] = '7' and record_type <> 'warcinfo'",
        "record_type = 'revisit' or target_uri = 'http://b.org/9'",
    ],
)
def test_pushed_filters_change_nothing(spark, archive, where):
    path, _ = archive
    names = "record_type string, record_id string, target_uri string, refers_to string, content_length long, payload_digest string, headers map<string,string>"
    got = warc.read_archives(spark, path, names)
    pushed = {r["record_id"] for r in got.where(where).collect()}
    unpushed = spark.createDataFrame(got.collect(), got.schema).where(where)
    assert pushed == {r["record_id"] for r in unpushed.collect()}


def test_filters_reach_the_reader():
    reader = warc.WarcReader(None, {"path": "/x"})
    keep = [ds.EqualTo(("record_type",), "response"), ds.Not(ds.In(("target_uri",), ("a", "b")))]
    refuse = [ds.EqualTo(("payload_bytes",), 3), ds.EqualTo(("headers", "x"), "3")]
    assert list(reader.pushFilters(keep + refuse)) == refuse and reader.wanted == keep


class Counting(io.BytesIO):
    """Counts the bytes that are read."""

    seen = 0

    def read(self, *size):
        out = super().read(*size)
        self.seen += len(out)
        return out


@pytest.mark.parametrize("compressed", [True, False])
def test_unwanted_payloads_are_not_read(compressed):
    noise = random.Random(1)
    one = lambda kind, size: warc.encode_record({"record_type": kind, "payload": noise.randbytes(size)}, "now")
    plain_records = [one("resource", 1_000_000) for _ in range(5)] + [one("response", 5000)]
    file = Counting(b"".join(map(warc.gzip_member, plain_records) if compressed else plain_records))
    wanted = [ds.EqualTo(("record_type",), "response")]
    (found,) = warc.records(file, compressed, wanted, True)
    assert len(found["payload"]) == 5000 and file.seen < 100_000
    file.seek(0)
    assert len(list(warc.records(file, compressed, [], True))) == 6


def test_foreign_members_and_long_headers():
    record = warc.encode_record({"record_type": "response", "payload": b"x" * 100_000, "headers": [("A", "b" * 9000)]}, "now")
    file = io.BytesIO(gzip.compress(record) * 3 + warc.gzip_member(record))
    assert [len(r["payload"]) for r in warc.records(file, True, [], True)] == [100_000] * 4
    file.seek(0)
    assert [r["headers"]["A"] for r in warc.records(file, True, [], False)] == ["b" * 9000] * 4
    assert gzip.decompress(warc.gzip_member(record)) == record


@pytest.mark.parametrize("payloads", [True, False])
@pytest.mark.parametrize("cut", [3, 40, 700, -1])
def test_damage_is_told(cut, payloads):
    record = warc.encode_record({"record_type": "response", "payload": random.Random(2).randbytes(2000)}, "now")
    for data, compressed in ((record[:cut], False), (warc.gzip_member(record)[:cut], True)):
        with pytest.raises((ValueError, warc.struct.error)):
            list(warc.records(io.BytesIO(data), compressed, [], payloads))


def test_only_listed_files_count(spark, archive, tmp_path):
    path = f"{tmp_path}/w"
    data = spark.createDataFrame([("resource", b"1"), ("resource", b"2")], "record_type string, payload binary")
    data.write.format("warc").mode("append").save(path)
    (tmp_path / "w" / "part-lost.warc").write_bytes(warc.encode_record({"record_type": "resource", "payload": b"3"}, "now"))
    read = lambda: sorted(bytes(r["payload"]) for r in warc.read_archives(spark, path).where("record_type = 'resource'").collect())
    assert read() == [b"1", b"2"]
    data.limit(1).write.format("warc").mode("append").option("compression", "none").save(path)
    assert len(read()) == 3
    data.where(F.col("payload") == b"2").write.format("warc").mode("overwrite").save(path)
    assert read() == [b"2"]
