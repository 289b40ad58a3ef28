import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tourney.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAGES = [
    (1, "http://a/\r\nX-Evil: 1", "<p>same</p>"),
    (2, "http://b/", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (4, "http://c/é", None),
    (5, "http://d/", ""),
    (6, "http://e/", "WARC/1.1\r\n\r\nnot a record é\U0001f600"),
    (7, "http://f/", "x" * 300_000),
    (8, "http://g/", "line\n" * 1000),
    (8, "http://g/", "line\n" * 1000),
    (None, "http://h/", "<p>same</p>"),
    (None, "http://i/", "alone"),
]


@pytest.fixture
def archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 200_000)
    monkeypatch.setattr(warc, "RANGE_BYTES", 3_000)
    warc.register(spark)
    rows = spark.createDataFrame([(*p, "?") for p in PAGES], SCHEMA).repartition(3)
    path = str(tmp_path / "archive")
    warc.archive_records(rows).write.format("warc").mode("append").save(path)
    return path


def test_round_trip(spark, archive):
    found = [tuple(r) for r in warc.archived_pages(spark, archive).collect()]
    last = {}
    for page, _, html in PAGES:
        last[html or ""] = max(last.get(html or "", -1), -1 if page is None else page)
    expected = []
    for page, _, html in PAGES:
        chief = last[html or ""]
        revisit = chief >= 0 and chief != page
        kind = "revisit" if revisit else "response"
        size = len((html or "").encode())
        expected.append((page, size, digest(html), kind, chief if revisit else None))
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_payloads_and_headers(spark, archive):
    rows = {
        r.record_id: r
        for r in spark.read.format("warc").load(archive).where("warc_type = 'response'").collect()
    }
    assert bytes(rows["<urn:page:6>"].payload).decode() == PAGES[5][2]
    assert len(rows["<urn:page:7>"].payload) == 300_000
    uris = {r.record_id: r.target_uri for r in spark.read.format("warc").load(archive).collect()}
    assert uris["<urn:page:1>"] == "http://a/%0D%0AX-Evil: 1"
    assert uris["<urn:page:9>"] is None


def test_predicates_are_pushed_and_payloads_skipped(spark, archive):
    reader = warc.WarcReader(archive, payload=False)
    pushed = [
        warc.EqualTo(("warc_type",), "revisit"),
        warc.StringStartsWith(("target_uri",), "http://"),
        warc.EqualTo(("payload_bytes",), 3),
    ]
    assert list(reader.pushFilters(pushed)) == [pushed[2]]
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert len(reader.partitions()) > 3
    rows = [r for b in batches for r in b.to_pylist()]
    assert {r["warc_type"] for r in rows} == {"revisit"}
    assert {r["payload"] for r in rows} == {None}
    # The headers of records with skipped blocks are right, so every block was stepped over.
    no_payload = spark.read.format("warc").option("payload", "false").load(archive)
    sizes = [r.payload_bytes for r in no_payload.collect()]
    assert sorted(sizes) == sorted(len((html or "").encode()) for _, _, html in PAGES)
    one = no_payload.where((F.col("warc_type") == "revisit") & (F.col("payload_bytes") > 0))
    assert {r.refers_to for r in one.collect()} == {"<urn:page:9>"}


def test_files_of_failed_tasks_are_not_read(spark, archive):
    before = spark.read.format("warc").load(archive).count()
    stray = warc.record_bytes({"record_id": "<urn:page:99>", "warc_type": "response", "payload": b""})
    with open(f"{archive}/part-stray.warc", "wb") as file:
        file.write(stray)
    assert spark.read.format("warc").load(archive).count() == before


def test_archives_of_other_origin(spark, tmp_path):
    records = [
        {"record_id": f"<urn:page:{i}>", "warc_type": "response", "payload": b"p" * i}
        for i in range(5)
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(warc.record_bytes(r)) for r in records))
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "b.warc").write_bytes(info + warc.record_bytes(records[3]))
    warc.register(spark)
    rows = spark.read.format("warc").load(str(tmp_path)).collect()
    assert sorted(r.payload_bytes for r in rows) == [0, 1, 2, 3, 3, 3, 4]
    assert [r.warc_type for r in rows].count("warcinfo") == 1


def test_empty_table_and_overwrite(spark, archive):
    nothing = spark.createDataFrame([], SCHEMA)
    records = warc.archive_records(nothing)
    records.write.format("warc").mode("overwrite").save(archive)
    assert warc.archived_pages(spark, archive).count() == 0
