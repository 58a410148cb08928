import base64
import gzip
import hashlib

import zstandard
from pyspark.sql import functions as F

from heddle.llm import warc
from heddle.plans.durable import Scratch

PAGES = [(1, "http://a/1", "<p>é one</p>"), (9, "http://a/2", "<p>é one</p>"), (4, None, "<p>é one</p>"), (5, "http://b\r\nX: y", ""), (6, "http://c", None), (7, "u", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\n\r\n\r\nx"), (8, "u", "z" * 300_000)]


def table(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")


def archived(spark, rows=PAGES, **options):
    return warc.read_archive(*warc.write_archive(table(spark, rows), Scratch(spark, "warc"), **options))


def expected(rows, least=0):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        top = max((k for k, _, h in rows if (h or "").encode() == data and k is not None), default=None)
        response = key == top or len(data) < least
        out.append((key, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if response else "revisit", None if response else top))
    return sorted(out, key=str)


def test_records_read_back(spark):
    found = sorted((tuple(r) for r in warc.describe_records(archived(spark)).collect()), key=str)
    assert found == expected(PAGES)
    assert sorted((tuple(r) for r in warc.describe_records(archived(spark, least_bytes=13)).collect()), key=str) == expected(PAGES, 13)


def test_odd_rows(spark):
    rows = [(2, "u", "same"), (2, "u", "same"), (None, "u", "same"), (None, "v", "lone")]
    found = sorted((tuple(r) for r in warc.describe_records(archived(spark, rows)).collect()), key=str)
    assert [(r[0], r[3], r[4]) for r in found] == [(2, "response", None), (2, "response", None), (None, "revisit", 2), (None, "response", None)]
    assert archived(spark, []).count() == 0


def test_payloads_are_stored_once(spark):
    headers, payloads = warc.write_archive(table(spark), Scratch(spark, "warc"))
    assert headers.count() == len(PAGES) and payloads.count() == len({h or "" for *_, h in PAGES})


def test_keys_beyond_the_bound_are_joined_by_a_shuffle(spark, monkeypatch):
    rows = [(i, "u", f"page {i % 7}") for i in range(40)] + [(39, "u", "page 4"), (None, None, "page 1"), (None, None, None)]
    wanted = sorted(map(tuple, warc.describe_records(archived(spark, rows)).collect()), key=str)
    monkeypatch.setattr(warc, "SENT_KEYS", 0)
    headers, payloads = warc.write_archive(table(spark, rows), Scratch(spark, "warc"))
    assert sorted(map(tuple, warc.describe_records(warc.read_archive(headers, payloads)).collect()), key=str) == wanted
    assert payloads.count() == 8


def test_a_wrong_length_is_an_error(spark):
    longer = archived(spark).withColumn("record", F.concat("record", F.lit(b"!")))
    for damaged in (longer, archived(spark).withColumn("record", F.expr("substring(record, 1, octet_length(record) - 1)"))):
        try:
            warc.describe_records(damaged).collect()
        except Exception as error:
            assert "archive" in str(error)
        else:
            raise AssertionError("damage went unnoticed")


def test_damage_is_an_error(spark):
    headers, payloads = warc.write_archive(table(spark), Scratch(spark, "warc"))
    other = payloads.withColumn("packed", F.lit(zstandard.compress(b"other bytes")))
    cut = payloads.withColumn("packed", F.substring("packed", 1, 9))
    for damaged in (other, cut, payloads.limit(1)):
        try:
            warc.describe_records(warc.read_archive(headers, damaged)).collect()
        except Exception as error:
            assert "archive" in str(error)
        else:
            raise AssertionError("damage went unnoticed")


def test_files_hold_the_same_bytes(spark, tmp_path):
    records = archived(spark)
    warc.export_warc(records, str(tmp_path / "warc"), records_per_file=2)
    back = warc.import_warc(spark, str(tmp_path / "warc"))
    key = lambda r: (bytes(r["header"]), bytes(r["record"]))
    assert sorted(map(key, back.collect())) == sorted(map(key, records.collect()))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "warc").glob("*.gz")))
    assert data.count(b"WARC-Record-ID") == len(PAGES) and data.endswith(b"\r\n\r\n")
    assert "é one".encode() in data


def test_digests_and_fields_are_compiled(spark):
    """No lambda runs for a record, and digests, names that begin alike and fields that are absent come out right."""
    records = archived(spark)
    plan = warc.describe_records(records)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    texts = spark.createDataFrame([(f"text {i}",) for i in range(200)], "t string").select("t", warc.base32(F.sha1("t")).alias("b"))
    assert all(r["b"] == base64.b32encode(hashlib.sha1(r["t"].encode()).digest()).decode() for r in texts.collect())
    block = spark.createDataFrame([(b"WARC/1.1\r\nX-A: A: 1\r\nA: \r\nA: 2\r\n\r\nB: 3",)], "record binary")
    assert tuple(block.select(*(warc.header_field(n) for n in ("A", "X-A", "B"))).first()) == ("", "A: 1", None)
