from __future__ import annotations

import base64
import hashlib

import pytest

from millrace.llm.archive import archive, read_archive, write_archive

ROWS = [
    (1, "http://a/1", "same", 0), (7, "http://a/7", "same", 0), (3, "http://a/3", "same", 0),
    (4, None, None, 0), (5, "http://a/5", "", 0), (6, "bad\r\nurl", "é漢" * 5000, 0),
    (6, "bad\r\nurl", "é漢" * 5000, 0), (None, "http://a/n", "same", 0), (9, "http://a/9", "other", 0),
]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_no int")


def test_records(spark):
    got = archive(table(spark)).collect()
    assert len(got) == len(ROWS)
    html = {(k, u): h for k, u, h, _ in ROWS}
    kinds = {}
    for r in got:
        payload = next(h or "" for k, u, h, _ in ROWS if k == r.page_id).encode()
        assert bytes(r.payload) == payload and r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and block.endswith(b"\r\n\r\n")
        assert int(fields[b"Content-Length"]) == len(block) - 4
        if r.record_type == "response":
            assert block[:-4].partition(b"\r\n\r\n")[2] == payload and r.refers_to is None
        kinds.setdefault(payload, []).append((r.record_type, r.page_id, r.refers_to))
    assert sorted(kinds[b"same"], key=str) == sorted(
        [("response", 7, None), ("revisit", 1, 7), ("revisit", 3, 7), ("revisit", None, 7)], key=str
    )
    assert sorted(kinds[b""], key=str) == [("response", 5, None), ("revisit", 4, 5)]
    twice = kinds[("é漢" * 5000).encode()]
    assert sorted(x[0] for x in twice) == ["response", "revisit"] and html


def test_payloads_once_and_small_ones(spark, folder):
    write_archive(table(spark), f"{folder}/x", least_bytes=5)
    assert spark.read.parquet(f"{folder}/x/payloads").count() == 4
    got = read_archive(spark, f"{folder}/x").collect()
    assert sum(r.record_type == "revisit" for r in got) == 1


def test_damage_is_seen(spark, folder):
    write_archive(table(spark), f"{folder}/y")
    payloads = spark.read.parquet(f"{folder}/y/payloads")
    payloads.selectExpr("address", "encode('wrong', 'UTF-8') AS payload").write.parquet(f"{folder}/z/payloads")
    spark.read.parquet(f"{folder}/y/records").write.parquet(f"{folder}/z/records")
    with pytest.raises(Exception, match="payload lost or changed"):
        read_archive(spark, f"{folder}/z").collect()


def test_a_record_of_another_length_is_seen(spark, folder):
    write_archive(table(spark), f"{folder}/v")
    records = spark.read.parquet(f"{folder}/v/records")
    longer = "encode(replace(decode(headers, 'UTF-8'), 'Content-Type: text/html', 'Content-Type:  text/html'), 'UTF-8')"
    records.selectExpr("record_no", "address", f"{longer} AS headers").write.parquet(f"{folder}/w/records")
    spark.read.parquet(f"{folder}/v/payloads").write.parquet(f"{folder}/w/payloads")
    with pytest.raises(Exception, match="payload lost or changed"):
        read_archive(spark, f"{folder}/w").collect()


def test_ids_come_from_the_headers(spark, folder):
    write_archive(table(spark), f"{folder}/u")
    records = spark.read.parquet(f"{folder}/u/records")
    assert records.columns == ["record_no", "address", "headers"]
    texts = spark.createDataFrame([("a-1", "u", "x"), ("a-2", "u", "x")], "page_id string, url string, html string")
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in archive(texts).collect())
    assert got == [("a-1", "revisit", "a-2"), ("a-2", "response", None)]


def test_no_pages(spark):
    assert archive(table(spark, [])).count() == 0
