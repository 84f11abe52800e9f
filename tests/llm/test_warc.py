import base64
import hashlib

import pytest

from mirrorsmith.llm import warc

SCHEMA = "page_id long, url string, html string, body string, address string, record_no int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "b", "a", 1) for i, u, h in rows], SCHEMA).repartition(3)


ROWS = [(1, "http://a", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "http://d", ""), (5, "http://e", "x" * 100_000),
        (None, "http://f", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (9, "u\r\nEvil: 1", "z"), (10, "http://z", "z")]


def test_round_trip(spark):
    path = warc.write_archive(pages(spark, ROWS))
    got = warc.read_records(spark, path, whole=True).collect()
    assert len(got) == len(ROWS)
    stored = spark.read.parquet(f"{path}/payloads").count()
    assert stored == len({h or "" for _, _, h in ROWS})
    top = {}
    for i, _, h in ROWS:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    payloads = {base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(): h for h in top}
    responses = {}
    for r in got:
        h = payloads[r["payload_digest"]]
        assert r["payload_bytes"] == len(h.encode())
        head, http, body = bytes(r["record"]).split(b"\r\n\r\n", 2)
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode())
        assert b"\r\nEvil" not in head
        length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")).split()[1])
        assert bytes(r["record"]).endswith(b"\r\n\r\n") and len(r["record"]) == len(head) + 4 + length + 4
        if r["record_type"] == "response":
            responses[h] = responses.get(h, 0) + 1
            assert body[:-4] == h.encode() and r["refers_to"] is None and r["page_id"] == top[h]
        else:
            assert body[:-4] == b"" and r["refers_to"] == top[h]
    assert responses == {h: 1 for h in top}


def test_small_payloads_are_all_responses(spark):
    got = warc.read_records(spark, warc.write_archive(pages(spark, ROWS), revisit_from=5)).collect()
    assert {r["record_type"] for r in got if r["payload_bytes"] < 5} == {"response"}
    assert sum(r["record_type"] == "revisit" for r in got) == 3


def test_a_changed_payload_is_found(spark):
    path = warc.write_archive(pages(spark, ROWS))
    bad = spark.read.parquet(f"{path}/payloads").selectExpr("address", "first_value(body) over (order by address) as body")
    bad.write.parquet(f"{path}-bad/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}-bad/records")
    with pytest.raises(Exception, match="does not match its payload"):
        warc.read_records(spark, f"{path}-bad").collect()


def test_a_lost_payload_is_found(spark):
    path = warc.write_archive(pages(spark, ROWS))
    kept = spark.read.parquet(f"{path}/payloads").orderBy("address").offset(1)
    kept.write.parquet(f"{path}-lost/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}-lost/records")
    with pytest.raises(Exception, match="is missing"):
        warc.read_records(spark, f"{path}-lost").collect()


def test_no_pages(spark):
    assert warc.read_records(spark, warc.write_archive(pages(spark, []))).collect() == []
