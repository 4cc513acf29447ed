from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from clickloom.llm import warc

SCHEMA = "page_id long, url string, html string, address string, payload int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute(rows, least=0):
    data = [(p, (h or "").encode()) for p, _, h in rows]
    first = {}
    for p, h in data:
        if p is not None:
            first[h] = min(first.get(h, p), p)
    out = []
    for p, h in data:
        response = p == first.get(h) or len(h) < least
        digest = base64.b32encode(hashlib.sha1(h).digest()).decode()
        out.append((p, len(h), digest, "response" if response else "revisit", None if response else first[h]))
    return sorted(out, key=repr)


ROWS = [
    (5, "http://a/5", "<p>same"), (3, "http://a/3", "<p>same"), (9, "http://b/\r\nX: y", "<p>same"), (1, None, "é€"),
    (2, "u", None), (4, "u", ""), (None, "u", "<p>same"), (7, "u", "x" * 300_000), (3, "http://a/3", "<p>same"),
    (None, "u", "only without id"), (None, "v", "only without id"),
]


@pytest.mark.parametrize("least", [0, 3, 100])
def test_report_equals_brute_force(spark, tmp_path, least):
    warc.write_archive(frame(spark, ROWS), str(tmp_path), least_bytes=least)
    got = sorted((tuple(r) for r in warc.read_report(spark, str(tmp_path)).collect()), key=repr)
    assert got == brute(ROWS, least)


def test_records_round_trip(spark, tmp_path):
    warc.write_archive(frame(spark, ROWS), str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/payloads").count() == len({(h or "") for *_, h in ROWS})
    found = []
    for r in warc.read_records(spark, str(tmp_path)).collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        block, end = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) :]
        assert end == b"\r\n\r\n"
        payload = block.partition(b"\r\n\r\n")[2]
        if fields["WARC-Type"] == "response":
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            assert fields["WARC-Payload-Digest"] == f"sha1:{digest}"
            found.append((fields.get("X-Page-Id"), payload))
        else:
            assert payload == b"" and "X-Refers-To-Page-Id" in fields
    expected = [(str(p) if p is not None else None, (h or "").encode()) for p, _, h in ROWS]
    assert set(found) <= set(expected) and len({p for _, p in found}) == len({p for _, p in expected})


def test_a_changed_payload_is_noticed(spark, tmp_path):
    warc.write_archive(frame(spark, ROWS), f"{tmp_path}/a")
    table = spark.read.parquet(f"{tmp_path}/a/payloads")
    table.withColumn("payload", F.concat("payload", F.lit("!").cast("binary"))).write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{tmp_path}/a/records").write.parquet(f"{tmp_path}/b/records")
    with pytest.raises(Exception, match="does not match"):
        warc.read_report(spark, f"{tmp_path}/b").collect()


def test_empty_table(spark):
    assert warc.archive_report(spark.createDataFrame([], SCHEMA)).collect() == []
