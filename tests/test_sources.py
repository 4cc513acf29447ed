from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.sources import ad_log, params, tables
from clickloom.sources.params import TaskParams


class Recorder:
    """Stands for a reader and notes every call, since no database or broker is at hand."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


class FakeSession:
    def __init__(self):
        self.read = self.readStream = Recorder()


def test_date_range_is_closed_text_and_a_missing_bound_is_open(spark):
    rows = spark.createDataFrame([(d,) for d in ("2024-01-01", "2024-01-02", "2024-01-03")], "date string")

    def kept(start, end):
        return [r[0][-1] for r in tables.scan_actions(rows, start, end).collect()]

    assert kept("2024-01-02", "2024-01-03") == ["2", "3"]
    assert kept(None, "2024-01-02") == ["1", "2"]
    assert kept("2024-01-02", None) == ["2", "3"]
    assert kept(None, None) == ["1", "2", "3"]


def test_date_range_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "actions")
    spark.range(90).select(
        F.format_string("2024-01-%02d", F.col("id") % 30 + 1).alias("date"), "id"
    ).write.partitionBy("date").parquet(path)
    actions = spark.read.schema("id bigint, date string").parquet(path)
    scan = tables.scan_actions(actions, "2024-01-10", "2024-01-11")
    assert scan.count() == 6
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-10" in plan


def test_text_times_become_timestamps(spark):
    rows = spark.createDataFrame([("d", "2024-01-01 00:00:01"), ("d", "bad")], "date string, action_time string")
    got = tables.scan_actions(rows)
    assert dict(got.dtypes)["action_time"] == "timestamp"
    assert [r[0] for r in got.select(F.unix_seconds("action_time")).collect()] == [1704067201, None]


def test_click_scan(spark):
    rows = spark.createDataFrame(
        [("2024-01-01", 1, 5), ("2024-01-01", 2, None), ("2024-01-09", 3, 6)],
        "date string, city_id bigint, click_product_id bigint",
    )
    got = tables.scan_clicks(rows, "2024-01-01", "2024-01-02")
    assert got.columns == ["city_id", "product_id"]
    assert [tuple(r) for r in got.collect()] == [(1, 5)]


def test_access_log_reads_missing_values(spark, tmp_path):
    lines = [
        "2024-01-01\x011704067200000\x0112\x013\x01sports\x01view",
        "2024-01-01\x011704067200001\x01null\x013\x01sports\x01view",
        "2024-01-01\x011704067200002\x01null\x01null\x01null\x01register",
    ]
    (tmp_path / "access.log").write_text("\n".join(lines) + "\n")
    got = tables.read_access_log(spark, str(tmp_path / "access.log"))
    assert [tuple(r) for r in got.orderBy("timestamp").collect()] == [
        ("2024-01-01", 1704067200000, 12, 3, "sports", "view"),
        ("2024-01-01", 1704067200001, None, 3, "sports", "view"),
        ("2024-01-01", 1704067200002, None, None, None, "register"),
    ]


def test_jdbc_readers_pass_their_options():
    session = FakeSession()
    tables.read_jdbc_table(session, "jdbc:x", "city_info", user="u", numPartitions="8")
    assert session.read.calls == [
        ("format", ("jdbc",), {}),
        ("options", (), {"url": "jdbc:x", "dbtable": "city_info", "user": "u", "numPartitions": "8"}),
        ("load", (), {}),
    ]
    session = FakeSession()
    tables.read_jdbc_where(session, "jdbc:x", "task", ["task_id=3"], {"user": "u"})
    assert session.read.calls == [
        ("jdbc", ("jdbc:x", "task"), {"predicates": ["task_id=3"], "properties": {"user": "u"}})
    ]


def test_kafka_reader_subscribes_to_the_topic_list(spark):
    session = FakeSession()
    ad_log.read_kafka_log(session, "a:9092,b:9092", "t1,t2", startingOffsets="earliest")
    assert session.readStream.calls[:2] == [
        ("format", ("kafka",), {}),
        (
            "options", (),
            {
                "kafka.bootstrap.servers": "a:9092,b:9092", "subscribe": "t1,t2",
                "startingOffsets": "earliest",
            },
        ),
    ]


def test_task_parameters(spark):
    doc = (
        '{"startDate":["2024-01-01","x"],"endDate":["2024-01-05"],"startAge":[10],"endAge":["50"],'
        '"professionals":["a,b"],"cities":[],"categoryIds":["1,2"],"targetPageFlow":["1,2,3"]}'
    )
    tasks = spark.createDataFrame([(1, doc), (2, "{broken"), (3, "{}")], schemas.TASK)
    rows = {r["task_id"]: r for r in params.read_task_params(tasks).collect()}
    assert rows[1]["startDate"] == "2024-01-01" and rows[1]["startAge"] == "10"
    assert rows[1]["cities"] is None and rows[1]["sex"] is None
    assert set(rows[2][1:]) == set(rows[3][1:]) == {None}
    assert params.load_params(tasks, 1) == TaskParams(
        start_date="2024-01-01", end_date="2024-01-05", start_age=10, end_age=50,
        professionals=("a", "b"), category_ids=(1, 2), page_flow=(1, 2, 3),
    )
    assert params.load_params(tasks, 3) == TaskParams()
    with pytest.raises(LookupError):
        params.load_params(tasks, 9)


def test_ad_log_lines(spark):
    good = "1704067200123 Hubei Wuhan 7 3"
    bad = [
        "", "x Hubei Wuhan 7 3", "1704067200123 Hubei Wuhan 7", "1704067200123 Hubei Wuhan u 3",
        "99999999999999999 Hubei Wuhan 7 3", "99999999999999999999999 Hubei Wuhan 7 3", None,
    ]
    log = spark.createDataFrame([(v,) for v in [good, *bad]], "value string")
    clicks = ad_log.parse_ad_log(log)
    assert [(r[0], *r[1:]) for r in clicks.select(F.unix_millis("ts"), *clicks.columns[1:]).collect()] == [
        (1704067200123, "2024-01-01", "Hubei", "Wuhan", 7, 3)
    ]
    assert sorted(r[0] or "" for r in ad_log.ad_log_rejects(log).collect()) == sorted(
        v or "" for v in bad
    )


def test_access_log_has_no_quoting_and_keeps_what_it_cannot_read(spark, tmp_path):
    from clickloom.sources import tables

    good = '2024-01-01\x011\x012\x013\x01"sport\x01view'
    bad = ["2024-01-01\x01soon\x012\x013\x01a\x01view", "2024-01-01\x011"]
    spark.createDataFrame([(x,) for x in [good, *bad]], "value string").coalesce(1).write.text(f"{tmp_path}/log")
    rows = tables.read_access_log(spark, f"{tmp_path}/log").collect()
    assert [(r.section, r.action) for r in rows] == [('"sport', "view")]
    assert sorted(r.line for r in tables.access_log_rejects(spark, f"{tmp_path}/log").collect()) == sorted(bad)
