"""The ad job shuffles in parts that follow its log, not the setting of the session."""

from __future__ import annotations

from check_oracle import compare, connect

from clickloom.registry.oracle import oracle_sql
from clickloom.registry.queries import QUERIES
from clickloom.sinks.ledger import Ledger, LedgerTable

FOLDER = "/root/testdata/sf0.001"


def test_ad_job_runs_few_tasks_whatever_the_session_shuffles_in(spark):
    tracker = spark.sparkContext.statusTracker()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        got = QUERIES["ad_job_stat"](spark, FOLDER)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    widest = max(
        info.numTasks for stage in range(2000) if (info := tracker.getStageInfo(stage)) is not None
    )
    assert widest < 400
    assert compare(got, connect(FOLDER), oracle_sql()["ad_job_stat"]) is None


def test_an_empty_table_is_made_without_python(spark, tmp_path):
    table = LedgerTable(Ledger(spark, str(tmp_path)), "t", "d string, k bigint, n bigint", ["d", "k"], "sum", "d")
    empty = table.load([])
    assert empty.schema.simpleString() == "struct<d:string,k:bigint,n:bigint>" and empty.collect() == []
    assert "ExistingRDD" not in empty._jdf.queryExecution().toString()
