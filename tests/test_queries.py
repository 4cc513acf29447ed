"""Single queries on rows of their own."""

from __future__ import annotations

from check_oracle import compare, duckdb

from clickloom.registry.oracle import oracle_sql
from clickloom.registry.queries import QUERIES
from clickloom.sources.views import RAW


def test_upsert_sink_feeds_each_status_by_itself_and_loses_none(spark, tmp_path):
    orders = [
        (1, 7, "O"), (2, 7, "F"), (3, 7, "F"), (4, 7, "P"),
        (5, 8, "P"), (6, 8, "O"), (7, 9, "F"), (8, 9, "O"),
        (9, 10, "O"), (10, 10, None), (11, 11, "X"), (12, 11, "P"), (13, 11, None), (14, None, "O"),
    ]
    rows = [(key, user, status, 1.0, None, None) for key, user, status in orders]
    spark.createDataFrame(rows, RAW["orders"]).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([], RAW["events"]).write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["upsert_sink"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == [
        (10, None, 1, 10), (11, "X", 2, 13), (7, "P", 1, 4), (8, "P", 1, 5), (9, "F", 1, 7), (None, "O", 1, 14),
    ]
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    assert compare(got, con, oracle_sql()["upsert_sink"]) is None
