"""Hot keys too many for the driver, and sessions cut in many small pieces."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.operators import funnel, skew
from clickloom.operators.chunks import chunked_values


def views(spark, sessions, each):
    """Sessions of ``each`` views, one of a hundred times as many, and views of no session."""
    ids = spark.range(sessions * each + 100 * each + 3)
    session = F.when(F.col("id") < sessions * each, F.col("id") % sessions).when(F.col("id") < sessions * each + 100 * each, -1)
    return ids.select(
        session.cast("string").alias("session_id"), (F.col("id") * 7 % 11).alias("page_id"),
        F.timestamp_seconds(F.col("id") % 97).alias("action_time"), F.col("id").alias("action_id"),
    )


def pairs(df):
    seen = {}
    for r in sorted(df.collect(), key=lambda r: (r.action_time, r.action_id)):
        seen.setdefault(r.session_id, []).append(r.page_id)
    return Counter((s, a, b) for s, p in seen.items() for a, b in zip(p, p[1:]))


@pytest.mark.parametrize("listed", [skew.MOST_LISTED if hasattr(skew, "MOST_LISTED") else 0, 5])
def test_tasks_that_cut_sessions_do_not_grow_with_the_pieces(spark, monkeypatch, listed):
    monkeypatch.setattr(skew, "MOST_LISTED", listed, raising=False)
    df = views(spark, 200, 5)
    cut = funnel.page_transitions(df, target_rows=2, fraction=1)
    assert Counter(map(tuple, cut.collect())) == pairs(df)
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 1 <= sum("session-pieces" in f for f in cut.inputFiles()) <= wide


def test_every_session_above_the_target_is_cut(spark):
    df = views(spark, 50, 7)
    hot = skew.hot_parts(df, "session_id", target_rows=3, fraction=1)
    pieces = skew.cut_in_order(df.where("session_id is not null"), ["session_id", "action_id"], skew.total_chunks(hot), 3)
    sizes = pieces.groupBy("session_id").agg(F.count_distinct("_piece").alias("pieces"))
    assert all(r.pieces >= 3 for r in sizes.collect())
    assert pieces.groupBy("_piece").count().agg(F.max("count")).first()[0] <= 3


def test_more_hot_keys_than_listed_are_a_table_of_exact_counts(spark, monkeypatch):
    monkeypatch.setattr(skew, "MOST_LISTED", 5)
    df = views(spark, 40, 4)
    hot = skew.hot_parts(df, "session_id", target_rows=3, fraction=1)
    assert isinstance(hot, skew.HotTable) and (hot.total, hot.most) == (40 * 2 + 134, 134)
    assert skew.hot_parts(df.where("session_id = '-1'"), "session_id", target_rows=3, fraction=1)[0]["session_id"] == "-1"
    assert {r.session_id: r._chunks for r in hot.keys.collect()} == {**{str(i): 2 for i in range(40)}, "-1": 134}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_by_a_table_of_hot_keys(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "MOST_LISTED", 5)
    left = views(spark, 40, 4)
    right = spark.range(-1, 20).select(F.col("id").cast("string").alias("session_id"), F.lit(1).alias("n"))
    want = Counter(map(tuple, left.join(right, "session_id", how).collect()))
    assert Counter(map(tuple, skew.skew_join(left, right, "session_id", how, target_rows=3, fraction=1).collect())) == want
    if how == "inner":
        for n in (None, 4):
            got = skew.skew_split_join(left, right, "session_id", n, target_rows=3, fraction=1)
            assert Counter(map(tuple, got.collect())) == want


def test_lists_of_many_hot_groups(spark, monkeypatch):
    df = views(spark, 40, 4)
    want = sorted(map(repr, chunked_values(df, "session_id", "action_id", 12, []).collect()))
    monkeypatch.setattr(skew, "MOST_LISTED", 5)
    cut = chunked_values(df, "session_id", "action_id", 12, target_rows=3, fraction=1)
    assert sorted(map(repr, cut.collect())) == want
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 1 <= sum("list-pieces" in f for f in cut.inputFiles()) <= wide
