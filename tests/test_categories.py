from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.operators import categories

DETAIL = (
    "session_id string, click_category_id bigint, order_category_ids string, "
    "pay_category_ids string, action_id bigint"
)


def details(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], DETAIL)


def test_counts_by_kind(spark):
    df = details(
        spark,
        [
            ("s", 1, None, None), ("s", 1, None, None), ("t", 2, None, None),
            ("s", None, "1,3", None), ("t", None, None, "3"), ("t", None, None, "3,3,4"),
            ("t", None, None, None), ("t", None, "", "x"),
        ],
    )
    got = {r[0]: tuple(r[1:]) for r in categories.category_counts(df).collect()}
    assert got == {1: (2, 1, 0), 2: (1, 0, 0), 3: (0, 1, 3), 4: (0, 0, 1)}


def test_counts_equal_three_outer_joins(spark):
    df = spark.range(3000).select(
        F.lit("s").alias("session_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 17).alias("click_category_id"),
        F.when(F.col("id") % 3 == 1, F.concat_ws(",", F.col("id") % 13, F.col("id") % 5)).alias(
            "order_category_ids"
        ),
        F.when(F.col("id") % 3 == 2, (F.col("id") % 23).cast("string")).alias("pay_category_ids"),
    )
    click = df.where("click_category_id is not null").groupBy(
        F.col("click_category_id").alias("category_id")
    ).agg(F.count("*").alias("click_count"))

    def listed(column, name):
        ids = df.where(F.col(column).isNotNull()).select(
            F.explode(F.split(column, ",").cast("array<bigint>")).alias("category_id")
        )
        return ids.groupBy("category_id").agg(F.count("*").alias(name))

    order, pay = listed("order_category_ids", "order_count"), listed("pay_category_ids", "pay_count")
    every = click.select("category_id").union(order.select("category_id")).union(
        pay.select("category_id")
    ).distinct()
    joined = every
    for part in (click, order, pay):
        joined = joined.join(part, "category_id", "left")
    expected = joined.na.fill(0)
    got = categories.category_counts(df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_order_by_clicks_then_orders_then_payments(spark, n):
    rows = []
    for category, (c, o, p) in enumerate([(30, 35, 40), (35, 30, 40), (30, 38, 30)], 1):
        rows += [("s", category, None, None)] * c
        rows += [("s", None, str(category), None)] * o
        rows += [("s", None, None, str(category))] * p
    got = [r[0] for r in categories.top_categories(details(spark, rows), n).collect()]
    assert got == [2, 3, 1][:n]


def test_equal_counts_go_by_category_id(spark):
    df = details(spark, [("s", c, None, None) for c in (9, 4, 7, 1)])
    assert [r[0] for r in categories.top_categories(df, 3).collect()] == [1, 4, 7]


def test_top_sessions_with_ties(spark):
    rows = (
        [("b", 1, None, None)] * 3 + [("a", 1, None, None)] * 3 + [("c", 1, None, None)] * 5
        + [("d", 1, None, None)] * 3 + [("a", 2, None, None)] + [("z", 9, None, None)] * 50
    )
    df = details(spark, rows)
    listed = spark.createDataFrame([(1,), (2,)], "category_id bigint")
    got = categories.top_sessions_per_category(df, listed, 3)
    assert sorted(map(tuple, got.collect())) == [
        (1, "a", 3), (1, "b", 3), (1, "c", 5), (2, "a", 1),
    ]


def test_details_repeat_per_category_unless_distinct(spark):
    df = details(spark, [("a", 1, None, None), ("a", 2, None, None), ("b", 1, None, None)])
    top = spark.createDataFrame(
        [(1, "a", 1), (2, "a", 1)], "category_id bigint, session_id string, click_count bigint"
    )
    for limit in (0, 1 << 20):
        twice = categories.top_session_details(top, df, max_bytes=limit)
        once = categories.top_session_details(top, df, distinct_sessions=True, max_bytes=limit)
        assert Counter(r["action_id"] for r in twice.collect()) == {0: 2, 1: 2}
        assert Counter(r["action_id"] for r in once.collect()) == {0: 1, 1: 1}
        assert twice.columns == df.columns


def test_rejects_are_the_entries_that_are_no_numbers(spark):
    df = details(
        spark,
        [("s", 1, None, None), ("t", 7, "", "x"), ("u", None, "1,b,,2", "3"), ("v", None, None, None), ("w", None, "5", "9 ,1e3")],
    )
    got = sorted(map(tuple, categories.category_rejects(df).collect()))
    assert got == [("t", "order", ""), ("t", "pay", "x"), ("u", "order", ""), ("u", "order", "b"), ("w", "pay", "1e3")]
    events = sorted(map(tuple, categories.category_events(df).collect()))
    assert events == [(1, "click"), (1, "order"), (2, "order"), (3, "pay"), (5, "order"), (7, "click"), (9, "pay")]
