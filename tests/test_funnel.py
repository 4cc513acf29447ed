from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.operators import funnel
from clickloom.operators.skew import hot_keys

VIEW = "session_id string, page_id bigint, seconds bigint, action_id bigint"


def views(spark, rows):
    return spark.createDataFrame(rows, VIEW).withColumn(
        "action_time", F.timestamp_seconds("seconds")
    )


def pairs_by_hand(rows):
    found = Counter()
    by_session = {}
    for session, page, second, action in rows:
        by_session.setdefault(session, []).append((second, action, page))
    for session, seen in by_session.items():
        pages = [p for _, _, p in sorted(seen)]
        found.update((session, a, b) for a, b in zip(pages, pages[1:]))
    return found


@pytest.mark.parametrize("seconds", [1, 20, 300])
def test_transitions_with_and_without_cut_sessions(spark, seconds):
    rng = random.Random(seconds)
    rows = [
        (rng.choice(["hot", "hot", "a", "b", "c"]), rng.choice([None, 1, 2, 3, 4]),
         rng.randrange(seconds), i)
        for i in range(400)
    ]
    # Several instants within a second, too.
    df = views(spark, rows).withColumn(
        "action_time", F.timestamp_micros(F.col("seconds") * 400_000)
    )
    plain = funnel.page_transitions(df)
    cut = funnel.page_transitions(df, target_rows=20, fraction=1)
    assert "_piece" in cut._jdf.queryExecution().analyzed().toString()
    expected = pairs_by_hand(rows)
    hot = hot_keys(df, "session_id", target_rows=20, fraction=1)
    assert sum(h["_chunks"] for h in hot) > 1
    for got in (plain, cut):
        assert Counter(tuple(r) for r in got.collect()) == expected


def test_equal_times_follow_the_action_id(spark):
    df = views(spark, [("s", 2, 5, 1), ("s", 1, 5, 0), ("s", 3, 4, 2)])
    got = [tuple(r)[1:] for r in funnel.page_transitions(df).collect()]
    assert sorted(got) == [(1, 2), (3, 1)]


def rates(spark, rows, flow, **kw):
    return [tuple(r) for r in funnel.page_convert_rates(views(spark, rows), flow, **kw).orderBy("step").collect()]


ROWS = [
    ("a", 3, 1, 0), ("a", 5, 2, 1), ("a", 2, 3, 2),
    ("b", 3, 1, 3), ("b", 5, 2, 4),
    ("c", 3, 1, 5), ("c", 9, 2, 6),
]


def test_rates(spark):
    assert rates(spark, ROWS, (3, 5, 2)) == [(1, "3_5", 2, 3, 0.67), (2, "5_2", 1, 2, 0.5)]


def test_a_missing_step_counts_one_and_stands_in_for_the_next(spark):
    assert rates(spark, ROWS, (3, 7, 5, 2)) == [
        (1, "3_7", 1, 3, 0.33), (2, "7_5", 1, 1, 1.0), (3, "5_2", 1, 1, 1.0),
    ]
    assert rates(spark, ROWS, (3, 7, 5), missing_as=0) == [
        (1, "3_7", 0, 3, 0.0), (2, "7_5", 0, 0, None),
    ]


def test_an_unseen_first_page_counts_one(spark):
    assert rates(spark, ROWS, (8, 5, 2)) == [(1, "8_5", 1, 1, 1.0), (2, "5_2", 1, 1, 1.0)]


def test_no_views_at_all(spark):
    assert rates(spark, [], (1, 2)) == [(1, "1_2", 1, 1, 1.0)]


def test_repeated_steps_have_a_row_each(spark):
    rows = [("a", p, i, i) for i, p in enumerate([1, 2, 1, 2, 1])]
    got = rates(spark, rows, (1, 2, 1, 2))
    assert got == [(1, "1_2", 2, 3, 0.67), (2, "2_1", 2, 2, 1.0), (3, "1_2", 2, 2, 1.0)]
    df = funnel.page_convert_rates(views(spark, rows), (1, 2, 1, 2))
    assert funnel.convert_rate_text(df).first()[0] == "1_2=1.0|2_1=1.0"


def test_splits_and_start(spark):
    df = views(spark, ROWS)
    assert dict(map(tuple, funnel.page_flow_splits(df, (3, 5, 7)).collect())) == {"3_5": 2}
    assert funnel.start_page_pv(df, (3, 5)).first()[0] == 3
    with pytest.raises(ValueError, match="two pages"):
        funnel.page_convert_rates(df, (3,))
