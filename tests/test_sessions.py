from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickloom.operators import sessions
from clickloom.sources.params import TaskParams

ACTION = (
    "session_id string, user_id bigint, time string, search_keyword string, "
    "click_category_id bigint, action_id bigint"
)


def actions(spark, rows):
    return (
        spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ACTION)
        .withColumn("action_time", F.to_timestamp("time"))
        .drop("time")
    )


USERS = "user_id bigint, age int, professional string, city string, sex string, name string"


def test_profile(spark):
    df = actions(
        spark,
        [
            ("s", 1, "2024-01-01 10:00:05", "noodle soup", None),
            ("s", 1, "2024-01-01 10:00:00", "soup", None),
            ("s", 1, "2024-01-01 10:00:09", "soup", None),
            ("s", 1, "2024-01-01 10:00:10", "", None),
            ("s", 1, "2024-01-01 10:00:03", None, 11),
            ("s", 1, "2024-01-01 10:00:04", None, 1),
            ("s", 1, "2024-01-01 10:00:04", None, 11),
            ("t", 2, "2024-01-01 11:00:00", None, None),
            ("u", 9, "2024-01-01 12:00:00", None, 4),
        ],
    )
    users = spark.createDataFrame(
        [(1, 30, "IT", "A", "m", "n1"), (2, None, None, None, None, "n2")], USERS
    )
    got = {r["session_id"]: r for r in sessions.session_aggregate(df, users).collect()}
    assert set(got) == {"s", "t"}  # the user of u is unknown
    s, t = got["s"], got["t"]
    # A keyword inside a longer one is kept, and so are clicked categories.
    assert s["search_keywords"] == ["noodle soup", "soup"]
    assert s["click_category_ids"] == [1, 11]
    assert (s["visit_length"], s["step_length"], str(s["start_time"])) == (
        10, 7, "2024-01-01 10:00:00",
    )
    assert (s["age"], s["professional"], s["city"], s["sex"]) == (30, "IT", "A", "m")
    assert (t["search_keywords"], t["click_category_ids"]) == ([], [])
    assert (t["visit_length"], t["step_length"], t["age"]) == (0, 1, None)


PROFILE = (
    "session_id string, age int, professional string, city string, sex string, "
    "search_keywords array<string>, click_category_ids array<bigint>"
)
PROFILES = [
    ("a", 20, "IT", "X", "m", ["k=1", "k2"], [1, 11]),
    ("b", 50, "law", "Y", "f", ["k"], [11]),
    ("c", None, None, None, None, [], []),
]


@pytest.mark.parametrize(
    ("params", "kept"),
    [
        (TaskParams(), "abc"),
        (TaskParams(start_age=20, end_age=49), "a"),
        (TaskParams(start_age=60), "abc"),
        (TaskParams(end_age=10), "abc"),
        (TaskParams(professionals=("law", "x")), "b"),
        (TaskParams(cities=("X", "Y")), "ab"),
        (TaskParams(sex="f"), "b"),
        (TaskParams(keywords=("k",)), "b"),
        (TaskParams(keywords=("k=1",)), "a"),
        (TaskParams(category_ids=(1,)), "a"),
        (TaskParams(category_ids=(11,), sex="m"), "a"),
        (TaskParams(category_ids=(7,)), ""),
    ],
)
def test_filter(spark, params, kept):
    df = spark.createDataFrame(PROFILES, PROFILE)
    got = sorted(r[0] for r in sessions.session_filter(df, params).collect())
    assert "".join(got) == kept


def lengths(spark, pairs):
    return spark.createDataFrame(pairs, "visit_length bigint, step_length bigint")


def test_length_buckets_at_their_edges(spark):
    visits = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801, 99999]
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 1000] + [1] * 7
    row = sessions.session_length_stats(lengths(spark, list(zip(visits, steps)))).first().asDict()
    assert row["session_count"] == 19
    names = [n for n, _, _ in sessions.VISIT_BUCKETS]
    assert [row[f"visit_length_{n}"] for n in names] == [2] * 9
    assert [row[f"step_length_{n}"] for n, _, _ in sessions.STEP_BUCKETS] == [9, 2, 2, 2, 2, 2]
    assert row["visit_length_1s_3s_ratio"] == 0.11
    assert row["step_length_1_3_ratio"] == 0.47
    assert sum(row[f"visit_length_{n}"] for n in names) <= row["session_count"]


def test_no_sessions_gives_null_ratios(spark):
    row = sessions.session_length_stats(lengths(spark, [])).first().asDict()
    assert row["session_count"] == 0
    assert {v for k, v in row.items() if k.endswith("_ratio")} == {None}


def started(spark, per_hour):
    rows = [
        (f"{day}-{hour}-{i}", f"2024-01-{day:02d} {hour:02d}:30:00")
        for (day, hour), n in per_hour.items()
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "session_id string, t string").select(
        "session_id", F.to_timestamp("t").alias("start_time"),
        F.array(F.lit("k")).alias("search_keywords"), F.array(F.lit(1)).alias("click_category_ids"),
    )


def test_hourly_counts(spark):
    df = started(spark, {(1, 0): 3, (1, 23): 1, (2, 0): 2})
    got = dict(map(tuple, sessions.session_hourly_counts(df).collect()))
    assert got == {"2024-01-01_00": 3, "2024-01-01_23": 1, "2024-01-02_00": 2}


def test_sample_follows_the_quotas(spark):
    df = started(spark, {(1, 0): 60, (1, 5): 30, (1, 7): 10, (2, 3): 20, (2, 4): 20, (3, 1): 4})
    got = sessions.sample_sessions(df, total=60)
    counts = {
        (r["date"][-2:], r["hour"]): r["n"]
        for r in got.groupBy("date", "hour").agg(F.count("*").alias("n")).collect()
    }
    # Day 3 has fewer sessions than a third and gives all; the others share the 56 that are left.
    assert counts == {
        ("01", "00"): 17, ("01", "05"): 8, ("01", "07"): 3, ("02", "03"): 14, ("02", "04"): 14,
        ("03", "01"): 4,
    }
    again = {r[0] for r in sessions.sample_sessions(df.repartition(5), 60).select("session_id").collect()}
    assert again == {r[0] for r in got.select("session_id").collect()}
    other = {r[0] for r in sessions.sample_sessions(df, 60, seed=10).select("session_id").collect()}
    assert other != again and len(other) == len(again)


def test_sample_of_nothing(spark):
    assert sessions.sample_sessions(started(spark, {(1, 1): 1}).limit(0)).count() == 0


def test_details_keep_every_action_of_kept_sessions(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias(
            "session_id"
        ),
        F.col("id").alias("action_id"),
    )
    kept = spark.createDataFrame([("hot",), ("s1",), ("s7",), ("none",)], "session_id string")
    plain = df.join(kept, "session_id", "left_semi")
    from clickloom.operators.skew import hot_keys

    hot = hot_keys(df, "session_id", target_rows=100, fraction=1)
    assert [(h["session_id"], h["_chunks"]) for h in hot] == [("hot", 4)]
    for given in (None, hot):
        got = sessions.session_details(kept, df, given)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("counts, total", [
    ({(d, h): 50 for d in range(1, 31) for h in range(24)}, 100),
    ({(d, h): 3 for d in range(1, 29) for h in (3, 9)}, 20),
    ({(1, 0): 1, (1, 5): 2, (2, 7): 500, (3, 9): 40}, 100),
    ({(1, 0): 5, (2, 1): 7}, 100),
    ({(1, 0): 33, (1, 1): 33, (1, 2): 34}, 10),
])
def test_quotas_meet_the_total(spark, counts, total):
    rows = {(r.date, r.hour): r for r in sessions.sample_quotas(started(spark, counts), total).collect()}
    quotas = {k: r.quota for k, r in rows.items()}
    assert sum(quotas.values()) == min(total, sum(counts.values()))
    assert all(0 <= r.quota <= r.session_count for r in rows.values())
    days = {}
    for (date, _), r in rows.items():
        given, there = days.get(date, (0, 0))
        days[date] = (given + r.quota, there + r.session_count)
    most = max(given for given, _ in days.values())
    assert all(given >= most - 1 or given == there for given, there in days.values())
    for (date, _), r in rows.items():
        given, there = days[date]
        assert abs(r.quota - given * r.session_count / there) < 1


@pytest.mark.parametrize("params", [
    TaskParams(), TaskParams(keywords=("kw1", "kw3")), TaskParams(category_ids=(3, 7)),
    TaskParams(keywords=("kw2",), category_ids=(1,), start_age=5, end_age=50, sex="male"),
    TaskParams(professionals=("BUILDING",), cities=("CHINA", "FRANCE")),
])
def test_filtered_sessions_equal_the_filter_over_all_lists(spark, params):
    from clickloom.sources.views import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    slow = sessions.session_filter(sessions.session_aggregate(t.actions(), t.users()), params)
    fast = sessions.filtered_sessions(t.actions(), t.users(), params)
    assert fast.columns == slow.columns
    assert sorted(map(str, fast.collect())) == sorted(map(str, slow.collect()))
    plan = sessions.session_profiles(t.actions(), params)._jdf.queryExecution().toString()
    assert "collect_set" not in plan
