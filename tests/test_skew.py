from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import ranking, skew

FORCED = {"target_rows": 70, "fraction": 1}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(5)
    # A third of the rows has key 1, another fifth no key, and some rows are exact copies.
    left = [(rng.choice([1, 1, 1, 1, None, None, 2, 3, 4, 5, 6, 7]), rng.randrange(4)) for _ in range(600)]
    right = [(k, f"r{k}-{i}") for k in (1, 2, 3, 9) for i in range(2)] + [(None, "none")]
    return (
        spark.createDataFrame(left, "k int, v int").repartition(4),
        spark.createDataFrame(right, "k int, name string"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_joins_equal_the_plain_join(sides, how):
    left, right = sides
    expected = rows_of(left.join(right, "k", how))
    chunked = skew.skew_join(left, right, "k", how, **FORCED)
    assert "_salt" in chunked._jdf.queryExecution().analyzed().toString()
    assert rows_of(chunked) == expected
    assert rows_of(skew.salted_join(left, right, "k", 7, how)) == expected
    assert rows_of(skew.skew_join(left, right, "k", how, hot=[])) == expected


def test_split_join_equals_the_plain_join(sides):
    left, right = sides
    expected = rows_of(left.join(right, "k"))
    for target in (20, 100, 10_000):
        for n in (None, 5):
            got = skew.skew_split_join(left, right, "k", n=n, target_rows=target, fraction=1)
            assert rows_of(got) == expected
    assert rows_of(skew.skew_split_join(left.limit(0), right, "k")) == []


def test_right_and_full_joins_are_refused(sides):
    left, right = sides
    for join in (skew.skew_join, skew.salted_join):
        with pytest.raises(ValueError, match="left side"):
            join(left, right, "k", how="full")


def test_two_key_columns(spark):
    left = spark.range(300).select((F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"), "id")
    right = left.select("a", "b").distinct().withColumn("name", F.concat("a", F.lit("-"), "b"))
    got = skew.skew_join(left, right, ["a", "b"], target_rows=20, fraction=1)
    assert rows_of(got) == rows_of(left.join(right, ["a", "b"]))


def test_hot_keys_are_cut_by_rows(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 333, 1).when(F.col("id") < 500, 2).otherwise(F.col("id")).alias("k")
    )
    hot = skew.hot_keys(df, "k", target_rows=100, fraction=1)
    assert [(h["k"], h["_chunks"]) for h in hot] == [(1, 4), (2, 2)]
    assert skew.hot_keys(df, "k") == []
    sampled = skew.hot_keys(df, "k", target_rows=200, fraction=0.3)
    assert sampled[0]["k"] == 1


def test_a_hot_key_in_a_small_file_is_found_by_default(spark, tmp_path):
    """Forty million rows of one key take a few hundred kilobytes as Parquet."""
    path = str(tmp_path / "one")
    spark.range(0, 40_000_000, 1, 8).select(F.lit("s").alias("k")).write.parquet(path)
    hot = skew.hot_keys(spark.read.parquet(path), "k")
    assert [h["k"] for h in hot] == ["s"] and 9 <= hot[0]["_chunks"] <= 12


def test_more_than_a_thousand_hot_keys_are_all_treated(spark):
    df = spark.range(6000).select((F.col("id") % 1500).alias("k"))
    assert len(skew.hot_keys(df, "k", target_rows=3, fraction=1)) == 1500


def test_one_job_finds_the_hot_keys(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("hot-keys-test", "x")
    try:
        skew.skew_join(df, df.distinct(), "k", target_rows=1000)
        assert len(tracker.getJobIdsForGroup("hot-keys-test")) <= 2  # AQE runs its stages as jobs
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_frames_with_map_columns(spark):
    left = spark.range(300).select((F.col("id") % 3).alias("k"), F.create_map("id", F.lit("v")).alias("m"))
    right = spark.range(3).select(F.col("id").alias("k"), F.lit("r").alias("name"))
    for joined in (
        skew.skew_join(left, right, "k", target_rows=20, fraction=1), skew.salted_join(left, right, "k", 4),
    ):
        assert joined.count() == 300


def test_hot_rows_spread_over_their_chunks(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    sizes = df.groupBy(skew.placement(df, 8).alias("s")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 700


def test_copies_spread_by_partition(spark):
    df = spark.range(0, 64, 1, 64).select(F.lit(1).alias("k"))
    assert df.select(skew.placement(df, 8).alias("s")).distinct().count() > 4


def test_salted_agg_equals_the_plain_one(sides):
    left, _ = sides
    aggs = {
        "n": ("count", "*"), "vs": ("count", "v"), "total": ("sum", "v"),
        "low": ("min", "v"), "high": ("max", "v"),
    }
    plain = left.groupBy("k").agg(
        F.count("*").alias("n"), F.count("v").alias("vs"), F.sum("v").alias("total"),
        F.min("v").alias("low"), F.max("v").alias("high"),
    )
    for n in (1, 10):
        got = skew.salted_agg(left, "k", aggs, n)
        assert got.columns == plain.columns and rows_of(got) == rows_of(plain)


def test_top_n_in_one_and_two_steps(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 101).alias("v"), "id")
    order = [F.desc("v"), F.asc("id")]
    expected = []
    by_group = {}
    for g, v, i in df.collect():
        by_group.setdefault(g, []).append((-v, i, g))
    for g, seen in by_group.items():
        expected += [(g, -v, i, nth) for nth, (v, i, _) in enumerate(sorted(seen)[:20], 1)]
    assert rows_of(ranking.top_n_per_group(df, "g", order, 20, rank="nth")) == sorted(expected, key=repr)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        two_steps = ranking.top_n_per_group(df, "g", order, 20, rank="nth")
        assert "_chunk" in two_steps._jdf.queryExecution().analyzed().toString()
        assert rows_of(two_steps) == sorted(expected, key=repr)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_spark_splits_the_sessions_of_a_hot_user(spark):
    """The shape of the user join is one AQE can split; forced here by tiny thresholds."""
    from clickloom.operators.sessions import with_user_info

    profiles = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("user_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("session_id"),
    )
    users = spark.range(0, 20000, 1, 8).selectExpr(
        "id as user_id", "1 as age", "'p' as professional", "'c' as city", "'s' as sex"
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = with_user_info(profiles, users)
        assert len(joined.collect()) == 20000
        assert "isSkewJoin" in joined._jdf.queryExecution().toString() or "skewed" in (
            joined._jdf.queryExecution().toString()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_keys_of_a_table_of_counts(spark):
    counts = spark.createDataFrame([("a", 70), ("b", 20), ("b", 5), ("c", 5)], "k string, n bigint")
    hot = skew.hot_keys(counts, "k", target_rows=10, weight="n")
    assert [(h["k"], h["_chunks"]) for h in hot] == [("a", 7), ("b", 3)]


def test_many_keys_leave_the_sketch_small(spark, monkeypatch):
    """Two million different keys and a few hot ones: a sketch of the least size finds these, and no
    shuffle carries the keys."""
    df = spark.range(2_000_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 4).otherwise(F.col("id") + 10).alias("k"), F.lit("x").alias("pad")
    )
    seen = []
    heavy = skew._heavy
    monkeypatch.setattr(skew, "_heavy", lambda *a: seen.append(a[3]) or heavy(*a))
    hot = skew.hot_keys(df, "k", target_rows=20_000, fraction=1)
    assert seen == [4096]
    # Even ids divisible by 10 have two remainders, 100,000 rows each.
    assert {h["k"]: h["_chunks"] for h in hot} == {0: 6, 2: 6} or {h["k"]: h["_chunks"] for h in hot} == {0: 5, 2: 5}
    plan = df.select("k").selectExpr("approx_top_k_accumulate(k, 4096)")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


@pytest.mark.parametrize("seed", range(3))
def test_no_key_above_twice_the_target_is_missed(spark, seed):
    """Counts that fall off slowly, the worst case for a sketch, and one too small at first."""
    rng = random.Random(seed)
    counts = {k: int(60_000 / (k + 1) ** 0.7) + rng.randrange(50) for k in range(9000)}
    df = spark.createDataFrame(list(counts.items()), "k long, n int").select("k", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    for groups in (0, 4):
        target = 400
        hot = {h["k"] for h in skew.hot_keys(df.repartition(8), "k", target_rows=target, fraction=1)} if not groups else {
            r["k"] for r in skew._heavy(df.select("k").repartition(8), ["k"], target, 1 << 18, groups)[1]
        }
        assert {k for k, n in counts.items() if n > 2 * target} <= hot
        assert all(counts[k] > target / 2 for k in hot)


def test_keys_of_several_columns_and_types(spark):
    df = spark.range(900).selectExpr(
        "id % 3 as a", "timestamp_micros(1700000000123456 + id % 3) as t", "cast(id % 3 as decimal(20, 3)) as d", "id as v",
        "if(id % 3 = 1, null, struct(id % 3 as x)) as s",
    )
    for on in (["a", "t"], ["d"], ["s", "a"]):
        hot = skew.hot_keys(df, on, target_rows=100, fraction=1)
        assert sorted(map(repr, (tuple(h[k] for k in on) for h in hot))) == sorted(map(repr, map(tuple, df.select(*on).distinct().collect())))
        right = df.select(*on).distinct().withColumn("n", F.lit(1))
        assert skew.skew_join(df, right, on, target_rows=100, fraction=1).count() == df.join(right, on).count()


def test_weights_below_the_measure(spark):
    """A hot key made of many light rows, among light keys."""
    counts = spark.range(200_000).select(F.when(F.col("id") % 4 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit(3).alias("n"))
    hot = skew.hot_keys(counts, "k", target_rows=40_000, weight="n")
    assert [h["k"] for h in hot] == [-1] and 3 <= hot[0]["_chunks"] <= 5
