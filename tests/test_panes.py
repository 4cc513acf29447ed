from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators.panes import pane_counts, window_runs, windows_of
from clickloom.streaming.ads import sliding_clicks

START = 1_704_067_200  # 2024-01-01


def clicks_of(spark, rows):
    return spark.createDataFrame(rows, "second long, ad_id long").select(F.timestamp_seconds("second").alias("ts"), "ad_id")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("length, slide", [(3600, 10), (600, 600), (200_000 // 40 * 40, 40), (60, 20)])
def test_the_windows_are_those_of_the_copies(spark, length, slide):
    """Against one copy of each click per window, over midnights and before 1970."""
    rng = random.Random(length)
    spread = [START + rng.randrange(-2000, 2000) for _ in range(20)] + [rng.randrange(-90_000, 90_000) for _ in range(6)]
    clicks = clicks_of(spark, [(s, rng.randrange(2)) for s in spread] + [(START, 7)] * 3)
    runs = window_runs(pane_counts(clicks, slide), length, slide)
    copies = sliding_clicks(clicks, f"{length} seconds", f"{slide} seconds")
    assert rows_of(windows_of(runs, slide)) == rows_of(copies)


def test_runs_by_hand(spark):
    """A click that leaves when another comes changes nothing, and a run ends with its day."""
    rows = [(START + 100, 1), (START + 100 + 3600, 1), (START + 86_400 + 5, 2)]
    got = window_runs(pane_counts(clicks_of(spark, rows))).selectExpr(
        "date", "ad_id", f"unix_seconds(first_start) - {START}", f"unix_seconds(last_start) - {START}", "click_count"
    )
    assert rows_of(got) == [
        ("2023-12-31", 1, 100 - 3590, -10, 1), ("2024-01-01", 1, 0, 3700, 1),
        ("2024-01-01", 2, 86_400 - 3590, 86_390, 1), ("2024-01-02", 2, 86_400, 86_400, 1),
    ]


def test_only_panes_are_shuffled(spark):
    """One exchange below the windows, and what goes through it are panes and not points."""
    panes = spark.createDataFrame([], "date string, pane timestamp, ad_id long, click_count long")
    plan = window_runs(panes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.index("inline") < plan.index("Exchange") < plan.index("explode")


def test_slides_that_do_not_fit_are_refused(spark):
    panes = pane_counts(clicks_of(spark, [(0, 1)]), 7)
    with pytest.raises(ValueError, match="divide"):
        window_runs(panes, 70, 7)
    assert window_runs(panes.limit(0)).collect() == []
