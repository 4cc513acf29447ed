"""Long windows that slide by little, from panes.

A window of 60 minutes that slides by 10 seconds would copy each click 360 times. Here clicks are
counted once per pane of 10 seconds. A pane adds its count to the windows that begin in the hour
up to it; so between two points where a pane comes in or drops out all windows have the same
count, and a running sum of the panes' differences gives it. The result lists runs of such windows,
at most two per pane.

A run ends with its day: the windows of a day are worked out from the panes of that day and of the
hour after it, so no group is larger than the panes of one ad in a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Length and slide of the trend's window, in seconds.
LENGTH, SLIDE = 3600, 10
_DAY = 86_400


def pane_counts(clicks: DataFrame, slide: int = SLIDE) -> DataFrame:
    """Clicks per (date, pane, ad), batch or stream; ``pane`` is the time at which it begins."""
    counts = clicks.groupBy(F.window("ts", f"{slide} seconds"), "ad_id").agg(F.count("*").alias("click_count"))
    pane = F.col("window.start")
    return counts.select(pane.cast("date").cast("string").alias("date"), pane.alias("pane"), "ad_id", "click_count")


def _day(second: Column) -> Column:
    return second - F.pmod(second, F.lit(_DAY))


def window_runs(panes: DataFrame, length: int = LENGTH, slide: int = SLIDE) -> DataFrame:
    """Runs of windows that have the same number of clicks of an ad (above zero), from panes.

    ``first_start`` and ``last_start`` are the beginnings of the first and last window of the run.
    Only panes are shuffled, those near midnight twice.
    """
    if length % slide or _DAY % slide:
        raise ValueError("the slide must divide the length and the day")
    at = F.unix_seconds("pane")
    ranged = panes.select("ad_id", "click_count", (at - length + slide).alias("first"), at.alias("last"))
    by_day = ranged.withColumn("day", F.explode(F.sequence(_day(F.col("first")), _day(F.col("last")), F.lit(_DAY))))
    points = by_day.repartition("day", "ad_id").select(
        "day", "ad_id",
        F.inline(F.array(
            F.struct(F.greatest("first", "day").alias("at"), F.col("click_count").alias("change")),
            F.struct((F.col("last") + slide).alias("at"), (-F.col("click_count")).alias("change")),
        )),
    )
    changes = (
        points.where(F.col("at") < F.col("day") + _DAY)
        .groupBy("day", "ad_id", "at").agg(F.sum("change").alias("change"))
        .where(F.col("change") != 0)
    )
    order = Window.partitionBy("day", "ad_id").orderBy("at")
    runs = changes.select(
        "day", "ad_id", "at",
        F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("click_count"),
        F.coalesce(F.lead("at").over(order), F.col("day") + _DAY).alias("next"),
    )
    return runs.where(F.col("click_count") > 0).select(
        F.timestamp_seconds("day").cast("date").cast("string").alias("date"), "ad_id",
        F.timestamp_seconds("at").alias("first_start"),
        F.timestamp_seconds(F.col("next") - slide).alias("last_start"), "click_count",
    )


def windows_of(runs: DataFrame, slide: int = SLIDE) -> DataFrame:
    """One row per window of the runs: window_start, ad_id, click_count. Choose the runs first, by
    date or ad: a single click is in ``length / slide`` windows."""
    starts = F.sequence("first_start", "last_start", F.expr(f"interval {slide} seconds"))
    return runs.select(F.explode(starts).alias("window_start"), "ad_id", "click_count")
