"""Ad clicks in batch form; the streaming queries use the same functions per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ranking import top_n_per_group
from clickloom.operators.skew import Hot, skew_join

# Fixed value: clicks on one ad on one day from which a user is blacklisted.
BLACKLIST_THRESHOLD = 100


def _count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Clicks per key, of single clicks or of counts made before."""
    clicks = F.sum("click_count") if "click_count" in df.columns else F.count("*")
    return df.groupBy(*keys).agg(clicks.alias("click_count"))


def click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, province, city, user, ad): all that the statistics below need.

    However many clicks a user makes, this leaves a few rows of them, so what is joined and
    counted afterwards is small and has no hot user.
    """
    return _count(clicks, ["date", "province", "city", "user_id", "ad_id"])


def ad_user_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, user, ad), of clicks or click counts."""
    return _count(clicks, ["date", "user_id", "ad_id"])


def ad_blacklist(user_clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users who reached the threshold on any day and ad."""
    return user_clicks.where(F.col("click_count") >= threshold).select("user_id").distinct()


def ad_filtered_clicks(
    clicks: DataFrame, blacklist: DataFrame, hot: Hot | None = None
) -> DataFrame:
    """Clicks of users not on the blacklist. Hot users, the likely entries, join in chunks."""
    return skew_join(clicks, blacklist.select("user_id"), "user_id", "left_anti", hot)


def ad_stat(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, province, city, ad), of clicks or click counts."""
    return _count(clicks, ["date", "province", "city", "ad_id"])


def province_clicks(stat: DataFrame) -> DataFrame:
    """Clicks per (date, province, ad) of area counts."""
    return _count(stat, ["date", "province", "ad_id"])


def ad_province_top3(stat: DataFrame, n: int = 3, per_day: bool = True) -> DataFrame:
    """The ``n`` most clicked ads of each province, per day or (``per_day=False``) over all
    days, where each (day, ad) competes as a row of its own."""
    group = ["date", "province"] if per_day else ["province"]
    totals = province_clicks(stat)
    order = [F.desc("click_count"), F.asc("ad_id"), F.asc("date")]
    return top_n_per_group(totals, group, order, n).select(
        "date", "province", "ad_id", "click_count"
    )


def ad_click_trend(clicks: DataFrame) -> DataFrame:
    """Clicks per minute and ad."""
    return (
        clicks.groupBy(
            "date", F.date_format("ts", "HH").alias("hour"),
            F.date_format("ts", "mm").alias("minute"), "ad_id",
        )
        .agg(F.count("*").alias("click_count"))
    )
