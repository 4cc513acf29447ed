"""Daily indicators of a news site. Without ``date`` every day of the log is reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.numbers import ratio


def _on(access: DataFrame, date: str | None) -> DataFrame:
    return access if date is None else access.where(F.col("date") == date)


def _views(access: DataFrame, date: str | None) -> DataFrame:
    return _on(access, date).where(F.col("action") == "view")


def visits(access: DataFrame, date: str | None = None) -> DataFrame:
    """The log counted by everything the figures ask for: date, action, page, section, user, ``views``.

    All figures take it in place of the log, so one scan of the log is enough for the five of them.
    Counts of several days or parts of a day add up. A hot page is spread over its users, and
    anonymous views are counted in each task before they meet.
    """
    counted = F.sum("views") if "views" in access.columns else F.count("*")
    return _on(access, date).groupBy("date", "action", "pageid", "section", "userid").agg(counted.alias("views"))


def _total(access: DataFrame, condition: Column | None = None) -> Column:
    """Log lines that meet a condition, of lines or of :func:`visits`."""
    if "views" not in access.columns:
        return F.count("*") if condition is None else F.count_if(condition)
    counted = F.sum("views") if condition is None else F.sum(F.when(condition, F.col("views")))
    return F.coalesce(counted, F.lit(0).cast("long"))


def daily_page_pv(access: DataFrame, date: str | None = None) -> DataFrame:
    """Views per page, most viewed first."""
    return (
        _views(access, date).groupBy("date", "pageid").agg(_total(access).alias("pv"))
        .orderBy(F.desc("pv"))
    )


def daily_page_uv(access: DataFrame, date: str | None = None) -> DataFrame:
    """Visitors per page, most first. All anonymous views of a page count as one visitor.

    Views are first made distinct by (date, page, user), which spreads a hot page over its
    users; ``count(DISTINCT userid)`` would leave out the anonymous visitor.
    """
    return (
        _views(access, date).select("date", "pageid", "userid").distinct()
        .groupBy("date", "pageid").agg(F.count("*").alias("uv"))
        .orderBy(F.desc("uv"))
    )


def daily_section_pv(access: DataFrame, date: str | None = None) -> DataFrame:
    """Views per section, most viewed first."""
    return (
        _views(access, date).groupBy("date", "section").agg(_total(access).alias("pv"))
        .orderBy(F.desc("pv"))
    )


def register_rate(access: DataFrame, date: str | None = None) -> DataFrame:
    """Registrations per anonymous view."""
    action = F.col("action")
    return (
        _on(access, date)
        .groupBy("date")
        .agg(
            _total(access, action == "register").alias("registers"),
            _total(access, (action == "view") & F.col("userid").isNull()).alias("anonymous_views"),
        )
        .withColumn("register_rate", ratio(F.col("registers"), F.col("anonymous_views")))
    )


def jump_rate(access: DataFrame, date: str | None = None) -> DataFrame:
    """Registered users with a single view on the day, per view of registered users."""
    per_user = (
        _views(access, date).where(F.col("userid").isNotNull())
        .groupBy("date", "userid").agg(_total(access).alias("views"))
    )
    return (
        per_user.groupBy("date")
        .agg(
            F.count_if(F.col("views") == 1).alias("one_view_users"),
            F.sum("views").alias("user_views"),
        )
        .withColumn("jump_rate", ratio(F.col("one_view_users"), F.col("user_views")))
    )
